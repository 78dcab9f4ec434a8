"""Query registry, oracle SQL, the batch pipeline and publishing."""

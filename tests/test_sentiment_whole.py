"""The sentiment rule runs over the whole reviews."""

from emporia.plans import registry
from tests.conftest import SF_SMALL


def test_sentiment_covers_whole_reviews(spark):
    out = registry.queries()["sentiment_from_rating"](spark, SF_SMALL)
    reviews = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert out.columns == ["review_id", "customer_id", "product_id", "product_name", "rating", "sentiment"]
    assert out.count() == reviews.count()
    assert registry.oracle_sql()["sentiment_from_rating"].strip().endswith("SELECT * FROM reviews")

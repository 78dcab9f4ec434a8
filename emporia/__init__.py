"""Retail analytics on Spark."""

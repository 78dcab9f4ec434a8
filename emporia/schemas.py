"""Record contract of the four retail sources.

These explicit schemas are used whenever a source is read from text formats
(JSON lines, CSV, stream values), so no job is spent on schema inference and
the types stay stable between runs. Ids are strings in the wire format; the
analyses do not depend on the id type (the table adapters in
``emporia.sources.fixtures`` produce integer ids).
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

WEBLOGS = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("browser", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("duration_sec", T.LongType()),
    T.StructField("referrer", T.StringType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("unit_price", MONEY),
    T.StructField("total_amount", MONEY),
    T.StructField("discount_pct", T.LongType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("delivery_days", T.LongType()),
])

REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("rating", T.LongType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("helpful_votes", T.LongType()),
    T.StructField("has_image", T.BooleanType()),
    T.StructField("verified_purchase", T.BooleanType()),
])

SOCIAL = T.StructType([
    T.StructField("post_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("platform", T.StringType()),
    T.StructField("user_handle", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("hashtags", T.ArrayType(T.StringType())),
    T.StructField("sentiment", T.StringType()),
    T.StructField("likes", T.LongType()),
    T.StructField("shares", T.LongType()),
    T.StructField("brand_mention", T.BooleanType()),
    T.StructField("country", T.StringType()),
])

SOURCES = {
    "weblogs": WEBLOGS,
    "transactions": TRANSACTIONS,
    "reviews": REVIEWS,
    "social": SOCIAL,
}

# Record id of each source: the stream key and the de-duplication key.
# Transactions have no line id (an order id may repeat): the lake takes out
# whole rows that landed again on another day instead.
RECORD_KEY = {
    "weblogs": "event_id",
    "transactions": None,
    "reviews": "review_id",
    "social": "post_id",
}


# Another name that the fourth source goes by.
ALIASES = {"social_media": "social"}


def check_source(source: str) -> str:
    """The source's name; unknown names are rejected before any plan is built."""
    source = ALIASES.get(source, source)
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}; expected one of {sorted(SOURCES)}")
    return source

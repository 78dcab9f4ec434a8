"""Business rules as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the record contract.
COMPLETED_STATUSES = ("delivered", "shipped")
CANCELLED_STATUS = "cancelled"
SENTIMENTS = ("positive", "neutral", "negative")
SEGMENTS = ("VIP", "Regular", "Occasional", "Browse-only")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sentiment_from_rating(rating="rating") -> Column:
    """rating >= 4 positive, <= 2 negative, otherwise neutral (null stays null)."""
    r = _c(rating)
    return (F.when(r >= 4, F.lit("positive"))
            .when(r <= 2, F.lit("negative"))
            .when(r.isNotNull(), F.lit("neutral")))


def is_not_cancelled(status="status") -> Column:
    """``status != 'cancelled'``; a null status is dropped, as in SQL."""
    return _c(status) != F.lit(CANCELLED_STATUS)


def is_completed(status="status") -> Column:
    return _c(status).isin(*COMPLETED_STATUSES)


def segment_of(spend, p75, p50) -> Column:
    """Spend segment: above p75 VIP, above p50 Regular, above 0 Occasional."""
    s = _c(spend)
    return (F.when(s > _c(p75), F.lit("VIP"))
            .when(s > _c(p50), F.lit("Regular"))
            .when(s > 0, F.lit("Occasional"))
            .otherwise(F.lit("Browse-only")))

"""Streaming operators (all also valid on a batch DataFrame).

Watermarks bound the state: a window or session is emitted once the
watermark (max event time seen minus the delay) passes its end, and later
records for it are dropped from the aggregate (they remain in the raw zone).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.money import cents, cents_to_double

DEFAULT_DELAY = "1 hour"

# Settings a streaming query should start with. Session windows are then merged
# inside each task before the shuffle into state (batch plans always do this),
# so a hot key ships one row per local session instead of its raw events.
STREAM_CONF = {
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def tumbling_counts(df: DataFrame, time_col: str, key: str, size: str = "1 day",
                    delay: str = DEFAULT_DELAY, value_col: str | None = None) -> DataFrame:
    """Counts (and an exact money-like sum of ``value_col``) per tumbling window and key."""
    aggs = [F.count(F.lit(1)).alias("events")]
    if value_col:
        aggs.append(cents_to_double(F.sum(cents(value_col))).alias("total_value"))
    return (df.withWatermark(time_col, delay)
              .groupBy(F.window(time_col, size).alias("w"), key)
              .agg(*aggs))


def sliding_counts(df: DataFrame, time_col: str, key: str, size: str = "1 day",
                   slide: str = "12 hours", delay: str = DEFAULT_DELAY) -> DataFrame:
    """Counts per sliding window and key (trending)."""
    return (df.withWatermark(time_col, delay)
              .groupBy(F.window(time_col, size, slide).alias("w"), key)
              .agg(F.count(F.lit(1)).alias("events")))


def sessions(df: DataFrame, time_col: str, key: str, gap: str = "30 minutes",
             delay: str = DEFAULT_DELAY) -> DataFrame:
    """Activity sessions per key: a session ends after ``gap`` without events.

    Start the stream with ``STREAM_CONF`` so sessions are merged map-side.
    """
    return (df.withWatermark(time_col, delay)
              .groupBy(F.session_window(time_col, gap).alias("w"), key)
              .agg(F.count(F.lit(1)).alias("events"),
                   F.min(time_col).alias("first_event"),
                   F.max(time_col).alias("last_event")))


def dedup_by_id(df: DataFrame, time_col: str, key: str, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Drop replays of the same record id seen within the watermark delay."""
    return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([key])

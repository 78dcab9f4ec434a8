"""Streaming queries, registered with SQL for the records they emit.

Each query lands the whole input table into a landing folder as
time-ordered files (the way records arrive), runs the stream with
``availableNow`` (one time slice per micro-batch, so watermarks advance across
batches), writes to a file sink under the checkpoint folder and returns the
sink read back as a batch DataFrame.

Window and session oracles keep what the watermark has closed at the end of
the run: Spark's watermark is ``max event time (ms) - delay`` and a window or
session is emitted once its end is at or before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from emporia.operators import customer360 as c3
from emporia.plans.queries_c360 import C360_SQL
from emporia.plans.registry import register
from emporia.session import scratch_path
from emporia.sources.fixtures import load_sources, weblogs, with_sources
from emporia.sources.lake import Lake
from emporia.sources.tables import read_table
from emporia.streaming import customer360 as sc3
from emporia.streaming import dedup as sd
from emporia.streaming import operators as so
from emporia.streaming.operators import STREAM_CONF
from emporia.streaming.sources import (
    TOPICS,
    decode_records,
    encode_records,
    event_time,
    land_in_time_order,
    landing_records,
    landing_rows,
    wall_time,
)

LANDING_FILES = 4
DELAY = "1 hour"


def run_available_now(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                      partition_by: list[str] | None = None, options: dict | None = None,
                      state_partitions: int | None = None) -> StreamingQuery:
    """Process everything available, in micro-batches, then stop; return the query.

    Stateful operators keep ``spark.sql.shuffle.partitions`` state partitions
    for the life of the checkpoint (AQE cannot coalesce them), so the number is
    chosen here, by default the cluster's parallelism, and recorded in the
    checkpoint when the query first starts. Session windows are merged inside
    each task before the shuffle (``STREAM_CONF``), so a key holding a third of
    the events sends one row per local session, not its raw events.
    """
    spark = df.sparkSession
    w = (df.writeStream.format(fmt).outputMode("append")
           .option("path", sink).option("checkpointLocation", checkpoint)
           .options(**(options or {})))
    if partition_by:
        w = w.partitionBy(*partition_by)
    n = state_partitions or max(1, spark.sparkContext.defaultParallelism)
    with session_conf(spark, {**STREAM_CONF, "spark.sql.shuffle.partitions": str(n)}):
        q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


class session_conf:
    """Set session settings while a streaming query starts (it keeps a copy)."""

    def __init__(self, spark: SparkSession, conf: dict[str, str]):
        self.spark, self.conf = spark, conf

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.conf}
        for k, v in self.conf.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        return False


def _events_stream(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    events = read_table(spark, sf_dir, "events") if events is None else events
    landing = scratch_path(spark, "landing-events")
    per_slice = land_in_time_order(events, landing, "ts", LANDING_FILES)
    stream = landing_rows(spark, landing, events.schema, max_files_per_trigger=per_slice)
    return stream.withColumn("t", event_time("ts", spark))


def _sink_back(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    base = scratch_path(spark, name)
    run_available_now(df, f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out")


_WM = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 hour FROM events)"


def _weblog_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str, int]:
    """Weblogs as Kafka-shaped records (key = event id, JSON value) in a landing folder."""
    src = weblogs(spark, sf_dir)
    records = encode_records(src, "event_id", TOPICS["weblogs"], keep=("timestamp",))
    landing = scratch_path(spark, "landing-weblogs")
    per_slice = land_in_time_order(records, landing, "timestamp", LANDING_FILES)
    return src, landing, per_slice


def _decoded_weblogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, landing, per_slice = _weblog_records(spark, sf_dir)
    decoded = decode_records(landing_records(spark, landing, max_files_per_trigger=per_slice),
                             src.schema)
    return decoded.filter(F.col("_corrupt_record").isNull()).select(*src.columns)


@register("stream_ingest", with_sources("weblogs") + "SELECT * FROM weblogs")
def q_stream_ingest(spark, sf_dir):
    return _sink_back(spark, _decoded_weblogs(spark, sf_dir), "stream-ingest")


def _landed_weblogs(spark: SparkSession, sf_dir: str) -> tuple[Lake, DataFrame]:
    """Weblog records mixed with raw conversation lines (not JSON) on one topic,
    landed by the two landing queries: rows to the raw zone, bad lines to quarantine."""
    from emporia.streaming.ingest import start_landing

    src, landing, per_slice = _weblog_records(spark, sf_dir)
    junk = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(
        (F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("key"),
        F.col("text").alias("value"), F.lit(TOPICS["weblogs"]).alias("topic"))
    junk.write.mode("append").parquet(landing)
    lake = Lake(spark, scratch_path(spark, "stream-lake"))
    records = landing_records(spark, landing, max_files_per_trigger=per_slice)
    with session_conf(spark, {**STREAM_CONF, "spark.sql.shuffle.partitions":
                              str(max(1, spark.sparkContext.defaultParallelism))}):
        queries = start_landing(records, src.schema, lake, "weblogs",
                                scratch_path(spark, "stream-lake-ck"), date_col="timestamp",
                                available_now=True)
    for q in queries:
        q.awaitTermination()
    return lake, src


@register("stream_land_raw", with_sources("weblogs")
          + 'SELECT *, CAST("timestamp" AS DATE) AS ingest_date FROM weblogs')
def q_stream_land_raw(spark, sf_dir):
    lake, src = _landed_weblogs(spark, sf_dir)
    return lake.read("raw", "weblogs", src.schema)


@register("stream_quarantine", """
SELECT CAST(conv_id * 100 + turn AS VARCHAR) AS "key", text AS raw_value
FROM conversations WHERE NOT json_valid(text)""")
def q_stream_quarantine(spark, sf_dir):
    lake, _ = _landed_weblogs(spark, sf_dir)
    return lake.read("quarantine", "weblogs").select("key", "raw_value")


_DAY = "(SELECT max(CAST(\"timestamp\" AS DATE)) + 1 FROM weblogs)"


@register("lake_stream_and_batch", with_sources("weblogs") + f"""
SELECT *, CAST("timestamp" AS DATE) AS ingest_date FROM weblogs
UNION ALL SELECT *, {_DAY} AS ingest_date FROM weblogs""")
def q_lake_stream_and_batch(spark, sf_dir):
    """A stream lands all weblogs by day, then a batch lands them again on the day after the last one."""
    lake, src = _landed_weblogs(spark, sf_dir)
    day = src.agg(F.date_add(F.max(F.to_date("timestamp")), 1)).first()[0]
    lake.ingest_raw("weblogs", src, date=day)
    return lake.read("raw", "weblogs", src.schema)


@register("lake_quarantine_both", with_sources("weblogs") + """
SELECT CAST(conv_id * 100 + turn AS VARCHAR) AS "key", text AS raw_value, 'unreadable record' AS reject_reason
FROM conversations WHERE NOT json_valid(text)
UNION ALL
SELECT CAST(event_id AS VARCHAR), NULL, 'negative duration' FROM weblogs WHERE duration_sec % 7 = 1""")
def q_lake_quarantine_both(spark, sf_dir):
    """Undecodable records of a stream and rule breakers of a batch day, in one quarantine zone."""
    lake, src = _landed_weblogs(spark, sf_dir)
    day = src.agg(F.date_add(F.max(F.to_date("timestamp")), 1)).first()[0]
    broken = src.withColumn("duration_sec", F.when(F.col("duration_sec") % 7 == 1, -F.col("duration_sec"))
                            .otherwise(F.col("duration_sec")))
    lake.ingest_raw("weblogs", broken, date=day)
    lake.promote("weblogs", src.schema, date=day)
    out = lake.read("quarantine", "weblogs")
    text = F.when(F.col("reject_reason") == "unreadable record", F.col("raw_value"))
    return out.select("key", text.alias("raw_value"), "reject_reason")


@register("stream_tumbling_traffic", f"""
WITH w AS (
  SELECT time_bucket(INTERVAL 1 day, ts) AS window_start, event_type, count(*) AS events,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
  FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 day AS window_end, event_type, events, total_value
FROM w WHERE window_start + INTERVAL 1 day <= {_WM}""")
def q_stream_tumbling_traffic(spark, sf_dir):
    agg = so.tumbling_counts(_events_stream(spark, sf_dir), "t", "event_type", "1 day", DELAY,
                             value_col="value")
    out = agg.select(wall_time("w.start", spark).alias("window_start"),
                     wall_time("w.end", spark).alias("window_end"), "event_type", "events",
                     "total_value")
    return _sink_back(spark, out, "stream-tumbling")


@register("stream_sliding_trending", f"""
WITH b AS (SELECT time_bucket(INTERVAL 12 hour, ts) AS b0, event_type FROM events),
x AS (SELECT b0 AS window_start, event_type FROM b
      UNION ALL SELECT b0 - INTERVAL 12 hour AS window_start, event_type FROM b)
SELECT window_start, window_start + INTERVAL 1 day AS window_end, event_type, count(*) AS events
FROM x GROUP BY window_start, event_type
HAVING window_start + INTERVAL 1 day <= {_WM}""")
def q_stream_sliding_trending(spark, sf_dir):
    agg = so.sliding_counts(_events_stream(spark, sf_dir), "t", "event_type", "1 day",
                            "12 hours", DELAY)
    out = agg.select(wall_time("w.start", spark).alias("window_start"),
                     wall_time("w.end", spark).alias("window_end"), "event_type", "events")
    return _sink_back(spark, out, "stream-sliding")


@register("stream_session_stats", f"""
WITH o AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
g AS (SELECT user_id, ts,
             sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 minute THEN 1 ELSE 0 END)
               OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
      FROM o),
s AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 minute AS session_end,
             count(*) AS events, min(ts) AS first_event, max(ts) AS last_event
      FROM g GROUP BY user_id, sid)
SELECT * FROM s WHERE session_end <= {_WM}""")
def q_stream_session_stats(spark, sf_dir):
    agg = so.sessions(_events_stream(spark, sf_dir), "t", "user_id", "30 minutes", DELAY)
    out = agg.select("user_id", wall_time("w.start", spark).alias("session_start"),
                     wall_time("w.end", spark).alias("session_end"), "events",
                     wall_time("first_event", spark).alias("first_event"),
                     wall_time("last_event", spark).alias("last_event"))
    return _sink_back(spark, out, "stream-sessions")


@register("stream_dedup", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stream_dedup(spark, sf_dir):
    """Every event of a third of the users arrives twice; each event comes out once."""
    events = read_table(spark, sf_dir, "events")
    replayed = events.unionByName(events.where("user_id % 3 = 0"))
    out = so.dedup_by_id(_events_stream(spark, sf_dir, replayed), "t", "event_id", DELAY)
    return _sink_back(spark, out.drop("t"), "stream-dedup")


@register("stream_dedup_merged", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stream_dedup_merged(spark, sf_dir):
    """Every event of a third of the users arrives five times; replays are merged in their batch before the state."""
    events = read_table(spark, sf_dir, "events")
    times = F.when(F.expr("user_id % 3 = 0"), 5).otherwise(1)
    replayed = events.withColumn("n", F.explode(F.sequence(F.lit(1), times))).drop("n")
    stream = _events_stream(spark, sf_dir, replayed)
    base = scratch_path(spark, "stream-merged")
    staging = f"{base}/staged"
    (stream.writeStream.foreachBatch(sd.staged_sink(staging, "t", "event_id"))
     .option("checkpointLocation", f"{base}/staged-checkpoint").trigger(availableNow=True).start().awaitTermination())
    out = so.dedup_by_id(sd.staged_rows(spark, staging, stream.schema), "t", "event_id", DELAY)
    return _sink_back(spark, out.drop("t"), "stream-dedup-merged")


@register("stream_customer_360", C360_SQL)
def q_stream_customer_360(spark, sf_dir):
    s = load_sources(spark, sf_dir)
    rows = c3.union_rows(s["weblogs"], s["transactions"], s["reviews"], s["social"])
    landing = scratch_path(spark, "landing-360")
    # any split works here: partials are merged by sums, counts and max; the
    # files are those of the input's own partitions
    rows.write.parquet(landing)
    files = len(spark.read.parquet(landing).inputFiles())
    stream = landing_rows(spark, landing, rows.schema, max_files_per_trigger=-(-files // LANDING_FILES))
    state = scratch_path(spark, "stream-360-state")
    (stream.writeStream.foreachBatch(sc3.partials_sink(state))
           .option("checkpointLocation", scratch_path(spark, "stream-360-ck"))
           .trigger(availableNow=True).start().awaitTermination())
    return sc3.merged_360(spark, state)

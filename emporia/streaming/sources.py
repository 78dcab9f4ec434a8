"""Stream sources: Kafka topics or a landing folder with the same record shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.sources.files import decode_json_column

# Kafka records as the decode step sees them.
RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
])

# Topic name per source, as published by the producers.
TOPICS = {
    "weblogs": "weblogs",
    "transactions": "transactions",
    "reviews": "customer_reviews",
    "social": "social_feeds",
}


def kafka_records(spark: SparkSession, bootstrap_servers: str, topics: list[str],
                  starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                  extra: dict | None = None) -> DataFrame:
    """Kafka topics as (key, value, topic) strings. Needs the Kafka connector
    on the classpath; offsets live in the query checkpoint (no auto-commit)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", ",".join(topics))
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for k, v in (extra or {}).items():
        reader = reader.option(k, v)
    return reader.load().select(F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"), "topic")


def encode_records(df: DataFrame, key_col: str, topic: str,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows as Kafka records: string key, JSON value of the whole row, topic
    (the producer side); ``keep`` columns are carried along unencoded."""
    from emporia.sources.files import encode_json_column

    return df.select(F.col(key_col).cast("string").alias("key"), encode_json_column(df),
                     F.lit(topic).alias("topic"), *keep)


def write_kafka(records: DataFrame, bootstrap_servers: str, checkpoint: str | None = None,
                extra: dict | None = None):
    """Write (key, value, topic) records to Kafka: a batch write, or a started
    streaming query when ``records`` is a stream (then ``checkpoint`` is required).
    Needs the Kafka connector on the classpath."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, **(extra or {})}
    if records.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming Kafka write needs a checkpoint folder")
        return (records.writeStream.format("kafka").options(**opts)
                .option("checkpointLocation", checkpoint).start())
    records.write.format("kafka").options(**opts).save()
    return None


def landing_records(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files holding (key, value, topic) records: the same
    shape as ``kafka_records``, for replays and tests without a broker."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def landing_rows(spark: SparkSession, path: str, schema: T.StructType,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files with typed rows, as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def decode_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON values -> typed columns plus ``_corrupt_record`` for bad values."""
    return decode_json_column(records, "value", schema, keep=("key",))


def event_time(col: str | Column, spark: SparkSession) -> Column:
    """A ``timestamp_ntz`` wall-clock column as a UTC instant (``timestamp``),
    whatever the session time zone; ``timestamp`` columns pass through."""
    c = F.col(col) if isinstance(col, str) else col
    since = c.cast("timestamp_ntz") - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    instant = F.expr("TIMESTAMP'1970-01-01 00:00:00Z'") + since
    return F.when(F.typeof(c) == "timestamp", c.cast("timestamp")).otherwise(instant)


def wall_time(col: str | Column, spark: SparkSession) -> Column:
    """Inverse of ``event_time``: a UTC instant as ``timestamp_ntz`` wall time."""
    c = F.col(col) if isinstance(col, str) else col
    zero = F.lit(0)
    since = F.make_dt_interval(zero, zero, zero, (F.unix_micros(c) / F.lit(1_000_000).cast("decimal(7,0)"))
                               .cast("decimal(18,6)"))
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + since


def land_in_time_order(df: DataFrame, path: str, time_col: str, slices: int = 4,
                       max_rows_per_file: int = 250_000, accuracy: int = 10_000) -> int:
    """Replay helper: write ``df`` into ``path`` as consecutive time slices.

    Slice bounds are approximate quantiles of ``time_col``, so slices hold
    about the same number of rows even when traffic bursts. Each slice is its
    own append job, written as ``m`` parallel files, so file modification
    times follow event time. Returns ``m``: a stream reading the folder with
    ``maxFilesPerTrigger = m`` takes one slice per micro-batch, in time order.
    Rows without a time go with the first slice. ``df`` is evaluated once, into
    a work table that the cuts and the slices read.
    """
    df.write.parquet(f"{path}.rows")
    df = df.sparkSession.read.schema(df.schema).parquet(f"{path}.rows")
    t = F.col(time_col)
    probs = [i / slices for i in range(1, slices)]
    stats = df.agg(F.count(F.lit(1)).alias("n"),
                   F.percentile_approx(t, probs, accuracy).alias("cuts")).first()
    n = stats["n"]
    if n == 0:
        df.write.mode("overwrite").parquet(path)
        return 1
    files = max(1, -(-n // (slices * max_rows_per_file)))
    cuts = sorted(set(stats["cuts"] or []))
    bounds = [None] + cuts + [None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (t >= F.lit(lo))
        if hi is not None:
            cond = cond & (t < F.lit(hi))
            cond = (cond | t.isNull()) if lo is None else cond
        # ``repartition`` (not ``coalesce``) keeps the scan and filter parallel;
        # only the slice's rows move to its ``files`` writers
        df.filter(cond).repartition(files).write.mode("append").parquet(path)
    return files

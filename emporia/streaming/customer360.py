"""Running Customer 360 from a stream of union rows.

``foreachBatch`` turns each micro-batch into per-customer *partials* (counts,
sums, max) and the distinct (customer, session) pairs, written into
``batch_id=N`` partitions with dynamic overwrite: a batch replayed after a
failure replaces its own output, so the state is exactly-once. The read side
merges partials with one aggregation. ``compact`` folds the batches up to a
switch-over number into a base folder ``base/upto=N`` of its own, written whole
under that name; reads take the latest finished base and the batches after it,
so later batches of the stream, whatever their number, never meet the base.
Averages are kept as sum + count until the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators.customer360 import finish_360, partial_aggs


def write_partials(rows: DataFrame, state_path: str, batch_id: int) -> None:
    partials = rows.groupBy("customer_id").agg(*partial_aggs(distinct_sessions=False))
    pairs = (rows.filter(F.col("session_id").isNotNull())
                 .select("customer_id", "session_id").distinct())
    for name, df in (("partials", partials), ("sessions", pairs)):
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
           .parquet(f"{state_path}/{name}"))


def partials_sink(state_path: str):
    """A ``foreachBatch`` function writing the partials of each micro-batch.

    The batch feeds two writes, so it is persisted (memory and disk) while they
    run: the source (a Kafka offset range) is read once, and a lost executor
    recomputes its blocks from that fixed range.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write_partials(batch, state_path, batch_id)
        finally:
            batch.unpersist()
    return sink


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder that hold a finished write or partitions."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()] if fs.exists(root) else []


def _bases(spark: SparkSession, state_path: str) -> list[int]:
    """Switch-over numbers of the finished bases: the last table of a base is its sessions."""
    return sorted(int(n.partition("=")[2]) for n in _folders(spark, f"{state_path}/base")
                  if n.startswith("upto=") and "sessions" in _folders(spark, f"{state_path}/base/{n}")
                  and _finished(spark, f"{state_path}/base/{n}/sessions"))


def _finished(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _state(spark: SparkSession, state_path: str, name: str, base: int | None) -> DataFrame:
    """The base's table of this name and the tail of batches after it."""
    parts = []
    if base is not None:
        parts.append(spark.read.parquet(f"{state_path}/base/upto={base}/{name}"))
    if _folders(spark, f"{state_path}/{name}"):
        tail = spark.read.parquet(f"{state_path}/{name}")
        parts.append((tail if base is None else tail.filter(F.col("batch_id") > base)).drop("batch_id"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def merged_core(spark: SparkSession, state_path: str) -> DataFrame:
    """Merge base and tail (partials and session pairs) into the 360 core, in one aggregate."""
    bases = _bases(spark, state_path)
    base = bases[-1] if bases else None
    p = _state(spark, state_path, "partials", base)
    s = _state(spark, state_path, "sessions", base)
    rows = p.unionByName(s, allowMissingColumns=True)
    sums = ["web_rows", "web_clicks", "duration_sum", "duration_n", "order_rows", "total_orders",
            "spend", "spend_n", "review_rows", "reviews_written", "rating_sum", "rating_n",
            "social_rows", "social_posts"]
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(c) if c not in ("spend", "duration_sum",
                                                                 "rating_sum")
            else F.sum(c).alias(c) for c in sums]
    aggs += [F.max("last_purchase_date").alias("last_purchase_date"),
             F.sum("social_likes").alias("social_likes"),
             F.count_distinct("session_id").alias("sessions")]
    return rows.groupBy("customer_id").agg(*aggs)


def merged_360(spark: SparkSession, state_path: str) -> DataFrame:
    return finish_360(merged_core(spark, state_path), notebook=False)


def compact(spark: SparkSession, state_path: str, out_path: str | None = None) -> None:
    """Fold all batches so far into a base.

    In place the base is recorded as holding every batch up to the latest one.
    In a new folder ``out_path``, where a stream with a fresh checkpoint numbers
    its batches from 0, it is recorded as coming before all of them.
    """
    core = merged_core(spark, state_path)
    bases = _bases(spark, state_path)
    base = bases[-1] if bases else None
    upto = -1
    if out_path is None:
        batches = [int(n.partition("=")[2]) for n in _folders(spark, f"{state_path}/partials") if "=" in n]
        upto = max(batches, default=-1)
        if upto == base:
            return
    target = f"{out_path or state_path}/base/upto={upto}"
    core.select(*[c for c in core.columns if c != "sessions"]).write.mode("overwrite").parquet(f"{target}/partials")
    (_state(spark, state_path, "sessions", base).select("customer_id", "session_id").distinct()
     .write.mode("overwrite").parquet(f"{target}/sessions"))

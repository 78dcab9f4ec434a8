"""Running Customer 360 with a change feed: a bucketed table that each micro-batch merges into.

The table holds one row a customer, cut into buckets of customers. A batch reads and writes the buckets it touches and
no others, and appends the new 360 rows of the customers it changed to the feed, all in one commit that carries the
batch's number: a batch that is replayed after a failure finds its number and does nothing.

Sessions are counted without keeping them for ever: a customer's row holds the sessions seen within ``keep`` before
the watermark (the latest event time of the batches before); older ones are a number. A session id that comes back
later than that counts again, so ``keep`` must exceed the longest session and the lateness of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators.customer360 import finish_360, partial_aggs, union_rows
from emporia.sources.snapshots import Change, Snapshots

KEEP = "2 days"
#: Sums that are 0, and sums that are null, for a customer without rows of their source.
_COUNTS = ("web_rows", "web_clicks", "duration_n", "order_rows", "total_orders", "spend_n", "review_rows",
           "reviews_written", "rating_n", "social_rows", "social_posts")
_SUMS = ("duration_sum", "spend", "rating_sum", "social_likes")


def feed_rows(weblogs: DataFrame, transactions: DataFrame, reviews: DataFrame, social: DataFrame) -> DataFrame:
    """Union rows of the four sources with the time of web events (``_event_ts``)."""
    times = weblogs.where("customer_id IS NOT NULL").select("event_id", "customer_id", "session_id", "duration_sec",
                                                            F.lit("w").alias("_src"), F.col("timestamp").alias("_event_ts"))
    others = union_rows(weblogs.where("false"), transactions, reviews, social)
    return others.unionByName(times, allowMissingColumns=True)


class RunningCustomer360:
    """The 360 under one folder; ``buckets`` is fixed when it is first written."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, keep: str = KEEP):
        self.spark, self.keep = spark, keep
        self.table = Snapshots(spark, root, "bucket", ("customer_id",))
        self.buckets = self.table.note("buckets", buckets)

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col("customer_id").cast("string")), F.lit(self.buckets)).cast("int")

    def merge(self, rows: DataFrame, batch_id: int) -> int | None:
        """Merge a batch of union rows (``feed_rows``) -> version, or None if the batch was merged before."""
        if batch_id <= self.table.note("batch", -1):
            return None
        base = self.table.version()
        mark = self.table.note("watermark")
        rows = rows.where("customer_id IS NOT NULL")
        touched = [r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()]
        if not touched:
            return None
        wanted = F.col("day").isin(touched)
        files = self.table.files("state", base)
        old_files = None if files is None else files.where(wanted)
        kind = rows.schema["_event_ts"].dataType
        horizon = (F.lit(mark).cast(kind) if mark else F.lit(None).cast(kind)) - F.expr(f"INTERVAL {self.keep}")

        sums = rows.groupBy("customer_id").agg(*partial_aggs(distinct_sessions=False)).withColumn(
            "sessions_done", F.lit(0).cast("long"))
        seen = (rows.where("session_id IS NOT NULL").groupBy("customer_id", "session_id")
                .agg(F.max("_event_ts").alias("seen")))
        parts = sums
        if old_files is not None:
            old = self.table.read_files(old_files, self.table.schema("state", base)).drop("bucket")
            parts = parts.unionByName(old.drop("recent"))
            kept = old.select("customer_id", F.explode("recent").alias("r")).select("customer_id", "r.*")
            seen = seen.unionByName(kept).groupBy("customer_id", "session_id").agg(F.max("seen").alias("seen"))
        done = F.coalesce(F.col("seen") < horizon, F.lit(False))
        sessions = seen.select("customer_id", F.when(done, 1).otherwise(0).cast("long").alias("sessions_done"),
                               F.when(~done, F.struct("session_id", "seen")).alias("one"))
        merged = (parts.unionByName(sessions, allowMissingColumns=True).groupBy("customer_id")
                  .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS], *[F.sum(c).alias(c) for c in _SUMS],
                       F.max("last_purchase_date").alias("last_purchase_date"),
                       F.sum("sessions_done").alias("sessions_done"), F.collect_list("one").alias("recent"))
                  .withColumn("bucket", self._bucket()))
        adds = self.table.write_files("state", merged)
        state = self.table.read_files(adds, merged.schema)
        changed = self._finish(state.join(rows.select("customer_id").distinct(), "customer_id", "left_semi"))
        feed = changed.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("bucket", self._bucket())
        latest = rows.agg(F.max("_event_ts").cast("string")).first()[0]
        return self.table.commit("merge", {
            "state": Change(adds, old_files, merged.schema),
            "changes": Change(self.table.write_files("changes", feed), None, feed.schema)},
            base, note={"batch": batch_id, "buckets": self.buckets, "watermark": max(filter(None, (mark, latest)), default=None)})

    def sink(self):
        """A ``foreachBatch`` function that merges each micro-batch."""
        def merge(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                self.merge(batch, batch_id)
            finally:
                batch.unpersist()
        return merge

    @staticmethod
    def _finish(state: DataFrame) -> DataFrame:
        return finish_360(state.withColumn("sessions", F.col("sessions_done") + F.size("recent")))

    def current(self, version: int | None = None) -> DataFrame:
        """The 360 as of a version: a projection of the table, nothing is merged."""
        return self._finish(self.table.read("state", version))

    def customer(self, customer_id) -> DataFrame:
        """One customer's row; one file is read."""
        return self._finish(self.table.lookup("state", "customer_id", [customer_id]))

    def changes(self, after_batch: int = -1) -> DataFrame:
        """The feed: for each batch after one the new rows of the customers it changed, with ``batch_id``."""
        return self.table.read("changes").where(F.col("batch_id") > after_batch).drop("bucket")

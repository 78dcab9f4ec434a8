"""Point-in-time join: each event with the last snapshot of its key at or before the event's time.

No range join: events and snapshots are united, sorted once by key and time, and the last snapshot is carried down the
sort. A key's rows are cut into blocks of time first, each block a group of its own that begins with the last snapshot
of the blocks before it (one row a key and block, found on the aggregated snapshots); so a key with a third of all
rows is sorted by as many tasks as its time has blocks, and no row is ever multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DAYS = 30


def _block(time: Column, days: int) -> Column:
    return F.floor(F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")) / F.lit(days))


def as_of_join(events: DataFrame, snapshots: DataFrame, key: str, time: str, snapshot_time: str,
               block_days: int = BLOCK_DAYS) -> DataFrame:
    """``events`` with the other columns of ``snapshots`` as of ``time`` (null where there is none yet).

    Defined cases: an event without a key or a time has no snapshot; snapshots without either are ignored; of several
    snapshots of one key and time the greatest by (its columns in order) counts; a column name of both sides is taken
    from the events, the snapshot's time included if ``events`` has a column of that name.
    """
    taken = [c for c in snapshots.columns if c != key and c not in events.columns]
    snap = (snapshots.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{snapshot_time}`").isNotNull())
            .select(F.col(f"`{key}`").alias("_key"), F.col(f"`{snapshot_time}`").alias("_time"),
                    F.struct(*[F.col(f"`{c}`") for c in taken]).alias("_snap"))
            .groupBy("_key", "_time").agg(F.max("_snap").alias("_snap")).withColumn("_block", _block(F.col("_time"), block_days)))
    rows = events.select(F.struct("*").alias("_event"), F.col(f"`{key}`").alias("_key"), F.col(f"`{time}`").alias("_time"))
    known = rows.where("_key IS NOT NULL AND _time IS NOT NULL").withColumn("_block", _block(F.col("_time"), block_days))
    ends = snap.groupBy("_key", "_block").agg(F.max_by("_snap", "_time").alias("_snap"))
    begins = known.select("_key", "_block").distinct().withColumn("_wanted", F.lit(True))
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (ends.join(begins, ["_key", "_block"], "full")
               .withColumn("_carry", F.last("_snap", ignorenulls=True).over(earlier))
               .where("_wanted AND _carry IS NOT NULL").select("_key", "_block", F.col("_carry").alias("_snap")))
    # 0 what is carried in, 1 a snapshot, 2 an event: at one time the snapshot comes first
    united = (carried.withColumn("_kind", F.lit(0)).unionByName(
        snap.withColumn("_kind", F.lit(1)), allowMissingColumns=True).unionByName(
        known.withColumn("_kind", F.lit(2)), allowMissingColumns=True))
    order = Window.partitionBy("_key", "_block").orderBy(F.col("_time").asc_nulls_first(), "_kind")
    found = (united.withColumn("_last", F.last("_snap", ignorenulls=True).over(order)).where("_kind = 2")
             .select("_event", "_last"))
    none = rows.where("_key IS NULL OR _time IS NULL").select("_event", F.lit(None).cast(
        found.schema["_last"].dataType).alias("_last"))
    return found.unionByName(none).select("_event.*", *[F.col(f"_last.`{c}`").alias(c) for c in taken])

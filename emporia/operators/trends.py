"""What trends: items whose latest window stands out against the windows before.

Two passes over the rows. The first keeps for each window a bounded frequent-items summary, merged over tasks by
taking counts apart: every item is hashed to one of ``slots`` counters, and only items of counters that reach the
wanted size can be frequent enough (a counter is never less than any of its items). The second counts those few
candidates exactly, in all windows. So memory is ``slots`` counters a window whatever the number of items, and the
result is exact: an item with ``least`` or more mentions in the latest window is never missed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 16


def frequent_slots(df: DataFrame, item: str, window: str, least: int, slots: int = SLOTS) -> DataFrame:
    """``(slot, upper)`` of the latest window: counters of at least ``least``; each is an upper bound for its items."""
    last = df.agg(F.max(window)).first()[0]
    now = df.where((F.col(window) == F.lit(last)) & F.col(item).isNotNull())
    return (now.groupBy(_slot(item, slots).alias("slot")).agg(F.count(F.lit(1)).alias("upper")).where(F.col("upper") >= least))


def _slot(item: str, slots: int):
    return F.pmod(F.xxhash64(F.col(item).cast("string")), F.lit(slots)).cast("int")


def trending_growth(df: DataFrame, item: str, window: str, n: int = 20, earlier: int = 3, least: int = 5,
                    slots: int = SLOTS) -> DataFrame:
    """The ``n`` items with the largest growth: ``item, mentions, before, growth``.

    ``mentions`` in the latest window, ``before`` in the ``earlier`` distinct windows before it that have rows, and
    growth = (mentions * earlier + earlier) / (before + earlier), the ratio to the mean of the earlier windows with one
    mention added to each side; items with fewer than ``least`` mentions aren't candidates. Ties go to the more
    mentioned, then to the smaller item. Rows without an item or a window don't count.
    """
    rows = df.select(F.col(item).alias("item"), F.col(window).alias("w")).where("item IS NOT NULL AND w IS NOT NULL")
    # the windows, one row each: the driver takes as many as are compared
    last = [r.w for r in rows.select("w").distinct().orderBy(F.desc("w")).limit(earlier + 1).collect()]
    if not last:
        return rows.select("item", F.lit(0).cast("long").alias("mentions"), F.lit(0).cast("long").alias("before"),
                           F.lit(0.0).alias("growth")).limit(0)
    recent = rows.where(F.col("w") >= F.lit(last[-1]))
    slot = _slot("item", slots)
    hot = frequent_slots(recent, "item", "w", least, slots).select("slot")
    counted = (recent.withColumn("slot", slot).join(hot, "slot", "left_semi").groupBy("item")
               .agg(F.count_if(F.col("w") == F.lit(last[0])).alias("mentions"),
                    F.count_if(F.col("w") < F.lit(last[0])).alias("before")).where(F.col("mentions") >= least))
    growth = (F.col("mentions") * earlier + earlier).cast("double") / (F.col("before") + earlier)
    return counted.withColumn("growth", growth).orderBy(F.desc("growth"), F.desc("mentions"), "item").limit(n)

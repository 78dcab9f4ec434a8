"""Quantiles and distinct counts kept as state: one mergeable sketch a day.

A day's values become a KLL sketch (quantiles) or a Theta sketch (distinct ids), a few kilobytes each; the answer for
any range of days comes from merging its sketches, without the rows. Partial sketches are built in tasks before the
shuffle, so a hot day is no hot task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: KLL size; the rank error of one quantile is about 1.65 % / (K / 200) at 99 % confidence.
K = 800
#: log2 of the number of hashes that a Theta sketch keeps; its relative error is about 1 / sqrt(2 ** LG).
LG = 14


def rank_error(k: int = K) -> float:
    """Bound of the normalised rank error that holds for a KLL quantile (single query, 99 %), doubled for merging."""
    return 2 * 2.296 / k ** 0.9021


def day_quantile_sketches(df: DataFrame, day: str, value: str, k: int = K) -> DataFrame:
    """``(day, sketch)`` of a numeric column; null values and rows without a day are left out."""
    x = F.col(value).cast("double")
    return (df.where(F.col(day).isNotNull() & x.isNotNull()).groupBy(F.col(day).alias("day"))
            .agg(F.kll_sketch_agg_double(x, F.lit(k)).alias("sketch")))


def quantiles_of_range(sketches: DataFrame, first, last, probs: list[float], k: int = K) -> DataFrame:
    """``(prob, value, n)`` of all values of the days from ``first`` to ``last``, from their sketches; no rows if there
    are none."""
    merged = (sketches.where(F.col("day").between(F.lit(first), F.lit(last)))
              .agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("days")))
    asked = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"),
                      F.kll_sketch_get_n_double("sketch").alias("n")) for p in probs]
    return merged.where("days > 0").select(F.inline(F.array(*asked)))


def day_id_sketches(df: DataFrame, day: str, ident: str, lg: int = LG) -> DataFrame:
    """``(day, ids)``: a Theta sketch of a day's distinct ids; null ids and rows without a day are left out."""
    return (df.where(F.col(day).isNotNull() & F.col(ident).isNotNull()).groupBy(F.col(day).alias("day"))
            .agg(F.theta_sketch_agg(F.col(ident).cast("string"), F.lit(lg)).alias("ids")))


def distinct_of_range(sketches: DataFrame, first, last, lg: int = LG):
    """One row ``ids``: the union of the sketches of a range of days."""
    return (sketches.where(F.col("day").between(F.lit(first), F.lit(last)))
            .agg(F.theta_union_agg("ids", F.lit(lg)).alias("ids")))


def overlap(a: DataFrame, b: DataFrame, lg: int = LG) -> DataFrame:
    """``(day, n_a, n_b, n_either, n_both)``, estimated from two tables of day sketches; a day that one side lacks has
    no ids there."""
    both = a.withColumnRenamed("ids", "_a").join(b.withColumnRenamed("ids", "_b"), "day", "full")

    def count(sketch):
        return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")

    two = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    either = F.when(two, F.theta_sketch_estimate(F.theta_union("_a", "_b", lg))).otherwise(count(F.coalesce("_a", "_b")))
    return both.select("day", count("_a").alias("n_a"), count("_b").alias("n_b"), either.cast("long").alias("n_either"),
                       F.when(two, F.theta_sketch_estimate(F.theta_intersection("_a", "_b"))).otherwise(0).cast("long")
                       .alias("n_both"))

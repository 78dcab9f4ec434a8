"""Percent shares and value counts over aggregated results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.money import ratio_half_up


def with_share(df: DataFrame, count_col: str, pct_col: str = "pct", scale: int = 2) -> DataFrame:
    """Add ``round(100 * count / total, scale)``, total taken over all rows of ``df``.

    The total is a scalar subquery (``DataFrame.scalar()``): Spark evaluates the
    one-row aggregate once, reusing the shuffle of ``df``'s own aggregation,
    and inlines the value. No join, and the groups are never gathered into one
    partition the way an unpartitioned window would. The total is projected
    once, so the plan holds one subquery whatever ``reuseSubquery`` says.
    """
    total = df.agg(F.sum(count_col)).scalar()
    return (df.withColumn("_share_total", total)
              .withColumn(pct_col, ratio_half_up(count_col, "_share_total", scale, factor=100))
              .drop("_share_total"))


def value_counts(df: DataFrame, col: str, count_name: str) -> DataFrame:
    """Rows per non-null value of ``col`` (pandas ``value_counts``)."""
    return df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_name))


def source_row_counts(sources: dict[str, DataFrame]) -> DataFrame:
    """Rows per source: four global counts (map-side partial counts), one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
             for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def round_columns(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round the named columns in place, half up (Spark ``round``: exact on
    decimals, and on the decimal value of a double); other columns untouched."""
    return df.select(*[F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c)
                       for c in df.columns])

"""Customer segments, RFM scores and the customer feature table.

Segment thresholds are quantiles of ``total_spend`` over all customers of the
360 (zeros included). ``method="exact"`` computes them with the distributed
selection of ``emporia.functions.quantiles`` (small jobs that return scalars);
``method="approx"`` with one ``percentile_approx`` job (bounded sketches).
Either way they are applied as literals.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.money import cents, cents_to_double, ratio_half_up
from emporia.functions.quantiles import (
    approx_quantiles_row,
    exact_quantiles,
    exact_quantiles_many,
)
from emporia.functions.rules import segment_of
from emporia.operators.shares import with_share

SEGMENT_PROBS = (0.75, 0.50)
RFM_PROBS = (0.2, 0.4, 0.6, 0.8)


def _exact_spend_thresholds(c360: DataFrame) -> tuple[float | None, float | None]:
    p75, p50 = exact_quantiles(c360, "total_spend", list(SEGMENT_PROBS))
    return (None if p75 is None else float(round(p75, 4)),
            None if p50 is None else float(round(p50, 4)))


def spend_thresholds(c360: DataFrame, method: str = "exact") -> DataFrame:
    """One row: ``p75``, ``p50`` of ``total_spend`` (4 decimals)."""
    if method == "exact":
        p75, p50 = _exact_spend_thresholds(c360)
        return c360.sparkSession.createDataFrame([(p75, p50)], "p75 double, p50 double")
    if method == "approx":
        return approx_quantiles_row(c360, "total_spend", list(SEGMENT_PROBS), ["p75", "p50"])
    raise ValueError(f"unknown quantile method {method!r}")


def spend_quantiles_checked(c360: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """``(prob, customers, within_bound)``: is the rank of each approximate threshold
    within ``1 / accuracy`` (and one row) of the wanted one?"""
    row = spend_thresholds(c360, "approx").first()
    x = F.col("total_spend")
    pairs = list(zip(SEGMENT_PROBS, (row["p75"], row["p50"])))
    counts = [F.count(x).alias("n")]
    for i, (_, v) in enumerate(pairs):
        counts += [F.count_if(x < F.lit(v)).alias(f"lt{i}"), F.count_if(x <= F.lit(v)).alias(f"le{i}")]
    n = c360.agg(*counts).first()
    slack = n["n"] / accuracy + 1
    rows = [(p, n["n"], n[f"lt{i}"] - slack <= p * n["n"] <= n[f"le{i}"] + slack) for i, (p, _) in enumerate(pairs)]
    return c360.sparkSession.createDataFrame(rows, "prob double, customers long, within_bound boolean")


def segments_checked(c360: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Exact segments, and whether the approximate segment is as good as the sketch promises.

    ``within_bound`` needs two things: between each exact threshold and its approximation lie at most ``n / accuracy + 1``
    customers (ties with either not counted), and a customer whose two segments differ is one of them or tied.
    The first is counted in the rows and fails if a sketch is worse than its bound.
    """
    exact, rough = spend_thresholds(c360, "exact").first(), spend_thresholds(c360, "approx").first()
    x = F.col("total_spend")
    pairs = [(min(exact[p], rough[p]), max(exact[p], rough[p])) for p in ("p75", "p50") if exact[p] is not None]
    counts = c360.agg(F.count(x).alias("n"), *[F.count_if((x > lo) & (x < hi)).alias(f"between{i}")
                                               for i, (lo, hi) in enumerate(pairs)]).first()
    kept = all(counts[f"between{i}"] <= counts["n"] / accuracy + 1 for i in range(len(pairs)))
    near = F.lit(False)
    for lo, hi in pairs:
        near = near | x.between(lo, hi)
    own, other = (segment_of(x, F.lit(t["p75"]).cast("double"), F.lit(t["p50"]).cast("double"))
                  for t in (exact, rough))
    return c360.select("customer_id", "total_spend", own.alias("segment"),
                       (F.lit(kept) & ((own == other) | near)).alias("within_bound"))


def _with_thresholds(df: DataFrame, c360: DataFrame, method: str) -> DataFrame:
    """``df`` with literal columns ``p75``, ``p50``: the thresholds are two
    scalars (exact: distributed selection; approx: one ``percentile_approx``
    job), so no join is needed to apply them."""
    if method == "exact":
        p75, p50 = _exact_spend_thresholds(c360)
    elif method == "approx":
        row = spend_thresholds(c360, "approx").first()
        p75, p50 = row["p75"], row["p50"]
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    return df.withColumn("p75", F.lit(p75).cast("double")).withColumn(
        "p50", F.lit(p50).cast("double"))


def customer_segments(c360: DataFrame, method: str = "exact") -> DataFrame:
    """The notebook 360 plus ``segment``: > p75 VIP, > p50 Regular, > 0 Occasional, else Browse-only."""
    return (_with_thresholds(c360, c360, method)
            .withColumn("segment", segment_of("total_spend", "p75", "p50"))
            .drop("p75", "p50"))


def segment_share(seg: DataFrame) -> DataFrame:
    counts = seg.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    return with_share(counts, "customers", "pct", 1).orderBy(F.desc("customers"), "segment")


def segment_avg_spend(seg: DataFrame) -> DataFrame:
    return (seg.groupBy("segment")
            .agg(F.try_divide(F.sum(cents("total_spend")).cast("double"),
                              F.count("total_spend") * 100).alias("avg_spend"))
            .orderBy("avg_spend", "segment"))


def segment_summary(seg: DataFrame) -> DataFrame:
    return (seg.groupBy("segment")
            .agg(F.count("customer_id").alias("customers"),
                 ratio_half_up(F.sum(cents("total_spend")), F.count("total_spend") * 100, 2)
                  .alias("avg_spend"),
                 ratio_half_up(F.sum("total_orders"), F.count("total_orders"), 2)
                  .alias("avg_orders"))
            .orderBy("segment"))


def _score(col: str, cuts, reverse: bool = False):
    above = sum((F.col(col) > F.lit(float(c))).cast("int") for c in cuts) if cuts else F.lit(0)
    return (F.lit(5) - above) if reverse else (F.lit(1) + above)


def _recency(as_of):
    return F.datediff(F.lit(as_of), F.to_date("last_purchase_date")).cast("bigint")


def rfm_cuts(c360: DataFrame, as_of: _dt.date | None = None):
    """``as_of`` and the exact quintile cut points of recency, frequency, monetary
    over customers with a completed order (scalars from small distributed jobs)."""
    buyers = c360.filter(F.col("total_orders") > 0)
    as_of = _as_of(c360, as_of)
    base = buyers.select(_recency(as_of).alias("r"), F.col("total_orders").alias("f"),
                         F.col("total_spend").alias("m"))
    got = exact_quantiles_many(base, {c: list(RFM_PROBS) for c in ("r", "f", "m")})
    cuts = [[] if got[c][0] is None else got[c] for c in ("r", "f", "m")]
    return as_of, cuts[0], cuts[1], cuts[2]


def _as_of(c360: DataFrame, as_of: _dt.date | None) -> _dt.date:
    if as_of is not None:
        return as_of
    last = (c360.filter(F.col("total_orders") > 0)
                .agg(F.max(F.to_date("last_purchase_date")).alias("d")).first()["d"])
    return (last or _dt.date(1970, 1, 1)) + _dt.timedelta(days=1)


def _feature_cuts(c360: DataFrame, as_of: _dt.date | None):
    """Spend thresholds over all customers and RFM cut points over buyers, from
    one distributed selection (non-buyers are null in the RFM columns)."""
    as_of = _as_of(c360, as_of)
    buyer = F.col("total_orders") > 0
    values = c360.select(F.col("total_spend").alias("s"),
                         F.when(buyer, _recency(as_of)).alias("r"),
                         F.when(buyer, F.col("total_orders")).alias("f"),
                         F.when(buyer, F.col("total_spend")).alias("m"))
    got = exact_quantiles_many(values, {"s": list(SEGMENT_PROBS), "r": list(RFM_PROBS),
                                        "f": list(RFM_PROBS), "m": list(RFM_PROBS)})
    p75, p50 = [None if q is None else float(round(q, 4)) for q in got["s"]]
    cuts = tuple([] if got[c][0] is None else got[c] for c in ("r", "f", "m"))
    return as_of, (p75, p50), cuts


def rfm_scores(c360: DataFrame, as_of: _dt.date | None = None) -> DataFrame:
    """Recency / frequency / monetary scores 1-5 for customers with a completed order.

    ``recency_days`` = days from the last purchase to ``as_of`` (default: the
    day after the latest purchase in the data). Cut points are the exact
    quintiles of each measure over those customers; more recent, more
    frequent and higher spend score higher.
    """
    as_of, rc, fc, mc = rfm_cuts(c360, as_of)
    base = c360.filter(F.col("total_orders") > 0).select(
        "customer_id", _recency(as_of).alias("recency_days"),
        F.col("total_orders").alias("frequency"), F.col("total_spend").alias("monetary"))
    return base.select("customer_id", "recency_days", "frequency", "monetary",
                       _score("recency_days", rc, reverse=True).alias("r_score"),
                       _score("frequency", fc).alias("f_score"),
                       _score("monetary", mc).alias("m_score")) \
        .withColumn("rfm", F.concat(F.col("r_score").cast("string"), F.col("f_score").cast("string"),
                                    F.col("m_score").cast("string")))


def customer_features(core: DataFrame, c360_notebook: DataFrame, c360: DataFrame,
                      method: str = "exact", as_of: _dt.date | None = None) -> DataFrame:
    """Feature table, one row per customer, as a single projection of the 360 core.

    Measures keep nulls where a source is absent (no zero-filling), with
    ``has_*`` flags; plus the spend segment, RFM scores (null without a
    completed order) and ``snapshot_date`` = ``as_of``. Thresholds and cut
    points are literals, so no join is added.
    """
    if method == "exact":
        # one selection for the spend thresholds and the three RFM cut points
        as_of, (p75, p50), (rc, fc, mc) = _feature_cuts(c360, as_of)
        with_th = core.withColumn("p75", F.lit(p75).cast("double")).withColumn(
            "p50", F.lit(p50).cast("double"))
    else:
        as_of, rc, fc, mc = rfm_cuts(c360, as_of)
        with_th = _with_thresholds(core, c360_notebook, method)
    has_orders = F.col("order_rows") > 0
    spend0 = F.coalesce(cents_to_double("spend"), F.lit(0.0))
    feats = with_th.select(
        "customer_id",
        (F.col("web_rows") > 0).alias("has_web"),
        has_orders.alias("has_orders"),
        (F.col("review_rows") > 0).alias("has_reviews"),
        (F.col("social_rows") > 0).alias("has_social"),
        "web_clicks", "sessions",
        F.try_divide(F.col("duration_sum").cast("double"), F.col("duration_n")).alias("avg_session_sec"),
        "total_orders",
        F.when(has_orders, spend0).alias("total_spend"),
        F.try_divide(cents_to_double("spend"), F.col("spend_n")).alias("avg_order_value"),
        "last_purchase_date",
        "reviews_written",
        ratio_half_up("rating_sum", "rating_n", 2).alias("avg_rating_given"),
        "social_posts",
        F.when(F.col("social_rows") > 0, F.coalesce(F.col("social_likes"), F.lit(0)))
         .alias("social_likes"),
        segment_of(spend0, "p75", "p50").alias("segment"),
        F.when(F.col("total_orders") > 0, _recency(as_of)).alias("recency_days"),
        spend0.alias("monetary"),
    )
    buyer = F.col("total_orders") > 0
    return (feats
            .withColumn("r_score", F.when(buyer, _score("recency_days", rc, reverse=True)))
            .withColumn("f_score", F.when(buyer, _score("total_orders", fc)))
            .withColumn("m_score", F.when(buyer, _score("monetary", mc)))
            .drop("monetary")
            .withColumn("snapshot_date", F.lit(as_of)))

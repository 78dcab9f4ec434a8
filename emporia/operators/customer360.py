"""Customer 360: one row per customer over web, orders, reviews and social.

Two plans compute the same table:

* ``customer_360`` (default): each source is projected to a common narrow
  schema, the four projections are unioned and aggregated by ``customer_id``
  once. Every source is scanned once and partially aggregated on the map
  side, and there is no join at all: one shuffle on the customer key (plus
  the distinct-session step), whatever the number of sources.
* ``customer_360_join``: per-source aggregates chained with full outer joins
  on ``customer_id`` (the reference's shape); three sort-merge joins. Kept as
  the cross-check of the union plan.

Null customer ids are dropped on all four sides. Numeric columns are
zero-filled, ``last_purchase_date`` stays null. Spend is the gross stored
amount of delivered or shipped orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.money import cents, cents_to_double, ratio_half_up
from emporia.functions.rules import is_completed

NUMERIC_360 = ("web_clicks", "sessions", "avg_session_sec", "total_orders", "total_spend",
               "avg_order_value", "reviews_written", "avg_rating_given", "social_posts",
               "social_likes")


def _known(df: DataFrame) -> DataFrame:
    return df.filter(F.col("customer_id").isNotNull())


def union_rows(weblogs: DataFrame, transactions: DataFrame, reviews: DataFrame,
               social: DataFrame) -> DataFrame:
    """The four sources projected to one narrow schema and unioned (no shuffle)."""
    web = _known(weblogs).select(
        "customer_id", F.lit("w").alias("_src"), "event_id", "session_id", "duration_sec")
    txn = _known(transactions).filter(is_completed("status")).select(
        "customer_id", F.lit("t").alias("_src"), "order_id",
        cents("total_amount").alias("amount_cents"), F.col("timestamp").alias("_purchase_ts"))
    rev = _known(reviews).select("customer_id", F.lit("r").alias("_src"), "review_id", "rating")
    soc = _known(social).select("customer_id", F.lit("s").alias("_src"), "post_id", "likes")
    return (web.unionByName(txn, allowMissingColumns=True)
               .unionByName(rev, allowMissingColumns=True)
               .unionByName(soc, allowMissingColumns=True))


def partial_aggs(distinct_sessions: bool = True) -> list:
    """Per-customer aggregates over union rows. Everything except the session
    count is a sum, count or max, hence mergeable across batches."""
    aggs = [
        F.count_if(F.col("_src") == "w").alias("web_rows"),
        F.count("event_id").alias("web_clicks"),
        F.sum("duration_sec").alias("duration_sum"),
        F.count("duration_sec").alias("duration_n"),
        F.count_if(F.col("_src") == "t").alias("order_rows"),
        F.count("order_id").alias("total_orders"),
        F.sum("amount_cents").alias("spend"),
        F.count("amount_cents").alias("spend_n"),
        F.max("_purchase_ts").alias("last_purchase_date"),
        F.count_if(F.col("_src") == "r").alias("review_rows"),
        F.count("review_id").alias("reviews_written"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
        F.count_if(F.col("_src") == "s").alias("social_rows"),
        F.count("post_id").alias("social_posts"),
        F.sum("likes").alias("social_likes"),
    ]
    if distinct_sessions:
        aggs.insert(2, F.count_distinct("session_id").alias("sessions"))
    return aggs


def customer_360_core(weblogs: DataFrame, transactions: DataFrame, reviews: DataFrame,
                      social: DataFrame) -> DataFrame:
    """Per-customer sums and counts (nulls where a source is absent)."""
    rows = union_rows(weblogs, transactions, reviews, social)
    return rows.groupBy("customer_id").agg(*partial_aggs())


def finish_360(core: DataFrame, notebook: bool = False) -> DataFrame:
    """Public 360 columns from the core: zero-filled counts and sums, averages
    from sum and count (rounded to 1 and 2 decimals in the notebook variant)."""
    if notebook:
        avg_session = ratio_half_up("duration_sum", "duration_n", 1)
        avg_order = ratio_half_up("spend", F.col("spend_n") * 100, 2)
    else:
        avg_session = F.try_divide(F.col("duration_sum").cast("double"), F.col("duration_n"))
        avg_order = F.try_divide(cents_to_double("spend"), F.col("spend_n"))
    cols = [
        F.col("customer_id"),
        F.col("web_clicks"),
        F.col("sessions"),
        F.coalesce(avg_session, F.lit(0.0)).alias("avg_session_sec"),
        F.col("total_orders"),
        F.coalesce(cents_to_double("spend"), F.lit(0.0)).alias("total_spend"),
        F.coalesce(avg_order, F.lit(0.0)).alias("avg_order_value"),
    ]
    if not notebook:
        cols.append(F.col("last_purchase_date"))
    cols += [
        F.col("reviews_written"),
        F.coalesce(ratio_half_up("rating_sum", "rating_n", 2), F.lit(0.0)).alias("avg_rating_given"),
        F.col("social_posts"),
        F.coalesce(F.col("social_likes"), F.lit(0)).alias("social_likes"),
    ]
    return core.select(*cols)


def customer_360(weblogs, transactions, reviews, social) -> DataFrame:
    """The unified view, union plan. Unsorted: it has one row per customer;
    use ``top_by_spend`` for a presentation slice."""
    return finish_360(customer_360_core(weblogs, transactions, reviews, social), notebook=False)


def customer_360_notebook(weblogs, transactions, reviews, social) -> DataFrame:
    """The notebook's variant: no purchase date, averages rounded (1 and 2 decimals)."""
    return finish_360(customer_360_core(weblogs, transactions, reviews, social), notebook=True)


def customer_360_join(weblogs, transactions, reviews, social) -> DataFrame:
    """Same table through per-source aggregates and a full outer join chain."""
    web = _known(weblogs).groupBy("customer_id").agg(
        F.count("event_id").alias("web_clicks"),
        F.count_distinct("session_id").alias("sessions"),
        F.try_divide(F.sum("duration_sec").cast("double"), F.count("duration_sec"))
         .alias("avg_session_sec"))
    txn = _known(transactions).filter(is_completed("status")).groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        cents_to_double(F.sum(cents("total_amount"))).alias("total_spend"),
        F.try_divide(cents_to_double(F.sum(cents("total_amount"))), F.count("total_amount"))
         .alias("avg_order_value"),
        F.max("timestamp").alias("last_purchase_date"))
    rev = _known(reviews).groupBy("customer_id").agg(
        F.count("review_id").alias("reviews_written"),
        ratio_half_up(F.sum("rating"), F.count("rating"), 2).alias("avg_rating_given"))
    soc = _known(social).groupBy("customer_id").agg(
        F.count("post_id").alias("social_posts"), F.sum("likes").alias("social_likes"))
    joined = (web.join(txn, on="customer_id", how="outer")
                 .join(rev, on="customer_id", how="outer")
                 .join(soc, on="customer_id", how="outer"))
    return joined.fillna(0, subset=list(NUMERIC_360)).select(
        "customer_id", "web_clicks", "sessions", "avg_session_sec", "total_orders", "total_spend",
        "avg_order_value", "last_purchase_date", "reviews_written", "avg_rating_given",
        "social_posts", "social_likes")


def top_by_spend(c360: DataFrame, n: int = 10) -> DataFrame:
    """Top customers by spend (``head(10)`` of the notebook), ties by id."""
    return c360.orderBy(F.desc("total_spend"), F.asc("customer_id")).limit(n)

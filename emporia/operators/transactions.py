"""Orders: revenue, products, customer spend, payment methods, daily revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporia.functions.money import cents, cents_to_double, net_amount, net_cents
from emporia.functions.rules import is_completed, is_not_cancelled
from emporia.operators.asof import as_of_join
from emporia.operators.shares import value_counts, with_share
from emporia.operators.trends import trending_growth


def with_net_amount(t: DataFrame) -> DataFrame:
    """Add ``net_amount`` = total after the percentage discount, exact to the cent."""
    return t.withColumn("net_amount", net_amount("total_amount", "discount_pct"))


def _with_net_cents(t: DataFrame) -> DataFrame:
    return t.withColumn("_net", net_cents("total_amount", "discount_pct"))


def not_cancelled(t: DataFrame) -> DataFrame:
    return t.filter(is_not_cancelled("status"))


def completed(t: DataFrame) -> DataFrame:
    return t.filter(is_completed("status"))


def _money(sum_col: str):
    return cents_to_double(F.col(sum_col))


def _avg(sum_col: str, n_col: str):
    return F.try_divide(cents_to_double(F.col(sum_col)), F.col(n_col))


def revenue_by_category(t: DataFrame) -> DataFrame:
    return (not_cancelled(_with_net_cents(t)).groupBy("category")
            .agg(F.sum("_net").alias("_rev"), F.count("order_id").alias("orders"),
                 F.count("_net").alias("_n"))
            .select("category", _money("_rev").alias("total_revenue"), "orders",
                    _avg("_rev", "_n").alias("avg_order_value"))
            .orderBy(F.desc("total_revenue"), F.asc_nulls_last("category")))


def top_products(t: DataFrame, n: int = 10) -> DataFrame:
    return (not_cancelled(_with_net_cents(t)).groupBy("product_id", "product_name")
            .agg(F.sum("quantity").alias("units_sold"), F.sum("_net").alias("_rev"))
            .orderBy(F.desc_nulls_last("_rev"), F.asc_nulls_last("product_id"),
                     F.asc_nulls_last("product_name"))
            .limit(n)
            .select("product_id", "product_name", "units_sold",
                    _money("_rev").alias("revenue")))


def customer_spend(t: DataFrame) -> DataFrame:
    return (completed(_with_net_cents(t)).groupBy("customer_id")
            .agg(F.count("order_id").alias("total_orders"), F.sum("_net").alias("_spend"),
                 F.count("_net").alias("_n"), F.max("timestamp").alias("last_order_date"))
            .select("customer_id", "total_orders",
                    _money("_spend").alias("total_spend"),
                    _avg("_spend", "_n").alias("avg_order_value"), "last_order_date"))


def payment_method_stats(t: DataFrame) -> DataFrame:
    """All statuses; ``total_amount`` is the net amount, as in the reference."""
    return (_with_net_cents(t).groupBy("payment_method")
            .agg(F.count("order_id").alias("transactions"),
                 cents_to_double(F.sum("_net")).alias("total_amount"))
            .orderBy(F.desc("transactions"), F.asc_nulls_last("payment_method")))


def daily_revenue(t: DataFrame) -> DataFrame:
    return (not_cancelled(_with_net_cents(t))
            .groupBy(F.to_date("timestamp").alias("order_date"))
            .agg(cents_to_double(F.sum("_net")).alias("revenue"),
                 F.count("order_id").alias("orders"))
            .orderBy("order_date"))


def revenue_by_category_completed(t: DataFrame) -> DataFrame:
    """Delivered or shipped only, stored (gross) amount."""
    return (completed(t).groupBy("category")
            .agg(F.sum(cents("total_amount")).alias("_rev"), F.count("order_id").alias("orders"),
                 F.count("total_amount").alias("_n"))
            .select("category", _money("_rev").alias("total_revenue"), "orders",
                    _avg("_rev", "_n").alias("avg_order"))
            .orderBy(F.desc("total_revenue"), F.asc_nulls_last("category")))


def status_distribution(t: DataFrame) -> DataFrame:
    return with_share(value_counts(t, "status", "count"), "count", "pct", 1) \
        .orderBy(F.desc("count"), "status")


def monthly_features(t: DataFrame) -> DataFrame:
    """Feature snapshots at the end of each month with an order of the customer: ``customer_id, as_of, lines_so_far,
    spend_so_far`` (gross); orders without a customer or a time don't count."""
    monthly = (t.where("customer_id IS NOT NULL AND timestamp IS NOT NULL")
               .groupBy("customer_id", F.trunc(F.to_date("timestamp"), "month").alias("mon"))
               .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("total_amount")).alias("spend")))
    so_far = Window.partitionBy("customer_id").orderBy("mon")   # a row a customer and month
    return monthly.select("customer_id", F.add_months("mon", 1).alias("as_of"), F.sum("n").over(so_far).alias("lines_so_far"),
                          cents_to_double(F.sum("spend").over(so_far)).alias("spend_so_far"))


def features_as_of(t: DataFrame) -> DataFrame:
    """Each order line with its customer's last monthly snapshot at or before it."""
    lines = t.select("order_id", "product_id", "customer_id", F.to_date("timestamp").alias("order_date"))
    return as_of_join(lines, monthly_features(t), "customer_id", "order_date", "as_of", block_days=365)


def trending_products(t: DataFrame) -> DataFrame:
    """Products whose sales in the latest year stand out most against the three years before."""
    return trending_growth(t.select("product_id", F.year("timestamp").alias("year")), "product_id", "year")

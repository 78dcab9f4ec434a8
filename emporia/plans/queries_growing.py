"""Results kept up to date by change, joins by time, trends and sketches, registered with oracle SQL.

Each query builds its state from the driver's whole tables in several steps (lands, promotes, replaces, runs slices of
time, streams) and returns the result after the last one; the SQL states the same result from the tables at once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.functions import sketches as sk
from emporia.operators import sessions as ss
from emporia.operators import transactions as tx
from emporia.plans.incremental import VIEWS, IncrementalViews
from emporia.plans.queries_c360 import C360_SQL
from emporia.plans.queries_stream import LANDING_FILES
from emporia.plans.registry import register
from emporia.session import scratch_path
from emporia.sources.fixtures import load_sources, transactions, weblogs, with_sources
from emporia.sources.lake import Lake
from emporia.streaming.customer360_feed import RunningCustomer360, feed_rows
from emporia.streaming.sources import land_in_time_order, landing_rows

_W = with_sources("weblogs")
_T = with_sources("transactions")


@register("publish_incremental", _W + """,
kept AS (SELECT * FROM weblogs
         WHERE NOT (CAST("timestamp" AS DATE) = (SELECT max(CAST("timestamp" AS DATE)) FROM weblogs)
                    AND event_id % 5 = 0))
SELECT page, count(event_id) AS total_views, count(DISTINCT session_id) AS unique_sessions,
       CAST(sum(duration_sec) AS DOUBLE) / count(duration_sec) AS avg_duration_sec
FROM kept GROUP BY page""")
def q_publish_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page popularity is published, the latest day lands again without every fifth event, and the view is refreshed by
    that day alone."""
    src = weblogs(spark, sf_dir)
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.ingest_raw("weblogs", src, date=F.col("timestamp"))
    lake.promote("weblogs", src.schema)
    root = scratch_path(spark, "incremental")
    views, view = IncrementalViews(lake, root), VIEWS["page_popularity"]
    table = "emporia_pages_" + root.rsplit("-", 1)[-1]
    views.publish(view, None, table)
    day = lake.dates("raw", "weblogs")[-1]
    lake.ingest_raw("weblogs", src.where((F.to_date("timestamp") == F.lit(day).cast("date")) & F.expr("event_id % 5 <> 0")),
                    date=day)
    lake.promote("weblogs", src.schema, date=day)
    return spark.table(views.publish(view, None, table))


@register("session_stats_incremental", _W + """,
o AS (SELECT *, lag("timestamp") OVER (PARTITION BY customer_id ORDER BY "timestamp") AS prev
      FROM weblogs WHERE customer_id IS NOT NULL AND "timestamp" IS NOT NULL),
g AS (SELECT *, sum(CASE WHEN prev IS NULL OR "timestamp" >= prev + INTERVAL 30 minute THEN 1 ELSE 0 END)
                  OVER (PARTITION BY customer_id ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT customer_id, min("timestamp") AS session_start, max("timestamp") AS session_end, count(event_id) AS clicks,
       CAST(sum(duration_sec) AS BIGINT) AS total_time_sec
FROM g GROUP BY customer_id, sid""")
def q_session_stats_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap sessions of all events, by four runs over slices of time that carry open sessions on."""
    src = weblogs(spark, sf_dir)
    first, last = src.agg(F.min("timestamp"), F.max("timestamp")).first()
    runs = ss.SessionRuns(spark, scratch_path(spark, "session-runs"))
    for k in range(1, 5):
        end = last + _dt.timedelta(seconds=1) if k == 4 else first + (last - first) * k / 4
        runs.run(src, end)
    return runs.sessions()


@register("stream_customer_360_changes", C360_SQL)
def q_stream_customer_360_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's last row in the change feed of the running 360."""
    s = load_sources(spark, sf_dir)
    rows = feed_rows(s["weblogs"], s["transactions"], s["reviews"], s["social"])
    rows = rows.withColumn("_t", F.coalesce(F.col("_event_ts").cast("date"), F.col("_purchase_ts").cast("date"),
                                            F.lit("1970-01-01").cast("date")).cast("timestamp_ntz"))
    landing = scratch_path(spark, "landing-360-feed")
    per_slice = land_in_time_order(rows, landing, "_t", LANDING_FILES)
    stream = landing_rows(spark, landing, rows.schema, max_files_per_trigger=per_slice)
    feed = RunningCustomer360(spark, scratch_path(spark, "c360-feed"), buckets=spark.sparkContext.defaultParallelism)
    (stream.writeStream.foreachBatch(feed.sink()).option("checkpointLocation", scratch_path(spark, "c360-feed-ck"))
     .trigger(availableNow=True).start().awaitTermination())
    changes = feed.changes()
    cols = [c for c in changes.columns if c not in ("customer_id", "batch_id")]
    return (changes.groupBy("customer_id").agg(F.max_by(F.struct(*cols), "batch_id").alias("r"))
            .select("customer_id", *[F.col(f"r.{c}").alias(c) for c in cols]))


@register("features_as_of", _T + """,
m AS (SELECT customer_id, date_trunc('month', "timestamp") AS mon, count(*) AS n, sum(total_amount) AS spend
      FROM transactions WHERE customer_id IS NOT NULL AND "timestamp" IS NOT NULL GROUP BY 1, 2),
snap AS (SELECT customer_id, CAST(mon + INTERVAL 1 month AS DATE) AS as_of,
                CAST(sum(n) OVER w AS BIGINT) AS lines_so_far, CAST(sum(spend) OVER w AS DOUBLE) AS spend_so_far
         FROM m WINDOW w AS (PARTITION BY customer_id ORDER BY mon))
SELECT t.order_id, t.product_id, t.customer_id, CAST(t."timestamp" AS DATE) AS order_date,
       s.as_of, s.lines_so_far, s.spend_so_far
FROM transactions t ASOF LEFT JOIN snap s ON t.customer_id = s.customer_id AND CAST(t."timestamp" AS DATE) >= s.as_of""")
def q_features_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order line with its customer's last monthly feature snapshot before it."""
    return tx.features_as_of(transactions(spark, sf_dir))


@register("trending_growth", _T + """,
y AS (SELECT product_id AS item, year("timestamp") AS w FROM transactions
      WHERE product_id IS NOT NULL AND "timestamp" IS NOT NULL),
last AS (SELECT w, row_number() OVER (ORDER BY w DESC) AS k FROM (SELECT DISTINCT w FROM y)),
c AS (SELECT item, count(*) FILTER (k = 1) AS mentions, count(*) FILTER (k > 1) AS before
      FROM y JOIN last USING (w) WHERE k <= 4 GROUP BY item)
SELECT item, mentions, before, CAST(mentions * 3 + 3 AS DOUBLE) / (before + 3) AS growth
FROM c WHERE mentions >= 5 ORDER BY growth DESC, mentions DESC, item LIMIT 20""")
def q_trending_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products whose sales in the latest year stand out most against the three years before."""
    return tx.trending_products(transactions(spark, sf_dir))


@register("spend_quantiles_by_range", _T + """,
d AS (SELECT CAST("timestamp" AS DATE) AS d, CAST(total_amount AS DOUBLE) AS x FROM transactions),
r AS (SELECT min(d) + 365 AS a, max(d) - 365 AS b FROM d)
SELECT p.prob, (SELECT count(x) FROM d, r WHERE d BETWEEN a AND b) AS n, TRUE AS within_bound
FROM (VALUES (0.5::DOUBLE), (0.75::DOUBLE), (0.99::DOUBLE)) p(prob)""")
def q_spend_quantiles_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of line amounts of a range of days from their daily KLL sketches, and whether the exact rank of each
    is within the sketch's bound (a check that can fail: ranks are counted in the rows)."""
    t = transactions(spark, sf_dir).select(F.to_date("timestamp").alias("d"), F.col("total_amount").cast("double").alias("x"))
    path = scratch_path(spark, "kll-days")
    sk.day_quantile_sketches(t, "d", "x").write.parquet(path)
    days = spark.read.parquet(path)
    a, b = t.agg(F.date_add(F.min("d"), 365), F.date_sub(F.max("d"), 365)).first()
    found = sk.quantiles_of_range(days, a, b, [0.5, 0.75, 0.99]).collect()
    ranks = t.where(F.col("d").between(F.lit(a), F.lit(b))).agg(F.count("x").alias("n"), *[
        f(cond).alias(f"{name}{i}") for i, r in enumerate(found)
        for name, f, cond in (("lt", F.count_if, F.col("x") < r.value), ("le", F.count_if, F.col("x") <= r.value))])
    e = sk.rank_error()
    return ranks.select(F.inline(F.array(*[F.struct(
        F.lit(r.prob).alias("prob"), F.col("n"),
        ((F.col(f"lt{i}") / F.col("n") - e <= r.prob) & (F.col(f"le{i}") / F.col("n") + e >= r.prob)
         & (F.col("n") == r.n)).alias("within_bound")) for i, r in enumerate(found)])))


@register("active_customers_overlap", with_sources("weblogs", "transactions") + """,
w AS (SELECT DISTINCT dayofweek("timestamp") + 1 AS day, customer_id FROM weblogs
      WHERE customer_id IS NOT NULL AND "timestamp" IS NOT NULL),
t AS (SELECT DISTINCT dayofweek("timestamp") + 1 AS day, customer_id FROM transactions
      WHERE customer_id IS NOT NULL AND "timestamp" IS NOT NULL),
j AS (SELECT coalesce(w.day, t.day) AS day, w.customer_id AS a, t.customer_id AS b
      FROM w FULL JOIN t ON w.day = t.day AND w.customer_id = t.customer_id)
SELECT CAST(day AS INTEGER) AS day, count(a) AS web, count(b) AS buying, count(*) AS either,
       count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS "both", TRUE AS within_bound
FROM j GROUP BY day""")
def q_active_customers_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers active on the web and buying, by weekday: exact counts, and whether those estimated from Theta sketches
    lie within five standard errors of the larger set."""
    sides = {}
    for name, df in (("a", weblogs(spark, sf_dir)), ("b", transactions(spark, sf_dir))):
        sides[name] = df.where("customer_id IS NOT NULL AND timestamp IS NOT NULL").select(
            F.dayofweek("timestamp").alias("day"), F.col("customer_id").alias("id"))
    rough = sk.overlap(*[sk.day_id_sketches(sides[k], "day", "id") for k in "ab"])
    pairs = sides["a"].withColumn("a", F.lit(1)).unionByName(sides["b"].withColumn("b", F.lit(1)), allowMissingColumns=True)
    exact = (pairs.groupBy("day", "id").agg(F.max("a").alias("a"), F.max("b").alias("b")).groupBy("day")
             .agg(F.count("a").alias("web"), F.count("b").alias("buying"), F.count(F.lit(1)).alias("either"),
                  F.count(F.col("a") + F.col("b")).alias("both")))
    slack = F.lit(5.0) / (2 ** sk.LG) ** 0.5 * F.col("either")
    near = [F.abs(F.col(e) - F.col(r)) <= slack for e, r in (("web", "n_a"), ("buying", "n_b"), ("either", "n_either"),
                                                            ("both", "n_both"))]
    return exact.join(rough, "day").select("day", "web", "buying", "either", "both",
                                           (near[0] & near[1] & near[2] & near[3]).alias("within_bound"))

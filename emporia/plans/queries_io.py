"""Sources, sinks and the lake, registered as round trips over whole tables.

Each query writes a source or a result derived from the driver's tables to a
fresh folder under the session's checkpoint folder, reads it back with a
declared schema and returns it; the oracle is the same data in SQL.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from emporia.operators import transactions as tx
from emporia.operators import weblogs as wl
from emporia.plans.queries_batch import NET
from emporia.plans.registry import register
from emporia.session import remove_scratch, scratch_path, shuffles_freed
from emporia.sources import files
from emporia.sources.fixtures import reviews, social, transactions, weblogs, with_sources
from emporia.sources.lake import Lake

_W = with_sources("weblogs")
_T = with_sources("transactions")


@register("scan_json", _T + "SELECT * FROM transactions")
def q_scan_json(spark, sf_dir):
    src = transactions(spark, sf_dir)
    path = scratch_path(spark, "scan_json")
    files.save_results(src, path, "json")
    good, _bad = files.split_quarantine(files.scan_json(spark, path, src.schema))
    return good


@register("scan_json_failfast", _T + "SELECT * FROM transactions")
def q_scan_json_failfast(spark, sf_dir):
    src = transactions(spark, sf_dir)
    path = scratch_path(spark, "scan_json_ff")
    files.save_results(src, path, "json")
    return files.scan_json(spark, path, src.schema, mode="FAILFAST")


@register("scan_csv", with_sources("reviews") + "SELECT * FROM reviews")
def q_scan_csv(spark, sf_dir):
    src = reviews(spark, sf_dir)
    path = scratch_path(spark, "scan_csv")
    files.save_results(src, path, "csv")
    good, _bad = files.split_quarantine(files.scan_csv(spark, path, src.schema))
    return good


@register("scan_parquet", _W + "SELECT * FROM weblogs")
def q_scan_parquet(spark, sf_dir):
    src = weblogs(spark, sf_dir)
    path = scratch_path(spark, "scan_parquet")
    files.save_results(src, path, "parquet")
    return files.scan_parquet(spark, path)


def _sink_roundtrip(spark, df, fmt):
    path = scratch_path(spark, f"sink_{fmt}")
    files.save_results(df, path, fmt)
    if fmt == "parquet":
        return files.scan_parquet(spark, path)
    if fmt == "csv":
        return files.split_quarantine(files.scan_csv(spark, path, df.schema))[0]
    return files.scan_json(spark, path, df.schema, mode="FAILFAST")


_REV_BY_CAT = _T + f"""
SELECT category, CAST(sum(net) AS DOUBLE) AS total_revenue, count(order_id) AS orders,
       CAST(sum(net) AS DOUBLE) / count(net) AS avg_order_value
FROM (SELECT *, {NET} AS net FROM transactions WHERE status != 'cancelled') t
GROUP BY category"""

_PAGE_POP = _W + """
SELECT page, count(event_id) AS total_views, count(DISTINCT session_id) AS unique_sessions,
       CAST(sum(duration_sec) AS DOUBLE) / count(duration_sec) AS avg_duration_sec
FROM weblogs GROUP BY page"""


@register("sink_parquet", _W + """
SELECT session_id, customer_id, count(event_id) AS clicks,
       CAST(sum(duration_sec) AS BIGINT) AS total_time_sec,
       min("timestamp") AS session_start, max("timestamp") AS session_end
FROM weblogs GROUP BY session_id, customer_id""")
def q_sink_parquet(spark, sf_dir):
    return _sink_roundtrip(spark, wl.session_stats(weblogs(spark, sf_dir)), "parquet")


@register("sink_csv", _REV_BY_CAT)
def q_sink_csv(spark, sf_dir):
    return _sink_roundtrip(spark, tx.revenue_by_category(transactions(spark, sf_dir)), "csv")


@register("sink_json", _PAGE_POP)
def q_sink_json(spark, sf_dir):
    return _sink_roundtrip(spark, wl.page_popularity(weblogs(spark, sf_dir)), "json")


@register("json_roundtrip", with_sources("social") + "SELECT * FROM social")
def q_json_roundtrip(spark, sf_dir):
    src = social(spark, sf_dir)
    lines = src.select(files.encode_json_column(src))
    decoded = files.decode_json_column(lines, "value", src.schema)
    good, _ = files.split_quarantine(decoded)
    return good


@register("json_quarantine", """
SELECT text AS _corrupt_record FROM conversations WHERE NOT json_valid(text)""")
def q_json_quarantine(spark, sf_dir):
    """Valid social records mixed with raw conversation lines; the lines that
    are not JSON objects end up in quarantine with their raw text."""
    src = social(spark, sf_dir)
    good_lines = src.select(files.encode_json_column(src))
    raw_lines = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet") \
        .select(F.col("text").alias("value"))
    decoded = files.decode_json_column(good_lines.unionByName(raw_lines), "value", src.schema)
    _, bad = files.split_quarantine(decoded)
    return bad


@contextmanager
def once(df):
    """A source that a query lands several times, joined once into a work table, which goes when it has landed."""
    path = scratch_path(df.sparkSession, "source")
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    yield df.sparkSession.read.schema(df.schema).parquet(path)
    remove_scratch(df.sparkSession, path)


def _lake_with_weblogs(spark, sf_dir):
    src = weblogs(spark, sf_dir)
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.ingest_raw("weblogs", src, date=F.col("timestamp"))
    return lake, src.schema


_W_DATED = _W + 'SELECT *, CAST("timestamp" AS DATE) AS ingest_date FROM weblogs'


@register("lake_ingest_raw", _W_DATED)
def q_lake_ingest_raw(spark, sf_dir):
    lake, schema = _lake_with_weblogs(spark, sf_dir)
    return lake.read("raw", "weblogs", schema)


@register("lake_read_day", _W_DATED + """
WHERE CAST("timestamp" AS DATE) = (SELECT max(CAST("timestamp" AS DATE)) FROM weblogs)""")
def q_lake_read_day(spark, sf_dir):
    lake, schema = _lake_with_weblogs(spark, sf_dir)
    return lake.read("raw", "weblogs", schema, date=lake.dates("raw", "weblogs")[-1])


@register("lake_partitions", _W + """
SELECT CAST("timestamp" AS DATE) AS ingest_date, count(*) AS "rows" FROM weblogs GROUP BY 1""")
def q_lake_partitions(spark, sf_dir):
    lake, schema = _lake_with_weblogs(spark, sf_dir)
    return lake.partitions("raw", "weblogs", schema)


@register("lake_promote", _W_DATED)
def q_lake_promote(spark, sf_dir):
    lake, schema = _lake_with_weblogs(spark, sf_dir)
    lake.promote("weblogs", schema)
    return lake.read("processed", "weblogs")


@register("lake_promote_transactions", _T + """
SELECT *, (SELECT max(CAST("timestamp" AS DATE)) + 1 FROM transactions) AS ingest_date
FROM transactions
WHERE order_id IS NOT NULL AND total_amount >= 0 AND quantity > 0
  AND discount_pct BETWEEN 0 AND 100""")
def q_lake_promote_transactions(spark, sf_dir):
    """The whole order batch lands on one day (the landing date, the day after
    the latest order), then is promoted."""
    src = transactions(spark, sf_dir)
    landing = src.agg(F.date_add(F.max(F.to_date("timestamp")), 1)).first()[0]
    lake = Lake(spark, scratch_path(spark, "lake"))
    lake.ingest_raw("transactions", src, date=landing)
    lake.promote("transactions", src.schema)
    return lake.read("processed", "transactions")


@register("lake_promote_replaced", _W + """
SELECT event_id, "timestamp", session_id, customer_id, page, device, country, duration_sec,
       CASE WHEN event_id % 3 = 0 THEN DATE '2031-01-02' ELSE DATE '2031-01-01' END AS ingest_date
FROM weblogs WHERE event_id % 5 <> 0""")
def q_lake_promote_replaced(spark, sf_dir):
    """Day 1 lands all events (each twice), is promoted, lands again without every fifth and is promoted
    again; day 2 replays every third, of which the fifths are broken, and day 1 gives those up."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    with once(weblogs(spark, sf_dir)) as src:
        kept = src.where("event_id % 5 <> 0")
        lake.ingest_raw("weblogs", src.unionByName(src), date="2031-01-01")
        lake.promote("weblogs", src.schema, date="2031-01-01")
        lake.ingest_raw("weblogs", kept.unionByName(kept), date="2031-01-01")
        lake.promote("weblogs", src.schema, date="2031-01-01")
        broken = src.withColumn("duration_sec", F.when(F.col("event_id") % 5 == 0, F.lit(-1).cast("bigint"))
                                .otherwise(F.col("duration_sec")))
        lake.ingest_raw("weblogs", broken.where("event_id % 3 = 0"), date="2031-01-02")
    lake.promote("weblogs", src.schema, date="2031-01-02")
    return lake.read("processed", "weblogs").select(*src.columns, "ingest_date")


@register("lake_promote_replays", _T + """
SELECT *, DATE '2031-01-02' AS ingest_date FROM transactions
WHERE order_id IS NOT NULL AND total_amount >= 0 AND quantity > 0 AND discount_pct BETWEEN 0 AND 100""")
def q_lake_promote_replays(spark, sf_dir):
    """All order lines land on two days; the whole zone is promoted and holds each line once."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    with once(transactions(spark, sf_dir)) as src:
        lake.ingest_raw("transactions", src, date="2031-01-01")
        lake.ingest_raw("transactions", src, date="2031-01-02")
    lake.promote("transactions", src.schema)
    return lake.read("processed", "transactions").select(*src.columns, "ingest_date")


@register("lake_as_of", _W + """
SELECT *, DATE '2031-01-01' AS ingest_date FROM weblogs""")
def q_lake_as_of(spark, sf_dir):
    """All events are promoted, then the day lands again without every fifth and is promoted again; the first
    version still holds all."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    with once(weblogs(spark, sf_dir)) as src:
        lake.ingest_raw("weblogs", src, date="2031-01-01")
        first = lake.promote("weblogs", src.schema)
        lake.ingest_raw("weblogs", src.where("event_id % 5 <> 0"), date="2031-01-01")
    lake.promote("weblogs", src.schema, date="2031-01-01")
    return lake.as_of("weblogs", first)


@register("lake_lookup_customer", _W + """
SELECT *, CAST("timestamp" AS DATE) AS ingest_date FROM weblogs
WHERE customer_id IN (SELECT customer_id FROM weblogs WHERE customer_id IS NOT NULL
                      GROUP BY customer_id ORDER BY count(*) DESC, customer_id LIMIT 1)""")
def q_lake_lookup_customer(spark, sf_dir):
    """All rows of the most active customer: the promoted days are clustered by customer, and only files whose
    range and Bloom filter admit the id are read."""
    lake, schema = _lake_with_weblogs(spark, sf_dir)
    lake.promote("weblogs", schema)
    rows = lake.read("processed", "weblogs")
    most = (rows.where("customer_id IS NOT NULL").groupBy("customer_id").count()
            .orderBy(F.desc("count"), "customer_id").limit(1).collect())
    lake.cluster("weblogs", n_files=spark.sparkContext.defaultParallelism)
    return lake.lookup("weblogs", [r.customer_id for r in most])


@register("publish_views", _REV_BY_CAT)
def q_publish_views(spark, sf_dir):
    from emporia.plans.publish import publish_table

    root = scratch_path(spark, "views")
    table = "emporia_view_" + root.rsplit("-", 1)[-1]
    name = publish_table(spark, tx.revenue_by_category(transactions(spark, sf_dir)), table, root,
                         database=None)
    return spark.table(name)

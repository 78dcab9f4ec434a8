"""Customer 360, segments, RFM and features, registered with oracle SQL."""

from __future__ import annotations

from emporia.operators import customer360 as c3
from emporia.operators import segments as sg
from emporia.operators.clusters import rfm_clusters_checked
from emporia.plans.queries_batch import ratio_sql
from emporia.plans.registry import register
from emporia.session import scratch_path
from emporia.sources.fixtures import load_sources, with_sources

_ALL = with_sources("weblogs", "transactions", "reviews", "social")

_PARTS = """,
web AS (SELECT customer_id, count(*) AS web_rows, count(event_id) AS web_clicks,
               count(DISTINCT session_id) AS sessions,
               sum(duration_sec) AS duration_sum, count(duration_sec) AS duration_n
        FROM weblogs WHERE customer_id IS NOT NULL GROUP BY customer_id),
txn AS (SELECT customer_id, count(*) AS order_rows, count(order_id) AS total_orders,
               sum(total_amount) AS spend, count(total_amount) AS spend_n,
               max("timestamp") AS last_purchase_date
        FROM transactions WHERE customer_id IS NOT NULL AND status IN ('delivered', 'shipped')
        GROUP BY customer_id),
rev AS (SELECT customer_id, count(*) AS review_rows, count(review_id) AS reviews_written,
               sum(rating) AS rating_sum, count(rating) AS rating_n
        FROM reviews WHERE customer_id IS NOT NULL GROUP BY customer_id),
soc AS (SELECT customer_id, count(*) AS social_rows, count(post_id) AS social_posts,
               sum(likes) AS social_likes
        FROM social WHERE customer_id IS NOT NULL GROUP BY customer_id),
j AS (SELECT * FROM web
      FULL OUTER JOIN txn USING (customer_id)
      FULL OUTER JOIN rev USING (customer_id)
      FULL OUTER JOIN soc USING (customer_id))"""


def c360_select(notebook: bool) -> str:
    if notebook:
        avg_session = ratio_sql("duration_sum", "duration_n", 1)
        avg_order = ratio_sql("CAST(spend * 100 AS BIGINT)", "spend_n * 100", 2)
    else:
        avg_session = "CAST(duration_sum AS DOUBLE) / duration_n"
        avg_order = "CAST(spend AS DOUBLE) / spend_n"
    last = "" if notebook else "last_purchase_date,"
    return f"""
SELECT customer_id, coalesce(web_clicks, 0) AS web_clicks, coalesce(sessions, 0) AS sessions,
       coalesce({avg_session}, 0.0) AS avg_session_sec,
       coalesce(total_orders, 0) AS total_orders,
       coalesce(CAST(spend AS DOUBLE), 0.0) AS total_spend,
       coalesce({avg_order}, 0.0) AS avg_order_value, {last}
       coalesce(reviews_written, 0) AS reviews_written,
       coalesce({ratio_sql('rating_sum', 'rating_n', 2)}, 0.0) AS avg_rating_given,
       coalesce(social_posts, 0) AS social_posts,
       CAST(coalesce(social_likes, 0) AS BIGINT) AS social_likes
FROM j"""


C360_SQL = _ALL + _PARTS + c360_select(False)
C360_NB_SQL = _ALL + _PARTS + c360_select(True)

_NB_CTE = _ALL + _PARTS + ",\nc AS (" + c360_select(True) + ")"
_FULL_CTE = _ALL + _PARTS + ",\nc AS (" + c360_select(False) + ")"

_TH = """,
th AS (SELECT CAST(CAST(quantile_cont(total_spend, 0.75) AS DECIMAL(38,4)) AS DOUBLE) AS p75,
              CAST(CAST(quantile_cont(total_spend, 0.5) AS DECIMAL(38,4)) AS DOUBLE) AS p50
       FROM c)"""

_SEG_CASE = """CASE WHEN total_spend > p75 THEN 'VIP' WHEN total_spend > p50 THEN 'Regular'
            WHEN total_spend > 0 THEN 'Occasional' ELSE 'Browse-only' END"""

SEG_CTE = _NB_CTE + _TH + f",\nseg AS (SELECT c.*, {_SEG_CASE} AS segment FROM c, th)"

_RFM_CTE = _FULL_CTE + """,
a AS (SELECT max(CAST(last_purchase_date AS DATE)) + 1 AS as_of_date FROM c WHERE total_orders > 0),
b AS (SELECT customer_id,
             CAST(date_diff('day', CAST(last_purchase_date AS DATE), as_of_date) AS BIGINT) AS recency_days,
             total_orders AS frequency, total_spend AS monetary
      FROM c, a WHERE total_orders > 0),
q AS (SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS rq,
             quantile_cont(CAST(frequency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS fq,
             quantile_cont(CAST(monetary AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS mq FROM b)"""


def _above(col: str, q: str) -> str:
    return " + ".join(f"CAST({col} > {q}[{i}] AS INTEGER)" for i in range(1, 5))


def _sources(spark, sf_dir):
    s = load_sources(spark, sf_dir)
    return s["weblogs"], s["transactions"], s["reviews"], s["social"]


def _core_checkpointed(spark, sf_dir):
    """The 360 core, written once as Parquet under the shared checkpoint folder
    and read back: the quantile jobs that follow read only the columns they
    need instead of recomputing the four-source aggregate, and the lineage is
    cut (a lost executor never re-reads the sources)."""
    path = scratch_path(spark, "c360-core")
    c3.customer_360_core(*_sources(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@register("customer_360", C360_SQL)
def q_customer_360(spark, sf_dir):
    return c3.customer_360(*_sources(spark, sf_dir))


@register("customer_360_join", C360_SQL)
def q_customer_360_join(spark, sf_dir):
    return c3.customer_360_join(*_sources(spark, sf_dir))


@register("customer_360_notebook", C360_NB_SQL)
def q_customer_360_notebook(spark, sf_dir):
    return c3.customer_360_notebook(*_sources(spark, sf_dir))


@register("customer_360_top10", _NB_CTE + """
SELECT * FROM c ORDER BY total_spend DESC, customer_id ASC LIMIT 10""")
def q_customer_360_top10(spark, sf_dir):
    return c3.top_by_spend(c3.customer_360_notebook(*_sources(spark, sf_dir)), 10)


@register("spend_quantiles", _NB_CTE + _TH + "\nSELECT p75, p50 FROM th")
def q_spend_quantiles(spark, sf_dir):
    nb = c3.finish_360(_core_checkpointed(spark, sf_dir), notebook=True)
    return sg.spend_thresholds(nb, "exact")


@register("spend_quantiles_approx", _NB_CTE + """
SELECT p.prob, (SELECT count(total_spend) FROM c) AS customers, TRUE AS within_bound
FROM (VALUES (0.75::DOUBLE), (0.5::DOUBLE)) p(prob)""")
def q_spend_quantiles_approx(spark, sf_dir):
    """Whether each approximate threshold's rank is within the sketch's bound of the wanted rank."""
    nb = c3.finish_360(_core_checkpointed(spark, sf_dir), notebook=True)
    return sg.spend_quantiles_checked(nb)


def _segments(spark, sf_dir, method="exact"):
    nb = c3.finish_360(_core_checkpointed(spark, sf_dir), notebook=True)
    return sg.customer_segments(nb, method)


@register("customer_segments", SEG_CTE + "\nSELECT * FROM seg")
def q_customer_segments(spark, sf_dir):
    return _segments(spark, sf_dir)


@register("customer_segments_approx", SEG_CTE + """
SELECT customer_id, total_spend, segment, TRUE AS within_bound FROM seg""")
def q_customer_segments_approx(spark, sf_dir):
    """The exact segments, and whether the approximate one agrees or the spend lies between the
    exact and the approximate threshold."""
    nb = c3.finish_360(_core_checkpointed(spark, sf_dir), notebook=True)
    return sg.segments_checked(nb)


@register("segment_share", SEG_CTE + f"""
SELECT segment, count(*) AS customers,
       {ratio_sql('count(*)', '(SELECT count(*) FROM seg)', 1, 100)} AS pct
FROM seg GROUP BY segment""")
def q_segment_share(spark, sf_dir):
    return sg.segment_share(_segments(spark, sf_dir))


@register("segment_avg_spend", SEG_CTE + """
SELECT segment, CAST(sum(CAST(round(total_spend * 100) AS BIGINT)) AS DOUBLE)
                / (count(total_spend) * 100) AS avg_spend
FROM seg GROUP BY segment""")
def q_segment_avg_spend(spark, sf_dir):
    return sg.segment_avg_spend(_segments(spark, sf_dir))


@register("segment_summary", SEG_CTE + f"""
SELECT segment, count(customer_id) AS customers,
       {ratio_sql('sum(CAST(round(total_spend * 100) AS BIGINT))', 'count(total_spend) * 100', 2)}
         AS avg_spend,
       {ratio_sql('sum(total_orders)', 'count(total_orders)', 2)} AS avg_orders
FROM seg GROUP BY segment""")
def q_segment_summary(spark, sf_dir):
    return sg.segment_summary(_segments(spark, sf_dir))


@register("rfm_scores", _RFM_CTE + f"""
SELECT customer_id, recency_days, frequency, monetary,
       5 - ({_above('recency_days', 'rq')}) AS r_score,
       1 + ({_above('frequency', 'fq')}) AS f_score,
       1 + ({_above('monetary', 'mq')}) AS m_score,
       CAST(5 - ({_above('recency_days', 'rq')}) AS VARCHAR)
         || CAST(1 + ({_above('frequency', 'fq')}) AS VARCHAR)
         || CAST(1 + ({_above('monetary', 'mq')}) AS VARCHAR) AS rfm
FROM b, q""")
def q_rfm_scores(spark, sf_dir):
    c360 = c3.finish_360(_core_checkpointed(spark, sf_dir), notebook=False)
    return sg.rfm_scores(c360)


@register("rfm_clusters", _RFM_CTE + """
SELECT customer_id, recency_days, frequency, monetary, TRUE AS within_bound FROM b""")
def q_rfm_clusters(spark, sf_dir):
    """Six clusters of buyers by k-means||, and whether they are what Lloyd's steps must end in."""
    path = scratch_path(spark, "rfm")
    sg.rfm_scores(c3.finish_360(_core_checkpointed(spark, sf_dir), notebook=False)).write.parquet(path)
    return rfm_clusters_checked(spark.read.parquet(path))


_FEAT_SQL = SEG_CTE.replace(_ALL + _PARTS, _ALL + _PARTS + ",\nfull360 AS (" + c360_select(False) + ")", 1) + """,
a AS (SELECT max(CAST(last_purchase_date AS DATE)) + 1 AS as_of_date FROM full360 WHERE total_orders > 0),
b AS (SELECT customer_id,
             CAST(date_diff('day', CAST(last_purchase_date AS DATE), as_of_date) AS BIGINT) AS recency_days,
             total_orders AS frequency, total_spend AS monetary
      FROM full360, a WHERE total_orders > 0),
q AS (SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS rq,
             quantile_cont(CAST(frequency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS fq,
             quantile_cont(CAST(monetary AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS mq FROM b)""" + f"""
SELECT j.customer_id,
       coalesce(j.web_rows, 0) > 0 AS has_web, coalesce(j.order_rows, 0) > 0 AS has_orders,
       coalesce(j.review_rows, 0) > 0 AS has_reviews, coalesce(j.social_rows, 0) > 0 AS has_social,
       coalesce(j.web_clicks, 0) AS web_clicks, coalesce(j.sessions, 0) AS sessions,
       CAST(j.duration_sum AS DOUBLE) / j.duration_n AS avg_session_sec,
       coalesce(j.total_orders, 0) AS total_orders,
       CASE WHEN j.order_rows > 0 THEN coalesce(CAST(j.spend AS DOUBLE), 0.0) END AS total_spend,
       CAST(j.spend AS DOUBLE) / j.spend_n AS avg_order_value,
       j.last_purchase_date,
       coalesce(j.reviews_written, 0) AS reviews_written,
       {ratio_sql('j.rating_sum', 'j.rating_n', 2)} AS avg_rating_given,
       coalesce(j.social_posts, 0) AS social_posts,
       CASE WHEN j.social_rows > 0 THEN CAST(coalesce(j.social_likes, 0) AS BIGINT) END AS social_likes,
       seg.segment,
       b.recency_days,
       CASE WHEN b.customer_id IS NOT NULL THEN 5 - ({_above('b.recency_days', 'rq')}) END AS r_score,
       CASE WHEN b.customer_id IS NOT NULL THEN 1 + ({_above('b.frequency', 'fq')}) END AS f_score,
       CASE WHEN b.customer_id IS NOT NULL THEN 1 + ({_above('b.monetary', 'mq')}) END AS m_score,
       a.as_of_date AS snapshot_date
FROM j JOIN seg ON seg.customer_id = j.customer_id
LEFT JOIN b ON b.customer_id = j.customer_id, a, q"""


@register("customer_features", _FEAT_SQL)
def q_customer_features(spark, sf_dir):
    core = _core_checkpointed(spark, sf_dir)
    nb = c3.finish_360(core, notebook=True)
    full = c3.finish_360(core, notebook=False)
    return sg.customer_features(core, nb, full, "exact")


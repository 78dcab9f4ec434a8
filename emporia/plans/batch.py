"""The batch pipeline: sources -> every named result -> published views.

``run_all`` is the library's end-to-end entry point.

1. Each source is written once as Parquet (``materialize=True``) and read
   back, so the many results of one source scan a narrow columnar table
   instead of re-running whatever produced the source (joins, JSON decoding)
   once per result.
2. All per-source results are written.
3. The Customer 360 core is written and read back, so the 360, its notebook
   variant, segments, RFM scores and the feature table start from one
   materialized table instead of recomputing the four-source aggregate.

Written tables also cut lineage: a lost executor never forces the sources to
be recomputed from the beginning.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.operators import customer360 as c3
from emporia.operators import reviews as rv
from emporia.operators import segments as sg
from emporia.operators import shares as sh
from emporia.operators import social as so
from emporia.operators import transactions as tx
from emporia.operators import weblogs as wl
from emporia.operators.clusters import rfm_clusters_checked
from emporia.plans import queries_infer as qi
from emporia.plans.publish import publish_views

# result name -> (source, function)
SOURCE_RESULTS = {
    "page_popularity": ("weblogs", wl.page_popularity),
    "device_breakdown": ("weblogs", wl.device_breakdown),
    "country_traffic": ("weblogs", wl.country_traffic),
    "session_stats": ("weblogs", wl.session_stats),
    "page_counts": ("weblogs", wl.page_counts),
    "country_top7": ("weblogs", wl.country_top7),
    "device_counts": ("weblogs", wl.device_counts),
    "bounce_rate": ("weblogs", wl.bounce_rate),
    "bounce_rate_by_page": ("weblogs", wl.bounce_rate_by_page),
    "revenue_by_category": ("transactions", tx.revenue_by_category),
    "top_products": ("transactions", tx.top_products),
    "customer_spend": ("transactions", tx.customer_spend),
    "payment_method_stats": ("transactions", tx.payment_method_stats),
    "daily_revenue": ("transactions", tx.daily_revenue),
    "revenue_by_category_completed": ("transactions", tx.revenue_by_category_completed),
    "status_distribution": ("transactions", tx.status_distribution),
    "features_as_of": ("transactions", tx.features_as_of),
    "trending_growth": ("transactions", tx.trending_products),
    "sentiment_summary": ("reviews", rv.sentiment_summary),
    "rating_distribution": ("reviews", rv.rating_distribution),
    "product_ratings": ("reviews", rv.product_ratings),
    "sentiment_share": ("reviews", rv.sentiment_share),
    "product_avg_rating": ("reviews", rv.product_avg_rating),
    "overall_rating": ("reviews", rv.overall_rating),
    "rating_counts": ("reviews", rv.rating_counts),
    "platform_stats": ("social", so.platform_stats),
    "platform_posts_likes": ("social", so.platform_posts_likes),
    "brand_sentiment": ("social", so.brand_sentiment),
    "top_customers_social": ("social", so.top_customers_social),
    "brand_sentiment_pivot": ("social", so.brand_sentiment_pivot),
    "trending_hashtags": ("social", so.trending_hashtags),
}


# Large results are published partitioned by day: result -> (partition column,
# the timestamp column it is the UTC date of). The partition column is added.
DAY_PARTITIONED = {"session_stats": ("session_date", "session_start")}


def source_results(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All per-source results as lazy plans."""
    return {name: fn(sources[src]) for name, (src, fn) in SOURCE_RESULTS.items()}


def with_day_partitions(results: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Add the day column of every result listed in ``DAY_PARTITIONED``."""
    out = dict(results)
    for name, (part, ts) in DAY_PARTITIONED.items():
        if name in out:
            out[name] = out[name].withColumn(part, F.to_date(ts))
    return out


def materialize_sources(spark: SparkSession, sources: dict[str, DataFrame],
                        root: str) -> dict[str, DataFrame]:
    """Write each source once as Parquet under ``root`` and read it back."""
    out = {}
    for name, df in sources.items():
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def run_all(spark: SparkSession, sources: dict[str, DataFrame], out_root: str,
                 database: str | None = "emporia", quantiles: str = "exact",
                 as_of: _dt.date | None = None, materialize: bool = True) -> dict[str, str]:
    """Compute and publish every result. Returns result name -> table or path."""
    out_root = out_root.rstrip("/")
    if materialize:
        sources = materialize_sources(spark, sources, f"{out_root}/_sources")
    published = publish_views(spark, with_day_partitions(source_results(sources)), out_root,
                              database=database,
                              partitions={n: p for n, (p, _) in DAY_PARTITIONED.items()})

    core_path = f"{out_root}/_customer_360_core"
    core = c3.customer_360_core(sources["weblogs"], sources["transactions"],
                                sources["reviews"], sources["social"])
    core.write.mode("overwrite").parquet(core_path)
    core = spark.read.parquet(core_path)

    c360 = c3.finish_360(core, notebook=False)
    nb = c3.finish_360(core, notebook=True)
    seg = sg.customer_segments(nb, quantiles)
    rfm_path = f"{out_root}/_rfm_scores"
    sg.rfm_scores(c360, as_of).write.mode("overwrite").parquet(rfm_path)
    rfm = spark.read.parquet(rfm_path)
    derived = {
        "customer_360": c360,
        "customer_360_notebook": nb,
        "customer_segments": seg,
        "segment_share": sg.segment_share(seg),
        "segment_summary": sg.segment_summary(seg),
        "segment_avg_spend": sg.segment_avg_spend(seg),
        "rfm_scores": rfm,
        "rfm_clusters": rfm_clusters_checked(rfm),
        "customer_features": sg.customer_features(core, nb, c360, quantiles, as_of),
    }
    derived["source_row_counts"] = sh.source_row_counts(sources)
    derived["infer_schema_report"] = qi.schema_report(spark, sources["weblogs"])
    derived["infer_csv_report"] = qi.csv_report(spark, sources["weblogs"])
    # one snapshot a day: a run replaces its own day and keeps the others
    published.update(publish_views(spark, derived, out_root, database=database,
                                   partitions={"customer_features": "snapshot_date"},
                                   snapshots=("customer_features",)))
    return published

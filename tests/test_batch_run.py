"""End-to-end pipeline: every result published once, equal to the registry queries."""

import datetime as dt

from emporia.plans import registry
from emporia.plans.batch import run_all
from emporia.plans.publish import publish_table
from emporia.sources.fixtures import load_sources
from tests.conftest import SF_SMALL

NOT_PUBLISHED = {"net_amount", "round_columns", "sentiment_from_rating", "customer_360_join", "customer_360_top10",
                 "spend_quantiles", "spend_quantiles_approx", "customer_segments_approx", "country_traffic_approx",
                 # checks of sketches, and a result that is kept over runs instead
                 "spend_quantiles_by_range", "active_customers_overlap", "session_stats_incremental"}


def test_run_all_publishes_all_results(spark, tmp_path):
    import __spark_entry__ as entry

    out = run_all(spark, load_sources(spark, SF_SMALL), str(tmp_path / "views"),
                       database="emporia_test")
    # every registered analysis is published, but for round trips, plain row filters, slices and checks
    analyses = {n for n in registry.queries() if n not in NOT_PUBLISHED
                and not n.startswith(("scan_", "sink_", "json_", "lake_", "stream_", "publish_", "filter_"))}
    assert set(out) == analyses
    for name in ("revenue_by_category", "customer_360", "customer_segments", "customer_features"):
        published = spark.table(out[name])
        direct = entry.queries()[name](spark, SF_SMALL)
        published = published.select(*direct.columns)
        assert sorted(map(tuple, published.collect())) == sorted(map(tuple, direct.collect())), name
    # the largest result is partitioned by day and otherwise equal to the query
    sessions = spark.table(out["session_stats"])
    parts = spark.sql(f"SHOW PARTITIONS {out['session_stats']}").collect()
    assert len(parts) > 1 and all(r[0].startswith("session_date=") for r in parts)
    direct = entry.queries()["session_stats"](spark, SF_SMALL)
    assert sessions.filter("session_date <> to_date(session_start)").count() == 0
    assert (sorted(map(tuple, sessions.select(*direct.columns).collect()))
            == sorted(map(tuple, direct.collect())))


def test_publishing_again_switches_and_snapshots_stay(spark, tmp_path):
    root = str(tmp_path / "views")

    def features(day, n):
        return spark.range(n).selectExpr("id", f"date '{day}' as snapshot_date")

    name = publish_table(spark, spark.range(3).toDF("n"), "plain_t", root, database="emporia_test")
    publish_table(spark, spark.range(5).toDF("n"), "plain_t", root, database="emporia_test")
    assert spark.table(name).count() == 5
    publish_table(spark, spark.range(2).selectExpr("id as n", "'x' as s"), "plain_t", root, database="emporia_test")
    assert spark.table(name).columns == ["n", "s"]
    for day, n in (("2024-01-01", 4), ("2024-01-02", 3), ("2024-01-02", 2)):
        name = publish_table(spark, features(day, n), "feat_t", root, "emporia_test", "snapshot_date", snapshots=True)
    got = {r.snapshot_date: r["count"] for r in spark.table(name).groupBy("snapshot_date").count().collect()}
    assert got == {dt.date(2024, 1, 1): 4, dt.date(2024, 1, 2): 2}

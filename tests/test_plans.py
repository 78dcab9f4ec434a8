"""Physical-plan checks: the plans we want, not only the right rows."""

import pytest

import __spark_entry__ as entry
from emporia.plans import registry
from tests.conftest import SF_SMALL

# Streams and round trips execute jobs while they are built; their read-back
# plans are scans, so plan checks cover the analytic queries.
SKIP_PREFIXES = ("stream_", "lake_", "scan_", "sink_", "publish_")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def analytic_names():
    return sorted(n for n in registry.queries() if not n.startswith(SKIP_PREFIXES))


@pytest.mark.parametrize("name", analytic_names())
def test_no_python_udf_or_cross_join_in_plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    p = plan_of(df)
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                 "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in p, f"{name}: {node}"


@pytest.mark.parametrize("name", ["top_products", "top_customers_social", "country_top7",
                                  "trending_hashtags", "customer_360_top10"])
def test_top_k_uses_take_ordered(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in plan_of(df)


def test_scan_is_pruned_and_filters_pushed(spark):
    df = entry.queries()["revenue_by_category"](spark, SF_SMALL)
    formatted = df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double," \
           "l_discount:double,l_returnflag:string>" in formatted
    assert "l_comment" not in formatted and "l_shipdate" not in formatted


def test_union_360_has_no_join(spark):
    from emporia.plans.queries_c360 import _sources
    from emporia.operators import customer360 as c3

    p = plan_of(c3.customer_360_core(*_sources(spark, SF_SMALL)))
    adapters_joins = p.count("Join")
    # the only joins are inside the source adapters (fact x dimension); the
    # 360 itself is union + aggregate
    join_form = plan_of(c3.customer_360_join(*_sources(spark, SF_SMALL)))
    assert join_form.count("Join") >= adapters_joins + 3
    assert "Union" in p


def test_day_read_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from emporia.sources.fixtures import weblogs
    from emporia.sources.lake import Lake

    src = weblogs(spark, SF_SMALL)
    lake = Lake(spark, str(tmp_path / "lake"), raw_format="parquet")
    lake.ingest_raw("weblogs", src, date=F.col("timestamp"))
    day = lake.read("raw", "weblogs", src.schema, date="2024-01-05")
    formatted = day._jdf.queryExecution().explainString(
        day._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(ingest_date" in formatted
    assert day.count() == src.filter(F.to_date("timestamp") == "2024-01-05").count()


@pytest.mark.parametrize("name", ["device_breakdown", "status_distribution", "sentiment_share",
                                  "segment_share"])
def test_share_total_is_one_scalar_subquery(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("scalar-subquery#") == 1, optimized
    assert "Window" not in plan_of(df)

"""A key holding a third of all rows: same results, and plans that pre-aggregate."""

import datetime as dt
import re

from pyspark.sql import functions as F

from emporia.operators import customer360 as c3
from emporia.operators import weblogs as wl
from emporia.schemas import REVIEWS, SOCIAL, TRANSACTIONS, WEBLOGS
from emporia.sources.lake import dedup_latest

TS = dt.datetime(2024, 1, 1)


def _weblogs(spark, n=3000):
    # customer C0 owns a third of the events, in a single session
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("event_id"),
        (F.lit(TS) + F.make_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
         .alias("session_id"),
        F.when(F.col("id") % 3 == 0, F.lit("C0")).otherwise(F.concat(F.lit("K"), (F.col("id") % 97)
                                                                     .cast("string")))
         .alias("customer_id"),
        F.lit("/home").alias("page"),
        F.lit("mobile").alias("device"),
        F.lit("DE").alias("country"),
        (F.col("id") % 7).alias("duration_sec"),
    )
    return rows.select(*[F.col(f.name).cast(f.dataType) if f.name in rows.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in WEBLOGS.fields])


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_hot_customer_results(spark):
    w = _weblogs(spark)
    srcs = (w, _empty(spark, TRANSACTIONS), _empty(spark, REVIEWS), _empty(spark, SOCIAL))
    union = {r.customer_id: r for r in c3.customer_360(*srcs).collect()}
    join = {r.customer_id: r for r in c3.customer_360_join(*srcs).collect()}
    assert union == join
    assert union["C0"].web_clicks == 1000 and union["C0"].sessions == 1
    top = wl.country_traffic(w).first()
    assert top.events == 3000 and top.unique_customers == 1 + 97


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_aggregate_exchange_is_fed_by_a_partial_aggregate(spark):
    w = _weblogs(spark)
    srcs = (w, _empty(spark, TRANSACTIONS), _empty(spark, REVIEWS), _empty(spark, SOCIAL))
    for df in (c3.customer_360_core(*srcs), wl.page_popularity(w), wl.session_stats(w)):
        p = _plan(df)
        assert "partial_count" in p
        # no exchange directly over raw union rows: each hashpartitioning exchange
        # sits on a HashAggregate
        fed_by = [m.group(1) for m in
                  re.finditer(r"Exchange hashpartitioning[^\n]*\n\s*[+:\- ]*(\w+)", p)]
        assert fed_by, p
        assert set(fed_by) <= {"HashAggregate", "ObjectHashAggregate", "SortAggregate"}, p


def test_dedup_hot_record_id_uses_aggregation_not_window(spark):
    w = _weblogs(spark).withColumn(
        "event_id", F.when(F.col("session_id") == "hot", F.lit("dup")).otherwise(F.col("event_id")))
    out = dedup_latest(w, "event_id", ["timestamp"])
    p = _plan(out)
    assert "Window" not in p and "Aggregate" in p
    got = out.filter(F.col("event_id") == "dup").collect()
    assert len(got) == 1 and got[0].timestamp == TS + dt.timedelta(seconds=2997)
    assert out.count() == 2001


def test_stream_sessions_merge_a_hot_user_before_the_shuffle(spark, capsys):
    from emporia.plans.queries_stream import run_available_now
    from emporia.session import scratch_path
    from emporia.streaming.operators import sessions

    # user 0 owns a third of the events (one per second for 1000 s); 2000 others
    # are spread over 97 users and 20000 s, so the watermark closes user 0's session
    ids = spark.range(3000)
    hot = F.col("id") < 1000
    events = ids.select(
        F.when(hot, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("user_id"),
        (F.lit(TS).cast("timestamp")
         + F.make_interval(secs=F.when(hot, F.col("id")).otherwise(F.col("id") * 10)))
        .alias("t"))
    landing = scratch_path(spark, "hot-sessions-landing")
    events.write.parquet(landing)
    stream = spark.readStream.schema(events.schema).parquet(landing)
    out = sessions(stream, "t", "user_id", "30 minutes", "1 hour").select(
        "user_id", "events", "first_event", "last_event")
    base = scratch_path(spark, "hot-sessions")
    q = run_available_now(out, f"{base}/out", f"{base}/checkpoint")

    got = spark.read.parquet(f"{base}/out").filter("user_id = 0").collect()
    assert [(r.events, r.first_event, r.last_event) for r in got] == [
        (1000, TS, TS + dt.timedelta(seconds=999))]

    q.explain()
    plan = capsys.readouterr().out
    exchange = plan.index("Exchange hashpartitioning")
    assert "MergingSessions" in plan[exchange:], plan


def test_hot_customer_join_is_split_under_an_aggregate_on_the_same_key(spark):
    # the join and the aggregate above it share the key, so the aggregate reuses
    # the join's partitioning; the hot key must still be split across tasks
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ev = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("user_id"),
            (F.col("id") % 7).alias("d"))
        cust = spark.range(997).select(F.col("id").alias("c_custkey"))
        out = (ev.join(cust, ev.user_id == cust.c_custkey)
                 .groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("d").alias("s")))
        got = {r.user_id: (r.n, r.s) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got[0] == (20040, sum(i % 7 for i in range(0, 60000, 3)) + sum(
        i % 7 for i in range(60000) if i % 3 and i % 997 == 0))
    assert len(got) == 997
    assert "SortMergeJoin(skew=true)" in plan, plan
    # the pieces of the hot key are collapsed before the added shuffle
    assert re.search(r"Exchange hashpartitioning\(user_id[^\n]*\n[^\n]*partial_count", plan), plan

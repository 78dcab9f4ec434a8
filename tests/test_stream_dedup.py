"""Replays merged inside their batch before the state."""

import datetime as dt
import time

from pyspark.sql import functions as F

from emporia.plans.queries_stream import run_available_now
from emporia.streaming import dedup as sd
from emporia.streaming import operators as so
from emporia.streaming.sources import event_time, landing_rows

SCHEMA = "event_id bigint, ts timestamp_ntz, event_type string, value double"
DAY = dt.datetime(2024, 1, 1, 10)


def _events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("t", event_time("ts", spark))


def test_first_row_of_every_id(spark):
    rows = [(1, DAY + dt.timedelta(minutes=m), "a", float(m)) for m in (3, 1, 2)] + [(2, None, "b", None), (2, DAY, "b", 1.0)]
    rows += [(None, DAY, "x", 1.0), (None, DAY, "x", 1.0)]
    got = {r.event_id: (r.value, r.ts) for r in sd.one_an_id(_events(spark, rows), "t", "event_id").collect()}
    assert got == {1: (1.0, DAY + dt.timedelta(minutes=1)), 2: (None, None), None: (1.0, DAY)}
    assert sd.one_an_id(_events(spark, []), "t", "event_id").count() == 0
    odd = spark.createDataFrame([(1, "p", "q"), (1, "p", "q")], ["__id", "__row", "a.b"]).withColumn("t", F.lit(DAY))
    out = sd.one_an_id(odd, "t", "__id")
    assert out.columns == odd.columns and out.count() == 1


def test_hot_id_sends_one_row_a_task(spark):
    rows = [(7, DAY, "a", 1.0)] * 3000 + [(i, DAY, "b", 2.0) for i in range(100, 130)]
    df = _events(spark, rows).repartition(4)
    path_rows = sd.one_an_id(df, "t", "event_id")
    path_rows.collect()
    plan, found = path_rows._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return walk(node.plan())
        if node.nodeName() == "Exchange" and "hashpartitioning" in node.toString().split("\n")[0]:
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    assert found and found[0] <= 4 * 1 + 30  # the hot id once a task


def test_replays_in_and_across_batches_come_out_once(spark, tmp_path):
    land, staging = str(tmp_path / "land"), str(tmp_path / "staged")
    schema = _events(spark, []).drop("t").schema
    batches = [[(1, DAY, "a", 1.0)] * 50 + [(2, DAY, "b", 2.0)],
               [(1, DAY + dt.timedelta(minutes=5), "a", 1.0)] * 20 + [(3, DAY + dt.timedelta(minutes=6), "c", 3.0)]]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(land)
        time.sleep(0.2)
    stream = landing_rows(spark, land, schema, 1).withColumn("t", event_time("ts", spark))
    (stream.writeStream.foreachBatch(sd.staged_sink(staging, "t", "event_id"))
     .option("checkpointLocation", str(tmp_path / "ck1")).trigger(availableNow=True).start().awaitTermination())
    assert [spark.read.parquet(f"{staging}/{k}").count() for k in (0, 1)] == [2, 2]
    # a batch that runs again: finished, it is left alone; unfinished, its rows come again and are dropped later
    again = _events(spark, batches[1])
    sd.staged_sink(staging, "t", "event_id")(again, 1)
    assert spark.read.parquet(f"{staging}/1").count() == 2
    (tmp_path / "staged" / "1" / "_SUCCESS").unlink()
    sd.staged_sink(staging, "t", "event_id")(again, 1)
    assert spark.read.parquet(f"{staging}/1").count() == 4
    out = so.dedup_by_id(sd.staged_rows(spark, staging, stream.schema), "t", "event_id")
    run_available_now(out, str(tmp_path / "out"), str(tmp_path / "ck2"), state_partitions=2)
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]
    # the next run of both goes on from where they stopped
    spark.createDataFrame([(3, DAY + dt.timedelta(minutes=7), "c", 3.0), (4, DAY + dt.timedelta(minutes=8), "d", 4.0)] * 9,
                          SCHEMA).coalesce(1).write.mode("append").parquet(land)
    (stream.writeStream.foreachBatch(sd.staged_sink(staging, "t", "event_id"))
     .option("checkpointLocation", str(tmp_path / "ck1")).trigger(availableNow=True).start().awaitTermination())
    run_available_now(so.dedup_by_id(sd.staged_rows(spark, staging, stream.schema), "t", "event_id"),
                      str(tmp_path / "out"), str(tmp_path / "ck2"), state_partitions=2)
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 4]

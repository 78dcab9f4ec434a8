"""Streaming semantics: watermarks, replays, partial merging."""

import datetime as dt
import time

from pyspark.sql import functions as F

from emporia.operators import customer360 as c3
from emporia.plans.queries_c360 import _sources
from emporia.plans.queries_stream import run_available_now
from emporia.streaming import customer360 as sc3
from emporia.streaming import operators as so
from emporia.streaming.sources import event_time, landing_rows, wall_time
from tests.conftest import SF_SMALL

SCHEMA = "event_id bigint, ts timestamp_ntz, event_type string, value double"


def _write_file(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.2)  # distinct modification times: files are replayed in write order


def test_late_record_is_dropped_from_windows(spark, tmp_path):
    land = str(tmp_path / "land")
    d = dt.datetime
    _write_file(spark, land, [(1, d(2024, 1, 1, 10), "view", 1.0), (2, d(2024, 1, 1, 11), "view", 2.0)])
    _write_file(spark, land, [(3, d(2024, 1, 3, 12), "view", 3.0)])
    _write_file(spark, land, [(5, d(2024, 1, 4, 12), "view", 5.0)])
    # Arrives after the Jan 1 window was emitted and its state evicted (the
    # watermark passed Jan 2 00:00 one batch earlier): dropped. While a
    # window's state still exists, Spark may still count a late record (its
    # guarantee is one-directional), which the oracle of the registry streams
    # never meets because replays are in time order.
    _write_file(spark, land, [(4, d(2024, 1, 1, 12), "view", 4.0), (6, d(2024, 1, 4, 13), "view", 6.0)])
    stream = landing_rows(spark, land, spark.createDataFrame([], SCHEMA).schema, 1)
    stream = stream.withColumn("t", event_time("ts", spark))
    agg = so.tumbling_counts(stream, "t", "event_type", "1 day", "1 hour", value_col="value")
    out = agg.select(wall_time("w.start", spark).alias("day"), "events", "total_value")
    run_available_now(out, str(tmp_path / "out"), str(tmp_path / "ck"), state_partitions=2)
    got = {r.day.date(): (r.events, r.total_value)
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # Jan 1 closed with its two on-time records; Jan 4 stays open.
    assert got == {dt.date(2024, 1, 1): (2, 3.0), dt.date(2024, 1, 3): (1, 3.0)}


def test_dedup_within_watermark(spark, tmp_path):
    land = str(tmp_path / "land")
    d = dt.datetime
    _write_file(spark, land, [(1, d(2024, 1, 1, 10), "view", 1.0), (1, d(2024, 1, 1, 10), "view", 1.0)])
    _write_file(spark, land, [(1, d(2024, 1, 1, 10, 5), "view", 1.0), (2, d(2024, 1, 1, 10, 6), "a", 2.0)])
    stream = landing_rows(spark, land, spark.createDataFrame([], SCHEMA).schema, 1)
    out = so.dedup_by_id(stream.withColumn("t", event_time("ts", spark)), "t", "event_id")
    run_available_now(out.drop("t"), str(tmp_path / "out"), str(tmp_path / "ck"), state_partitions=2)
    ids = sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert ids == [1, 2]


def test_replayed_batch_replaces_itself_and_compaction_keeps_the_result(spark, tmp_path):
    rows = c3.union_rows(*_sources(spark, SF_SMALL))
    half_a, half_b = rows.randomSplit([0.5, 0.5], seed=1)
    state = str(tmp_path / "state")
    sc3.write_partials(half_a, state, 0)
    sc3.write_partials(half_b, state, 1)
    sc3.write_partials(half_b, state, 1)  # replay of batch 1 after a failure
    merged = sorted(map(tuple, sc3.merged_360(spark, state).collect()))
    batch = sorted(map(tuple, c3.customer_360(*_sources(spark, SF_SMALL)).collect()))
    assert merged == batch
    compacted = str(tmp_path / "compacted")
    sc3.compact(spark, state, compacted)
    assert sorted(map(tuple, sc3.merged_360(spark, compacted).collect())) == batch
    assert F is not None

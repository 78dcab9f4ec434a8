"""Findings of round 3: whole jobs, and memory and disk that don't follow the ids or the texts."""

import glob
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.session import ensure_checkpoint_dir
from emporia.sources import snapshots
from emporia.sources.lake import PART, Lake
from emporia.sources.snapshots import BITS, BLOCK, Snapshots

LINE = "order_id string, customer_id string, total_amount decimal(18,2), quantity long, discount_pct long"


def lines(spark, *rows):
    return spark.createDataFrame([(o, c, None if a is None else Decimal(a), 1, 0) for o, c, a in rows], LINE)


def orders(df):
    return sorted((r.order_id, str(r[PART])[-2:]) for r in df.collect())


def test_replayed_lines_count_on_their_last_day_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    day1 = lines(spark, ("a", "1", "1.00"), ("a", "1", "1.00"), ("b", "2", "2.00"), ("c", "3", "3.00"))
    day2 = lines(spark, ("a", "1", "1.00"), ("d", "4", "4.00"), ("d", "4", "4.00"))
    day3 = lines(spark, ("b", "2", "2.00"), ("b", "2", "2.00"))
    for k, df in enumerate((day1, day2, day3), 1):
        lake.ingest_raw("transactions", df, date=f"2031-01-0{k}")
    assert glob.glob(f"{tmp_path}/lake/raw/transactions/*/*.json.gz")     # before: plain text, seven times as large
    lake.promote("transactions", day1.schema)
    assert orders(lake.read("processed", "transactions")) == [("a", "02"), ("b", "03"), ("b", "03"), ("c", "01"),
                                                              ("d", "02"), ("d", "02")]


def test_only_rejects_carry_their_text(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    df = lines(spark, ("a", "1", "1.00"), (" b ", "2", "-2.00"))
    lake.ingest_raw("transactions", df, date="2031-01-01")
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/emporia/promote-transactions-*"))
    lake.promote("transactions", df.schema)
    (work,) = set(glob.glob(f"{root}/emporia/promote-transactions-*")) - before
    assert [r["__raw"] for r in spark.read.parquet(work).where("order_id = 'a'").collect()] == [None]
    (bad,) = lake.read("quarantine", "transactions").collect()
    assert bad.reject_reason == "negative amount" and '"order_id":" b "' in bad.raw_value


def test_rows_of_one_day_are_landed_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("emporia.sources.lake.FILE_ROWS", 10)
    lake = Lake(spark, str(tmp_path / "lake"))
    df = spark.range(35, numPartitions=1).select(F.col("id").cast("string").alias("event_id"))
    lake.ingest_raw("weblogs", df, date="2031-01-01")
    assert len(glob.glob(f"{tmp_path}/lake/raw/weblogs/*/*.json.gz")) == 4
    assert lake.read("raw", "weblogs", df.schema).count() == 35


@pytest.mark.parametrize("repeats", [0, 1, 100])
def test_records_that_come_once_are_not_sorted(spark, tmp_path, repeats):
    lake = Lake(spark, str(tmp_path / "lake"))
    once = spark.range(100).select(F.col("id").alias("event_id"), F.lit(1).alias("timestamp"), F.lit("x").alias("page"))
    again = once.where(F.col("event_id") < repeats).withColumn("timestamp", F.lit(2))
    out = lake._one_version(once.unionByName(again), "event_id", ["timestamp"])
    assert sorted(tuple(r) for r in out.collect()) == [(i, 2 if i < repeats else 1, "x") for i in range(100)]
    assert ("Aggregate" in out._jdf.queryExecution().optimizedPlan().toString()) == (repeats > 0)


def test_filters_hold_the_bits_of_every_id_and_no_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "FILE_ROWS", 700)
    t = Snapshots(spark, str(tmp_path / "t"), "day", ("event_id", "customer_id"))
    df = spark.range(5000).select(F.col("id").alias("event_id"), F.expr("if(id % 5 = 0, null, id % 90)").alias("customer_id"),
                                  F.expr("date_add(date'2031-01-01', cast(id % 2 as int))").alias("day"))
    adds = t.write_files("z", df)
    assert adds.agg(F.max("rows")).first()[0] <= 700
    n_blocks = adds.first().n_blocks
    written = spark.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/t/data")
    places = written.select(F.col("_metadata.file_path").alias("path"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("id")) for c in t.ids])).alias("k")).where("k.id IS NOT NULL").select(
        "path", "k.c", snapshots._block(F.col("k.id"), n_blocks).alias("block"), F.explode(snapshots._bits(F.col("k.id"))).alias("bit"))
    wanted = {(r.path, r.c, r.block, r.bit) for r in places.collect()}
    found = {(r.path, r.id_column, r.block, int(b)) for r in spark.read.parquet(adds.first().blooms).collect()
             for b in np.flatnonzero(np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little"))}
    assert found == wanted and BITS * 5000 < BLOCK

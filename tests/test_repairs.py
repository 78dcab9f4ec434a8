"""Rows that used to get lost or go wrong: null times, replays, malformed fields, negative ratios."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emporia.functions.money import ratio_half_up
from emporia.operators import customer360 as c3
from emporia.operators import weblogs as wl
from emporia.plans.queries_c360 import _sources
from emporia.schemas import TRANSACTIONS, WEBLOGS, check_source
from emporia.session import ensure_checkpoint_dir
from emporia.sources import files
from emporia.sources.fixtures import load_sources
from emporia.sources.lake import Lake
from emporia.streaming import customer360 as sc3
from emporia.streaming.sources import event_time, land_in_time_order
from tests.conftest import SF_SMALL

TS = dt.datetime(2024, 1, 1, 10)


def rows(spark, schema, dicts):
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema.fields) for d in dicts], schema)


def test_landing_keeps_rows_without_a_time(spark, tmp_path):
    df = spark.range(1000).selectExpr(
        "id", "if(id % 10 = 0, null, timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, id)) as ts")
    land_in_time_order(df, str(tmp_path / "a"), "ts")
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1000
    none = df.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    land_in_time_order(none, str(tmp_path / "b"), "ts")
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1000


def test_adapters_keep_every_fact(spark):
    src = load_sources(spark, SF_SMALL)
    for name, table in (("weblogs", "events"), ("transactions", "lineitem"), ("reviews", "documents"),
                        ("social", "conversations")):
        assert src[name].count() == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count(), name


def test_event_time_shifts_wall_clocks_only(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp '2024-01-01 10:00:00Z' as i, timestamp_ntz '2024-01-01 10:00:00' as w")
        got = df.select(F.unix_seconds(event_time("i", spark)).alias("i"),
                        F.unix_seconds(event_time("w", spark)).alias("w")).first()
        assert got.i == got.w == 1704103200
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_null_sessions_are_no_session(spark):
    w = rows(spark, WEBLOGS, [dict(event_id=str(k), session_id="s" if k < 2 else None, page="/a", timestamp=TS)
                              for k in range(5)])
    got = wl.bounce_rate(w).first()
    assert (got.sessions, got.bounced_sessions, got.bounce_rate_pct) == (1, 0, 0.0)


def test_csv_keeps_line_ends_and_quarantines_bad_fields(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "quoted"\nline, with\\ marks '), (2, None), (3, " x")], "n int, t string")
    files.save_results(df, str(tmp_path / "ok"), "csv")
    good, bad = files.split_quarantine(files.scan_csv(spark, str(tmp_path / "ok"), df.schema))
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, df.collect())) and bad.count() == 0
    (tmp_path / "bad.csv").write_text("n,t\none,20\n2,b\n")
    good, bad = files.split_quarantine(files.scan_csv(spark, str(tmp_path / "bad.csv"), df.schema).cache())
    assert [tuple(r) for r in good.collect()] == [(2, "b")] and [r[0] for r in bad.collect()] == ["one,20"]


@pytest.mark.parametrize("num, den, scale, want", [(-5, 4, 1, -1.3), (5, 4, 1, 1.3), (-1, 3, 2, -0.33), (0, 7, 2, 0.0)])
def test_ratios_round_half_away_from_zero(spark, num, den, scale, want):
    assert spark.range(1).select(ratio_half_up(F.lit(num), F.lit(den), scale)).first()[0] == want


def test_no_silent_local_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class S:
                    @staticmethod
                    def getCheckpointDir():
                        return type("None_", (), {"isDefined": lambda self: False})()
                return S

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(type("Session", (), {"conf": Conf(), "sparkContext": Context()})())


def test_compaction_survives_later_batches(spark, tmp_path):
    all_rows = c3.union_rows(*_sources(spark, SF_SMALL))
    parts = [all_rows.where(F.pmod(F.xxhash64("customer_id", "session_id"), F.lit(4)) == k) for k in range(4)]
    want = sorted(map(tuple, c3.customer_360(*_sources(spark, SF_SMALL)).collect()))
    state, fresh = str(tmp_path / "state"), str(tmp_path / "fresh")
    sc3.write_partials(parts[0], state, 0)
    sc3.write_partials(parts[1], state, 1)
    sc3.compact(spark, state)
    sc3.write_partials(parts[2], state, 2)
    sc3.compact(spark, state)
    sc3.compact(spark, state)
    sc3.compact(spark, state, fresh)  # a stream that goes on there numbers its batches from 0
    for folder, batch in ((state, 3), (fresh, 0)):
        sc3.write_partials(parts[3], folder, batch)
        assert sorted(map(tuple, sc3.merged_360(spark, folder).collect())) == want


def test_promote_replaces_days_and_keeps_raw_text(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    good = [dict(event_id=str(k), page="/a", duration_sec=k, timestamp=TS) for k in range(5)]
    lake.ingest_raw("weblogs", rows(spark, WEBLOGS, good), date="2024-01-01")
    lake.promote("weblogs", WEBLOGS, date="2024-01-01")
    assert lake.read("processed", "weblogs").count() == 5
    folder = tmp_path / "lake/raw/weblogs/ingest_date=2024-01-01"
    (folder / "more.json").write_text('{"event_id": "9", "duration_sec": "long"}\n{"event_id": \nnot json\n')
    lake.promote("weblogs", WEBLOGS, date="2024-01-01")
    bad = lake.read("quarantine", "weblogs").collect()
    assert sorted(r.raw_value for r in bad) == ['not json', '{"event_id": ', '{"event_id": "9", "duration_sec": "long"}']
    only_bad = [dict(event_id=None, page="/a", duration_sec=1, timestamp=TS)]
    lake.ingest_raw("weblogs", rows(spark, WEBLOGS, only_bad), date="2024-01-01")
    lake.promote("weblogs", WEBLOGS, date="2024-01-01")
    assert lake.read("processed", "weblogs", date="2024-01-01").count() == 0
    assert [r.reject_reason for r in lake.read("quarantine", "weblogs").collect()] == ["missing event_id"]
    lake.ingest_raw("weblogs", rows(spark, WEBLOGS, good), date="2024-01-01")
    lake.promote("weblogs", WEBLOGS)
    assert lake.read("processed", "weblogs").count() == 5 and lake.read("quarantine", "weblogs").count() == 0


def test_null_quantity_and_discount_are_rejected(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    base = dict(order_id="a", total_amount=1, timestamp=TS, status="shipped")
    t = spark.createDataFrame([("a", 1, None), ("b", None, 5), ("c", 1, 5)],
                              "order_id string, quantity bigint, discount_pct bigint")
    full = t.withColumn("total_amount", F.lit(1).cast("decimal(18,2)"))
    for f in TRANSACTIONS.fields:
        if f.name not in full.columns:
            full = full.withColumn(f.name, F.lit(base.get(f.name)).cast(f.dataType))
    lake.ingest_raw("transactions", full.select(*TRANSACTIONS.fieldNames()), date="2024-01-01")
    lake.promote("transactions", TRANSACTIONS)
    assert [r.order_id for r in lake.read("processed", "transactions").collect()] == ["c"]


def test_dates_come_from_folder_names(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.dates("raw", "weblogs") == []
    lake.ingest_raw("social_media", spark.createDataFrame([("p",)], "post_id string"), date="2024-01-02")
    lake.ingest_raw("social", spark.createDataFrame([("p",)], "post_id string"), date="2024-01-01")
    assert lake.dates("raw", "social") == ["2024-01-01", "2024-01-02"]
    assert check_source("social_media") == "social"

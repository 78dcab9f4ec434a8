"""Hand-made fixtures for the traps of the record contract."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.operators import customer360 as c3
from emporia.operators import reviews as rv
from emporia.operators import social as so
from emporia.operators import transactions as tx
from emporia.operators import weblogs as wl
from emporia.schemas import REVIEWS, SOCIAL, TRANSACTIONS, WEBLOGS

TS = dt.datetime(2024, 1, 1, 12, 0, 0)


def rows(spark, schema, dicts):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in dicts], schema)


def txn(**kw):
    base = dict(order_id="O1", timestamp=TS, customer_id="C1", product_id="P1",
                product_name="Widget", category="toys", quantity=1,
                total_amount=Decimal("100.00"), discount_pct=0, payment_method="card",
                status="delivered")
    base.update(kw)
    return base


def test_half_cent_rounding_is_half_up_on_exact_decimals(spark):
    t = rows(spark, TRANSACTIONS, [
        txn(order_id="a", total_amount=Decimal("1287.10"), discount_pct=5),
        txn(order_id="b", total_amount=Decimal("70975.70"), discount_pct=5),
    ])
    got = {r.order_id: r.net_amount for r in tx.with_net_amount(t).collect()}
    # 1287.10 * 0.95 = 1222.745 and 70975.70 * 0.95 = 67426.915: both round up.
    assert got == {"a": Decimal("1222.75"), "b": Decimal("67426.92")}


def test_null_status_is_neither_cancelled_nor_completed(spark):
    t = rows(spark, TRANSACTIONS, [txn(order_id="a", status=None), txn(order_id="b")])
    assert tx.not_cancelled(t).count() == 1
    assert tx.completed(t).count() == 1
    dist = {r.status: r["count"] for r in tx.status_distribution(t).collect()}
    assert dist == {"delivered": 1}


def test_repeated_order_id_counts_rows(spark):
    t = rows(spark, TRANSACTIONS, [txn(order_id="same"), txn(order_id="same")])
    r = tx.revenue_by_category(t).first()
    assert r.orders == 2 and r.total_revenue == 200.0


def test_top_k_ties_broken_by_key(spark):
    t = rows(spark, TRANSACTIONS, [
        txn(order_id=str(i), product_id=f"P{i:02d}", product_name="x") for i in range(15)])
    top = [r.product_id for r in tx.top_products(t).collect()]
    assert top == [f"P{i:02d}" for i in range(10)]


def test_top_customers_social_tie_break_and_known_only(spark):
    s = rows(spark, SOCIAL, [
        dict(post_id=str(i), customer_id=(None if i % 4 == 0 else f"C{i:02d}"), platform="x",
             likes=1, shares=0, sentiment="neutral", brand_mention=True, hashtags=[])
        for i in range(40)])
    top = so.top_customers_social(s).collect()
    assert len(top) == 20
    assert all(r.customer_id is not None for r in top)
    assert [r.customer_id for r in top] == sorted(r.customer_id for r in top)


def test_all_empty_hashtags_give_empty_trending(spark):
    s = rows(spark, SOCIAL, [dict(post_id="1", platform="x", hashtags=[], likes=0, shares=0)])
    assert so.trending_hashtags(s).count() == 0


def test_mixed_product_pairs_are_separate_groups(spark):
    r = rows(spark, REVIEWS, [
        dict(review_id="1", customer_id="C1", product_id="P1", product_name="A", rating=5,
             sentiment="positive"),
        dict(review_id="2", customer_id="C1", product_id="P1", product_name="B", rating=1,
             sentiment="negative"),
    ])
    assert rv.product_ratings(r).count() == 2
    assert rv.product_avg_rating(r).count() == 2


def test_empty_source(spark):
    w = spark.createDataFrame([], WEBLOGS)
    assert wl.page_popularity(w).count() == 0
    assert wl.device_breakdown(w).count() == 0
    b = wl.bounce_rate(w).first()
    assert b.sessions == 0 and b.bounce_rate_pct is None


def test_all_null_group_and_share_sums(spark):
    w = rows(spark, WEBLOGS, [
        dict(event_id="1", session_id="s1", device=None, page="/a", timestamp=TS),
        dict(event_id="2", session_id="s1", device="mobile", page="/a", timestamp=TS),
        dict(event_id="3", session_id="s2", device="mobile", page="/b", timestamp=TS),
    ])
    got = {r.device: (r.events, r.pct) for r in wl.device_breakdown(w).collect()}
    assert got == {None: (1, 33.33), "mobile": (2, 66.67)}
    counts = {r.device: r.events for r in wl.device_counts(w).collect()}
    assert counts == {"mobile": 2}


def test_bounce_rate_and_entry_page(spark):
    w = rows(spark, WEBLOGS, [
        dict(event_id="1", session_id="s1", page="/b", timestamp=TS),
        dict(event_id="2", session_id="s1", page="/a", timestamp=TS + dt.timedelta(seconds=5)),
        dict(event_id="3", session_id="s2", page="/a", timestamp=TS),
    ])
    assert wl.bounce_rate(w).first().bounce_rate_pct == 50.0
    by_page = {r.entry_page: (r.sessions, r.bounced_sessions)
               for r in wl.bounce_rate_by_page(w).collect()}
    assert by_page == {"/b": (1, 0), "/a": (1, 1)}


def _sources_for_360(spark):
    w = rows(spark, WEBLOGS, [
        dict(event_id="e1", session_id="s1", customer_id="C1", duration_sec=10, timestamp=TS),
        dict(event_id="e2", session_id="s1", customer_id="C1", duration_sec=20, timestamp=TS),
        dict(event_id="e3", session_id="s9", customer_id=None, duration_sec=5, timestamp=TS),
    ])
    t = rows(spark, TRANSACTIONS, [
        txn(order_id="o1", customer_id="C2", total_amount=Decimal("10.01")),
        txn(order_id="o2", customer_id="C2", total_amount=Decimal("10.00"), status="shipped"),
        txn(order_id="o3", customer_id="C3", status="cancelled"),
        txn(order_id="o4", customer_id=None),
    ])
    r = rows(spark, REVIEWS, [dict(review_id="r1", customer_id="C1", rating=4)])
    s = rows(spark, SOCIAL, [
        dict(post_id="p1", customer_id="C4", likes=7, hashtags=[]),
        dict(post_id="p2", customer_id=None, likes=100, hashtags=[]),
    ])
    return w, t, r, s


def test_customer_360_union_equals_join_and_drops_null_keys(spark):
    srcs = _sources_for_360(spark)
    union = c3.customer_360(*srcs)
    join = c3.customer_360_join(*srcs)
    assert union.columns == join.columns
    a = sorted(tuple(r) for r in union.collect())
    b = sorted(tuple(r) for r in join.collect())
    assert a == b
    got = {r.customer_id: r for r in union.collect()}
    # C3 has only a cancelled order: absent; null keys dropped on every side.
    assert set(got) == {"C1", "C2", "C4"}
    assert got["C1"].web_clicks == 2 and got["C1"].sessions == 1
    assert got["C1"].avg_session_sec == 15.0 and got["C1"].avg_rating_given == 4.0
    assert got["C2"].total_orders == 2 and got["C2"].total_spend == 20.01
    assert got["C2"].last_purchase_date == TS and got["C4"].last_purchase_date is None
    assert got["C4"].social_likes == 7 and got["C4"].total_spend == 0.0


def test_customer_360_notebook_rounding(spark):
    nb = {r.customer_id: r for r in c3.customer_360_notebook(*_sources_for_360(spark)).collect()}
    # (10.01 + 10.00) / 2 = 10.005 -> 10.01 (half up on exact cents)
    assert nb["C2"].avg_order_value == 10.01
    assert "last_purchase_date" not in c3.customer_360_notebook(*_sources_for_360(spark)).columns


def test_segments_cover_every_customer(spark):
    from emporia.operators import segments as sg

    nb = c3.customer_360_notebook(*_sources_for_360(spark))
    seg = sg.customer_segments(nb, "exact")
    assert seg.count() == nb.count()
    share = sg.segment_share(seg).collect()
    assert sum(r.customers for r in share) == nb.count()
    assert abs(sum(r.pct for r in share) - 100.0) < 0.2


def test_corrupt_and_blank_json_lines_are_quarantined(spark, tmp_path):
    from emporia.sources import files

    p = tmp_path / "in.json"
    p.write_text('{"order_id": "a", "quantity": 2}\n\n{"order_id": "b", \nnot json\n')
    df = files.scan_json(spark, str(p), TRANSACTIONS)
    good, bad = files.split_quarantine(df)
    assert [r.order_id for r in good.collect()] == ["a"]
    assert bad.count() == 2
    with pytest.raises(Exception):
        files.scan_json(spark, str(p), TRANSACTIONS, mode="FAILFAST").collect()


def test_unknown_sink_format_raises(spark, tmp_path):
    from emporia.sources.files import save_results

    with pytest.raises(ValueError):
        save_results(spark.range(1), str(tmp_path / "x"), "xml")


def test_lake_reingest_is_idempotent_and_missing_day_is_empty(spark, tmp_path):
    from emporia.sources.lake import Lake

    lake = Lake(spark, str(tmp_path / "lake"))
    day1 = rows(spark, TRANSACTIONS, [txn(order_id="a"), txn(order_id="b")])
    day2 = rows(spark, TRANSACTIONS, [txn(order_id="c")])
    lake.ingest_raw("transactions", day1, date="2024-01-01")
    lake.ingest_raw("transactions", day2, date="2024-01-02")
    lake.ingest_raw("transactions", day1, date="2024-01-01")
    parts = {str(r.ingest_date): r.rows for r in lake.partitions("raw", "transactions", TRANSACTIONS).collect()}
    assert parts == {"2024-01-01": 2, "2024-01-02": 1}
    assert lake.read("raw", "transactions", TRANSACTIONS, date="2024-01-05").count() == 0
    assert lake.read("raw", "social", SOCIAL).count() == 0
    with pytest.raises(ValueError):
        lake.ingest_raw("clickstream", day1)


def test_lake_promote_cleans_dedups_and_quarantines(spark, tmp_path):
    from emporia.sources.lake import Lake

    lake = Lake(spark, str(tmp_path / "lake"))
    w = rows(spark, WEBLOGS, [
        dict(event_id="e1", page=" /home ", duration_sec=5, timestamp=TS),
        dict(event_id="e1", page="/late", duration_sec=6, timestamp=TS + dt.timedelta(hours=1)),
        dict(event_id=None, page="/x", duration_sec=1, timestamp=TS),
        dict(event_id="e2", page="", duration_sec=-3, timestamp=TS),
    ])
    lake.ingest_raw("weblogs", w, date="2024-01-01")
    lake.promote("weblogs", WEBLOGS)
    good = lake.read("processed", "weblogs").collect()
    assert [(r.event_id, r.page) for r in good] == [("e1", "/late")]
    bad = lake.read("quarantine", "weblogs")
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing event_id", "negative duration"]


def test_sentiment_rule(spark):
    from emporia.functions.rules import sentiment_from_rating

    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (None,)], "rating int")
    got = [r.s for r in df.select(sentiment_from_rating("rating").alias("s")).collect()]
    assert got == ["negative", "negative", "neutral", "positive", "positive", None]


def test_json_roundtrip_keeps_microseconds(spark):
    from emporia.sources import files

    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(ts, ["#a"])], "t timestamp_ntz, tags array<string>")
    lines = df.select(files.encode_json_column(df))
    back = files.decode_json_column(lines, "value", df.schema).drop("_corrupt_record").first()
    assert back.t == ts and back.tags == ["#a"]


def test_schemas_are_declared_for_all_sources():
    from emporia.schemas import SOURCES, check_source

    assert set(SOURCES) == {"weblogs", "transactions", "reviews", "social"}
    assert isinstance(SOURCES["social"]["hashtags"].dataType, T.ArrayType)
    with pytest.raises(ValueError):
        check_source("orders")
    assert F is not None

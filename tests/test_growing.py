"""Results kept up to date: views by change, sessions over runs, the 360 feed; joins by time, trends, sketches."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emporia.functions import sketches as sk
from emporia.operators import trends
from emporia.operators import customer360 as c3
from emporia.operators import weblogs as wl
from emporia.operators.asof import as_of_join
from emporia.operators.sessions import SessionRuns, gap_sessions
from emporia.plans.incremental import VIEWS, IncrementalViews
from emporia.schemas import REVIEWS, SOCIAL, TRANSACTIONS
from emporia.sources.lake import Lake
from emporia.streaming.customer360_feed import RunningCustomer360, feed_rows

WEB = ("event_id string, timestamp timestamp_ntz, session_id string, customer_id string, page string, country string, "
       "duration_sec long")


def web(spark, n, seed, first=0):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(first, first + n):
        t = start + dt.timedelta(seconds=rng.randrange(6 * 86400))
        c = rng.choice([None, "hot", "hot", "hot", *(f"c{j}" for j in range(12))])
        rows.append((str(i), t, None if c is None else f"{c}-{t:%d}", c, rng.choice(["/a", "/b", None]),
                     rng.choice(["x", "y"]), rng.choice([None, rng.randrange(100)])))
    return spark.createDataFrame(rows, WEB)


def state(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


# ---------------------------------------------------------------- views

def test_views_after_changes_equal_a_full_run(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    views = IncrementalViews(lake, str(tmp_path / "views"))
    src = web(spark, 400, 1)
    lake.ingest_raw("weblogs", src, date=F.col("timestamp"))
    lake.promote("weblogs", src.schema)
    pages, countries = VIEWS["page_popularity"], VIEWS["country_traffic"]
    assert len(views.refresh(pages)["days"]) == 6

    def equal():
        rows = lake.read("processed", "weblogs")
        for view, full in ((pages, wl.page_popularity), (countries, wl.country_traffic)):
            views.refresh(view)
            assert state(views.result(view)) == state(full(rows).select(*views.result(view).columns))

    equal()
    # a replaced day retracts what it no longer holds; the other days' files aren't read
    day = src.where(F.to_date("timestamp") == "2024-01-03")
    lake.ingest_raw("weblogs", day.where("CAST(event_id AS int) % 3 = 0"), date="2024-01-03")
    lake.promote("weblogs", src.schema, date="2024-01-03")
    done = views.refresh(pages)
    assert done["days"] == ["2024-01-03"]
    assert done["files"] == lake.snapshots("weblogs").files("processed").where("day = date'2024-01-03'").count()
    equal()
    assert views.refresh(pages) == {"version": done["version"], "days": [], "files": 0}
    # a day that becomes empty, and a new day
    lake.ingest_raw("weblogs", day.withColumn("duration_sec", F.lit(-1).cast("long")), date="2024-01-03")
    lake.promote("weblogs", src.schema, date="2024-01-03")
    lake.ingest_raw("weblogs", web(spark, 30, 2, first=1000), date="2024-02-01")
    lake.promote("weblogs", src.schema, date="2024-02-01")
    assert views.refresh(pages)["days"] == ["2024-01-03", "2024-02-01"]
    equal()


def test_publishing_without_a_change_leaves_the_table_alone(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    views = IncrementalViews(lake, str(tmp_path / "views"))
    src = web(spark, 50, 3)
    lake.ingest_raw("weblogs", src, date="2024-01-01")
    lake.promote("weblogs", src.schema)
    name = "growing_pages"

    def place():
        return [r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Location"]

    views.publish(VIEWS["page_popularity"], None, name)
    before = place()
    views.publish(VIEWS["page_popularity"], None, name)
    assert place() == before and spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


# ---------------------------------------------------------------- sessions

def plain_sessions(rows, gap):
    by = defaultdict(list)
    for r in rows:
        if r.customer_id is not None and r.timestamp is not None:
            by[r.customer_id].append(r)
    out = []
    for c, events in by.items():
        events.sort(key=lambda r: r.timestamp)
        held = []
        for r in [*events, None]:
            if held and (r is None or (r.timestamp - held[-1].timestamp).total_seconds() >= gap):
                times = [x.duration_sec for x in held if x.duration_sec is not None]
                out.append((c, held[0].timestamp, held[-1].timestamp, len(held), sum(times) if times else None))
                held = []
            held.append(r)
    return sorted(out, key=repr)


@pytest.mark.parametrize("gap", [1800, 200_000])
def test_sessions_of_daily_runs_equal_one_run(spark, tmp_path, gap):
    src = web(spark, 500, 4).unionByName(spark.createDataFrame([("x", None, None, "hot", None, None, 1)], WEB)).persist()
    cols = ("customer_id", "session_start", "session_end", "clicks", "total_time_sec")
    want = plain_sessions(src.collect(), gap)
    assert state(gap_sessions(src, gap), *cols) == want
    runs = SessionRuns(spark, str(tmp_path / "runs"), gap)
    for day in (2, 3, 5, 8):
        runs.run(src, dt.datetime(2024, 1, day))
    assert state(runs.sessions()) == want
    assert state(runs.sessions(2), *cols) == plain_sessions(
        [r for r in src.collect() if r.timestamp and r.timestamp < dt.datetime(2024, 1, 3)], gap)
    with pytest.raises(ValueError):
        runs.run(src, dt.datetime(2024, 1, 5))


def test_a_hot_customers_events_are_intervals_before_the_shuffle(spark):
    plan = gap_sessions(web(spark, 10, 5))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("hashpartitioning") and "partial_min" in plan


# ---------------------------------------------------------------- 360 feed

def sources(spark, part, seed):
    """A slice of each source; slices are in the order of time."""
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1) + dt.timedelta(days=2 * part)
    ids = ["hot", *(f"c{j}" for j in range(6 * part, 6 * part + 8))]
    w = [(f"{part}-{i}", start + dt.timedelta(minutes=i * 20), f"{c}-{(start + dt.timedelta(minutes=i * 20)):%d}", c, "/a", "x",
          rng.randrange(50)) for i in range(40) for c in [rng.choice(ids)]]
    t = spark.createDataFrame([(f"o{part}{i}", start, rng.choice(ids), Decimal(rng.randrange(99)), 10, "shipped")
                               for i in range(9)], "order_id string, timestamp timestamp_ntz, customer_id string, "
                              "total_amount decimal(18,2), discount_pct long, status string")
    r = spark.createDataFrame([(f"r{part}{i}", rng.choice(ids), rng.randrange(1, 6)) for i in range(5)],
                              "review_id string, customer_id string, rating long")
    s = spark.createDataFrame([(f"p{part}{i}", rng.choice([None, *ids]), i) for i in range(5)],
                              "post_id string, customer_id string, likes long")
    return spark.createDataFrame(w, WEB), t, r, s


def test_change_feed_is_the_difference_of_full_360s(spark, tmp_path):
    feed = RunningCustomer360(spark, str(tmp_path / "c360"), buckets=5, keep="1 day")
    so_far, before, held = None, {}, []
    for part in range(4):
        new = sources(spark, part, part)
        so_far = new if so_far is None else tuple(a.unionByName(b) for a, b in zip(so_far, new, strict=True))
        feed.merge(feed_rows(*new), part)
        assert feed.merge(feed_rows(*new), part) is None          # a replayed batch changes nothing
        full = {r.customer_id: r for r in c3.customer_360(*so_far).collect()}
        assert {r.customer_id: r for r in feed.current().collect()} == full
        changed = {r.customer_id: r for r in feed.changes(part - 1).drop("batch_id").collect()}
        assert {k for k in full if before.get(k) != full[k]} <= set(changed)
        assert all(full[k] == r for k, r in changed.items()) and len(changed) < len(full) or part == 0
        before = full
        held.append(feed.table.read("state").where("customer_id = 'hot'").select(F.size("recent")).first()[0])
    assert max(held) <= 3                                          # sessions leave the state
    assert state(feed.customer("hot")) == state(c3.customer_360(*so_far).where("customer_id = 'hot'"))


def test_a_batch_writes_the_buckets_it_touches(spark, tmp_path):
    feed = RunningCustomer360(spark, str(tmp_path / "c360"), buckets=16)
    feed.merge(feed_rows(*sources(spark, 0, 1)), 0)
    before = {r.path for r in feed.table.files("state").collect()}
    w, t, r, s = sources(spark, 1, 2)
    one = [x.where("customer_id = 'hot'") for x in (w, t, r, s)]
    feed.merge(feed_rows(*one), 1)
    after = {r.path for r in feed.table.files("state").collect()}
    assert len(before - after) == 1 and len(after - before) == 1
    assert [r.customer_id for r in feed.changes(0).collect()] == ["hot"]
    assert feed.merge(feed_rows(*[x.where("false") for x in one]), 2) is None


# ---------------------------------------------------------------- as-of join

@pytest.mark.parametrize("block_days", [7, 100_000])
def test_as_of_join_against_duckdb(spark, block_days):
    import duckdb
    import pandas as pd

    rng = random.Random(6)
    start = dt.datetime(2024, 1, 1)

    def times(n):
        return [(rng.choice([None, 1, 1, 1, 2, 3, 4]), rng.choice([start + dt.timedelta(hours=rng.randrange(2000)), None])
                 if rng.random() < 0.1 else start + dt.timedelta(hours=rng.randrange(2000))) for _ in range(n)]

    ev = [(i, k, t) for i, (k, t) in enumerate(times(400))]
    sn = list({(k, t): (k, t, i, None if i % 5 == 0 else i * 1.5) for i, (k, t) in enumerate(times(120)) if k != 4}.values())
    e = spark.createDataFrame(ev, "id long, k long, t timestamp_ntz")
    s = spark.createDataFrame(sn, "k long, s timestamp_ntz, a long, b double")
    con = duckdb.connect()
    con.register("e", pd.DataFrame(ev, columns=["id", "k", "t"]).astype({"k": "Int64"}))
    con.register("s", pd.DataFrame(sn, columns=["k", "s", "a", "b"]).astype({"k": "Int64"}))
    want = con.sql("SELECT id, e.k, t, s.s, a, b FROM e ASOF LEFT JOIN s ON e.k = s.k AND e.t >= s.s").fetchall()
    got = as_of_join(e, s, "k", "t", "s", block_days)
    assert got.columns == ["id", "k", "t", "s", "a", "b"]
    clean = [tuple(None if isinstance(v, float) and v != v else v for v in r) for r in want]
    assert state(got) == sorted(clean, key=repr)
    assert as_of_join(e.where("false"), s, "k", "t", "s").count() == 0
    assert as_of_join(e, s.where("false"), "k", "t", "s").where("a IS NOT NULL").count() == 0


# ---------------------------------------------------------------- trends and sketches

def test_trends_are_exact_and_miss_nothing(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, *"abcdefghij", *(f"tag{j}" for j in range(300))]), w) for w in range(6) for _ in range(700)]
    rows += [("new", 5)] * 40 + [("old", 1)] * 90 + [("old", 5)] * 30 + [("gone", 4)] * 50 + [("x", None)] * 9
    df = spark.createDataFrame(rows, "tag string, w int")
    for slots in (8, 1 << 16):                                     # with 8 counters every item is a candidate
        got = [tuple(r) for r in trends.trending_growth(df, "tag", "w", n=15, slots=slots).collect()]
        n = Counter(rows)
        all_ = [(t, n[t, 5], sum(n[t, w] for w in (2, 3, 4))) for t in {t for t, _ in rows if t}]
        want = [(t, m, b, (m * 3 + 3) / (b + 3)) for t, m, b in all_ if m >= 5]
        assert got == sorted(want, key=lambda r: (-r[3], -r[1], r[0]))[:15] and got[0][0] == "new"
    # counters are upper bounds: none is below its items, their sum is the window's rows
    upper = {r.slot: r.upper for r in trends.frequent_slots(df.where("tag IS NOT NULL"), "tag", "w", 1, 64).collect()}
    assert sum(upper.values()) == sum(c for (t, w), c in n.items() if w == 5 and t)
    assert trends.trending_growth(df.where("false"), "tag", "w").count() == 0


def test_quantiles_of_any_range_from_day_sketches(spark):
    rng = random.Random(8)
    rows = [(d, rng.lognormvariate(0, 2)) for d in range(10) for _ in range(3000)] + [(3, None), (None, 1.0)]
    df = spark.createDataFrame(rows, "d int, x double")
    days = sk.day_quantile_sketches(df, "d", "x").persist()
    for first, last in ((0, 9), (4, 4), (2, 7)):
        values = sorted(x for d, x in rows if d is not None and x is not None and first <= d <= last)
        for r in sk.quantiles_of_range(days, first, last, [0.01, 0.5, 0.75, 0.99]).collect():
            rank = sum(v <= r.value for v in values) / len(values)
            assert r.n == len(values) and abs(rank - r.prob) <= sk.rank_error()
    assert sk.quantiles_of_range(days, 20, 30, [0.5]).count() == 0
    # the bound can fail: a sketch of the smallest size breaks it
    rough = sk.day_quantile_sketches(df, "d", "x", 8)
    values = sorted(x for d, x in rows if d is not None and x is not None)
    worst = max(abs(sum(v <= r.value for v in values) / len(values) - r.prob)
                for r in sk.quantiles_of_range(rough, 0, 9, [i / 20 for i in range(1, 20)], 8).collect())
    assert worst > sk.rank_error()


def test_overlap_of_day_sketches(spark):
    a = spark.createDataFrame([(d, i) for d in range(3) for i in range(3000)] + [(0, None)], "d int, id long")
    b = spark.createDataFrame([(d, i) for d in range(1, 4) for i in range(1000 * d, 1000 * d + 2500)] * 2, "d int, id long")
    got = {r.day: tuple(r)[1:] for r in sk.overlap(sk.day_id_sketches(a, "d", "id"), sk.day_id_sketches(b, "d", "id")).collect()}
    # below 2 ** LG distinct ids the sketches are exact
    assert got == {0: (3000, 0, 3000, 0), 1: (3000, 2500, 3500, 2000), 2: (3000, 2500, 4500, 1000), 3: (0, 2500, 2500, 0)}
    assert sk.distinct_of_range(sk.day_id_sketches(b, "d", "id"), 1, 2).select(F.theta_sketch_estimate("ids")).first()[0] == 3500

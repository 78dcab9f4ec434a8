"""Lake snapshots: commits of both zones at once, versions, conflicts, and lookups that skip files."""

import pytest
from pyspark.sql import functions as F

from emporia.sources import snapshots as sn
from emporia.sources.lake import PART, Lake
from emporia.sources.snapshots import Change, CommitConflict, Snapshots

SCHEMA = "event_id long, customer_id long, v int, d date"


def table(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "t"), "d", ("event_id", "customer_id"))


def rows(spark, data):
    return spark.createDataFrame(data, "event_id long, customer_id long, v int, day string").select(
        "event_id", "customer_id", "v", F.to_date("day").alias("d"))


def state(df):
    return sorted(tuple(r) for r in df.collect())


def replace_day(t, df, day, base=None):
    base = t.version() if base is None else base
    files = t.files("z", base)
    return t.commit("replace", {"z": Change(t.write_files("z", df), None if files is None else
                                            files.where(F.col("day") == F.to_date(F.lit(day))), df.schema)}, base)


def test_versions_stay_readable_through_full_manifests(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sn, "FULL_EVERY", 3)
    t = table(spark, tmp_path)
    assert t.version() == 0 and t.read("z") is None and t.days("z") == []
    expected, now = {}, {}
    for i in range(7):
        day = f"2024-01-0{i % 3 + 1}"
        data = [(10 * i + j, j, i, day) for j in range(3)] if i != 5 else []
        now = {k: v for k, v in now.items() if k != day} | ({day: data} if data else {})
        version = replace_day(t, rows(spark, data), day)
        assert version == i + 1
        expected[version] = state(rows(spark, [r for d in now.values() for r in d]))
    for version, want in expected.items():
        assert state(t.read("z", version)) == want, version
    assert t.days("z") == sorted(now) and t.days("z", 2) == ["2024-01-01", "2024-01-02"]
    assert state(t.read("z", date=F.to_date(F.lit("2024-01-02")))) == state(rows(spark, now["2024-01-02"]))
    assert t.changed_days("z", 5) == ["2024-01-01", "2024-01-03"] and t.changed_days("z", 0, 1) == ["2024-01-01"]
    with pytest.raises(ValueError):
        t.read("z", 99)


def test_commits_from_one_version(spark, tmp_path):
    """Other days: both stay. The same day: the later one fails and changes nothing."""
    t = table(spark, tmp_path)
    replace_day(t, rows(spark, [(1, 1, 0, "2024-01-01")]), "2024-01-01")
    base = t.version()
    assert replace_day(t, rows(spark, [(2, 1, 0, "2024-01-02")]), "2024-01-02", base) == 2
    assert replace_day(t, rows(spark, [(3, 1, 0, "2024-01-01")]), "2024-01-01", base) == 3
    with pytest.raises(CommitConflict):
        replace_day(t, rows(spark, [(4, 1, 0, "2024-01-01")]), "2024-01-01", base)
    assert [r[0] for r in state(t.read("z"))] == [2, 3]


def events(spark, ids, day="2031-01-01", duration=5):
    return spark.createDataFrame([(str(i), str(i % 7), duration) for i in ids],
                                 "event_id string, customer_id string, duration_sec long")


def test_promotion_killed_between_its_steps(spark, tmp_path, monkeypatch):
    """Whatever step dies, readers meet the state before; both zones change together afterwards."""
    lake = Lake(spark, str(tmp_path / "lake"))
    schema = events(spark, [1]).schema
    lake.ingest_raw("weblogs", events(spark, range(20)), date="2031-01-01")
    first = lake.promote("weblogs", schema)
    before = state(lake.read("processed", "weblogs"))
    lake.ingest_raw("weblogs", events(spark, range(5)).unionByName(events(spark, [99], duration=-1)), date="2031-01-01")
    for step, at in (("write_files", 2), ("_publish", 1)):
        calls = []
        real = getattr(Snapshots, step)

        def dies(self, *a, **k):
            calls.append(1)
            if len(calls) == at:
                raise KeyboardInterrupt(step)
            return real(self, *a, **k)

        for date in (None, "2031-01-01"):
            calls.clear()
            with monkeypatch.context() as m:
                m.setattr(Snapshots, step, dies)
                with pytest.raises(KeyboardInterrupt):
                    lake.promote("weblogs", schema, date=date)
            assert state(lake.read("processed", "weblogs")) == before
            assert lake.read("quarantine", "weblogs").count() == 0
    second = lake.promote("weblogs", schema)
    assert second == first + 1
    assert sorted(r.event_id for r in lake.read("processed", "weblogs").collect()) == list("01234")
    assert [r.key for r in lake.read("quarantine", "weblogs").collect()] == ["99"]
    assert state(lake.as_of("weblogs", first)) == before
    assert lake.read("quarantine", "weblogs", version=first).count() == 0
    with pytest.raises(ValueError):
        lake.read("raw", "weblogs", schema, version=1)


def test_superseded_records_leave_earlier_days_in_one_commit(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    schema = events(spark, [1]).schema
    for k in range(4):
        lake.ingest_raw("weblogs", events(spark, range(10 * k, 10 * k + 10)), date=f"2031-01-0{k + 1}")
    base = lake.promote("weblogs", schema)
    files = {r.path for r in lake.snapshots("weblogs").files("processed").collect()}
    lake.ingest_raw("weblogs", events(spark, [3, 4, 13, 35, 90], duration=8), date="2031-01-03")
    assert lake.promote("weblogs", schema, date="2031-01-03") == base + 1
    days = {}
    for r in lake.read("processed", "weblogs").collect():
        days.setdefault(str(r[PART])[-2:], set()).add(int(r.event_id))
    assert days == {"01": set(range(10)) - {3, 4}, "02": set(range(10, 20)) - {13}, "03": {3, 4, 13, 90},
                    "04": set(range(30, 40))}
    left = {r.path for r in lake.snapshots("weblogs").files("processed").collect()}
    untouched = [r.path for r in lake.snapshots("weblogs").files("processed", base).collect()
                 if str(r.day) == "2031-01-04"]
    assert set(untouched) <= left and len(files & left) == len(untouched)


def test_lookups_read_the_files_that_can_hold_the_id(spark, tmp_path):
    t = table(spark, tmp_path)
    data = [(i, (i * 7919) % 400 if i % 50 else None, i, f"2024-01-{1 + i % 8:02d}") for i in range(4000)]
    df = rows(spark, data).repartition(40, "event_id")
    adds = t.write_files("z", df)
    t.commit("load", {"z": Change(adds, None, df.schema)}, 0)
    n_files = t.files("z").count()
    for ids in ([5], [0, 399, 17], [12345]):
        found = t.lookup("z", "customer_id", ids)
        assert state(found) == state(df.where(F.col("customer_id").isin(ids)))
    assert t.files_with("z", "customer_id", [12345]).count() == 0        # out of every range
    gone = t.files_with("z", "event_id", [2001])
    assert 1 <= gone.count() < n_files
    assert state(t.lookup("z", "event_id", [2001])) == state(df.where("event_id = 2001"))
    # every id is admitted by the filter of each file that holds it
    held = (t.read("z").where("customer_id IS NOT NULL")
            .select("customer_id", F.col("_metadata.file_path").alias("path")).distinct().collect())
    for c in (1, 77, 250, 399):
        assert {r.path for r in held if r.customer_id == c} <= {r.path for r in t.files_with("z", "customer_id", [c]).collect()}
    with pytest.raises(ValueError):
        t.lookup("z", "v", [1])


def test_an_id_within_the_range_but_not_in_the_file_is_skipped(spark, tmp_path):
    t = table(spark, tmp_path)
    df = rows(spark, [(i, 2 * i, 0, "2024-01-01") for i in range(1000)])
    t.commit("load", {"z": Change(t.write_files("z", df), None, df.schema)}, 0)
    odd = [t.files_with("z", "customer_id", [2 * i + 1]).count() for i in range(0, 8)]
    assert sum(odd) <= 1 and all(t.files_with("z", "customer_id", [2 * i]).count() for i in range(0, 1000, 250))


def test_clustering_keeps_rows_and_narrows_lookups(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    schema = events(spark, [1]).schema
    for k in range(3):
        lake.ingest_raw("weblogs", events(spark, range(200 * k, 200 * k + 200)).repartition(6), date=f"2031-01-0{k + 1}")
    lake.promote("weblogs", schema)
    before = state(lake.read("processed", "weblogs"))
    lake.cluster("weblogs", n_files=12)
    assert state(lake.read("processed", "weblogs")) == before
    files = lake.snapshots("weblogs").files("processed").count()
    hit = lake.snapshots("weblogs").files_with("processed", "customer_id", ["3"]).count()
    assert files >= 9 and hit <= 6
    assert state(lake.lookup("weblogs", ["3"])) == [r for r in before if r[1] == "3"]
    # an empty zone can be looked into
    empty = Lake(spark, str(tmp_path / "empty"))
    empty.ingest_raw("weblogs", events(spark, [1]).where("false"), date="2031-01-01")
    empty.promote("weblogs", schema, date="2031-01-01")
    assert empty.lookup("weblogs", ["3"]).count() == 0 and empty.dates("processed", "weblogs") == []

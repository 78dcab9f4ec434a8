"""Findings of round 4: what a promotion of several days keeps on disk."""

import glob
import random
import time
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emporia.plans.queries_io import once
from emporia.session import ensure_checkpoint_dir, shuffles_freed
from emporia.sources.lake import PART, Lake
from emporia.sources.snapshots import Snapshots

LINE = "order_id string, customer_id string, total_amount decimal(18,2), quantity long, discount_pct long"


def landed(spark, root, days):
    lake = Lake(spark, str(root / "lake"))
    for k, rows in enumerate(days, 1):
        df = spark.createDataFrame([(o, c, a and Decimal(a), 1, 0) for o, c, a in rows], LINE)
        lake.ingest_raw("transactions", df, date=f"2031-01-0{k}")
    return lake, df.schema


def processed(lake):
    return Counter((r.order_id, r.customer_id, str(r.total_amount), r[PART].day) for r in lake.read("processed", "transactions").collect())


def written(monkeypatch):
    """(zone, plan, whether its rows are known to be of one day) of every table that is written."""
    found, write_files = [], Snapshots.write_files

    def noted(self, zone, df, *a, one_day=None, **b):
        found.append((zone, df._jdf.queryExecution().optimizedPlan().toString(), one_day is not None))
        return write_files(self, zone, df, *a, one_day=one_day, **b)

    monkeypatch.setattr(Snapshots, "write_files", noted)
    return found


@pytest.mark.parametrize("replayed", [0, 0.2, 0.8, 1])
def test_lines_of_several_days_against_plain_loops(spark, tmp_path, replayed):
    """Few, most or all early lines come again; equal lines of a day are separate ones, nulls are equal."""
    rng = random.Random(int(10 * replayed))
    days = [[(f"{k}-{i // 2}", rng.choice([None, "x"]), f"{i // 2}.00") for i in range(40)] for k in (1, 2, 3)]
    for k in (0, 1):
        days[k + 1] += [r for r in days[k] if rng.random() < replayed]
    days[2] += [("bad", "x", None)]
    last = {r: k for k, rows in enumerate(days, 1) for r in rows}
    expected = Counter((*r, k) for k, rows in enumerate(days, 1) for r in rows if last[r] == k and r[2])
    lake, schema = landed(spark, tmp_path, days)
    lake.promote("transactions", schema)
    got = processed(lake)
    assert got == Counter({(o, c, str(Decimal(a)), k): n for (o, c, a, k), n in expected.items()})
    assert lake.read("quarantine", "transactions").count() == 1


def test_whole_replays_cost_no_shuffle_of_rows(spark, tmp_path, monkeypatch):
    """Only ids cross the network: the last day's rows are written by the tasks that hold them."""
    found = written(monkeypatch)
    day = [(f"{i}", "x", "1.00") for i in range(50)]
    lake, schema = landed(spark, tmp_path, [day, day])
    lake.promote("transactions", schema)
    ((_, plan, one_day),) = [x for x in found if x[0] == "processed"]
    assert one_day and "Join" not in plan and "Union" not in plan
    assert processed(lake) == Counter((o, c, a, 2) for o, c, a in day)


def test_days_without_replays_are_not_joined(spark, tmp_path, monkeypatch):
    found = written(monkeypatch)
    lake, schema = landed(spark, tmp_path, [[(f"{k}-{i}", "x", "1.00") for i in range(20)] for k in range(3)])
    lake.promote("transactions", schema)
    assert len(found) == 3 and not any("Join" in plan for _, plan, _ in found)
    assert lake.read("processed", "transactions").count() == 60


def shuffle_files(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in local for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffle_files(spark)
    df.write.parquet(str(tmp_path / "kept"))
    kept = shuffle_files(spark) - before
    assert kept
    with shuffles_freed(spark):
        df.write.parquet(str(tmp_path / "freed"))
    for _ in range(50):
        if not (left := shuffle_files(spark) - before - kept):
            break
        time.sleep(0.2)
    assert not left
    assert spark.read.parquet(str(tmp_path / "freed")).count() == 7


def test_a_work_table_goes_when_it_has_landed(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/emporia/source-*"))
    with once(spark.range(5)) as src:
        assert src.count() == 5
        assert len(set(glob.glob(f"{root}/emporia/source-*")) - before) == 1
    assert set(glob.glob(f"{root}/emporia/source-*")) == before

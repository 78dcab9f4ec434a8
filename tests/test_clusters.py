"""Clusters against a plain Lloyd run from the same seeds."""

import random

from emporia.operators import clusters as cl


def buyers(spark, n=600, seed=5, parts=4):
    rng, rows = random.Random(seed), []
    for i in range(n):
        group = i % 4
        rows.append((f"c{i}", rng.randrange(30) + 200 * group, 1 + 2 ** (2 * group) + rng.randrange(2), 10.0 * 7 ** group + rng.random()))
    return rows, spark.createDataFrame(rows, "customer_id string, recency_days long, frequency long, monetary double").repartition(parts)


def plain(points, centres):
    """Lloyd's steps in plain Python, to the end."""
    d2 = lambda p, c: sum((a - b) ** 2 for a, b in zip(p, c, strict=True))
    while True:
        groups = [[] for _ in centres]
        for p in points:
            groups[min(range(len(centres)), key=lambda k: (d2(p, centres[k]), k))].append(p)
        moved = [tuple((2 * sum(x) + len(g)) // (2 * len(g)) for x in zip(*g, strict=True)) if g else c
                 for g, c in zip(groups, centres, strict=True)]
        if moved == centres:
            return moved, sum(min(d2(p, c) for c in centres) for p in points)
        centres = moved


def test_equals_plain_steps_from_the_same_seeds(spark):
    _, df = buyers(spark)
    members, model = cl.rfm_clusters(df, k=5)
    points = [tuple(r.p) for r in model.rows.collect()]
    centres, inertia = plain(points, model.start)
    assert sorted(set(centres)) == sorted(model.centres)
    assert model.inertia() == inertia <= model.inertia(model.start)
    assert members.count() == 600 and {r.cluster for r in members.collect()} == set(range(1, len(model.centres) + 1))
    # four far groups: none shares a cluster with another
    group = {}
    for r in members.collect():
        group.setdefault(r.cluster, set()).add(int(r.customer_id[1:]) % 4)
    assert all(len(g) == 1 for g in group.values())


def test_partitions_do_not_matter(spark):
    runs = [cl.rfm_clusters(buyers(spark, parts=n)[1], k=4)[1] for n in (1, 7)]
    assert runs[0].start == runs[1].start and runs[0].centres == runs[1].centres
    assert cl.cluster(buyers(spark)[1], "customer_id", ["monetary"], 3, seed=1).start != cl.cluster(
        buyers(spark)[1], "customer_id", ["monetary"], 3, seed=2).start


def test_check_can_fail(spark, monkeypatch):
    _, df = buyers(spark)
    assert {r.within_bound for r in cl.rfm_clusters_checked(df, k=4).collect()} == {True}
    monkeypatch.setattr(cl, "lloyd", lambda rows, centres, steps, tolerance: [tuple(x + 900 for x in c) for c in centres])
    assert False in {r.within_bound for r in cl.rfm_clusters_checked(df, k=4).collect()}


def test_defined_cases(spark):
    schema = "customer_id string, recency_days long, frequency long, monetary double"
    members, model = cl.rfm_clusters(spark.createDataFrame([], schema))
    assert members.count() == 0 and model.centres == [] and model.inertia() == 0
    assert cl.rfm_clusters_checked(spark.createDataFrame([], schema)).count() == 0
    same = [(f"c{i}", 5, 1, 2.0) for i in range(40)] + [("null", None, 1, 2.0), ("nan", 1, 1, float("nan"))]
    members, model = cl.rfm_clusters(spark.createDataFrame(same, schema), k=3)
    assert model.centres == [(0, 0, 0)] and {(r.cluster, r.distance) for r in members.collect()} == {(1, 0)}
    assert members.count() == 40  # rows without a measure have no cluster
    hot = same[:40] + [("far", 50, 9, 900.0), ("minus", 5, 1, -4.0)]
    members, model = cl.rfm_clusters(spark.createDataFrame(hot, schema), k=2)
    assert len(model.centres) == 2 and members.count() == 42

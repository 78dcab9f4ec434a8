import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.llm import hnsw as H


def brute(x, threshold=0.95):
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(x)).min(1))
        if (new == label).all():
            return near.sum(1), label
        label = new


def _vectors(seed=0, n=1500, dim=24):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x[:n // 3] = x[0] + 0.03 * rng.normal(size=(n // 3, dim))  # a third is one tight group
    for k in range(n // 2, n // 2 + 100, 4):  # small groups
        x[k:k + 4] = x[k] + 0.05 * rng.normal(size=(4, dim))
    return H.unit(x)


def test_search_finds_the_links():
    x = _vectors()
    q, node, _ = H.HNSW(x).within(x, 0.95, 16, np.arange(len(x)))
    got = set(zip(q.tolist(), node.tolist(), strict=True))
    want = set(zip(*map(list, np.nonzero(x @ x.T >= 0.95)), strict=True))
    assert len(got) == len(q) and got <= want and len(got) >= 0.99 * len(want)


def test_a_beam_as_wide_as_the_graph_finds_everything():
    x = _vectors(3, 300)
    ids, _ = H.HNSW(x).beam(x[:5].astype(np.float32), np.zeros((5, 1), int), 300, 0)
    assert all(sorted(r) == list(range(300)) for r in ids)


def test_forest_joins_the_same_nodes():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 300, 260), rng.integers(0, 300, 260)
    u, v = H.forest(a, b)
    assert len(u) < 300

    def parts(a, b):
        label = {k: k for k in {*a.tolist(), *b.tolist()}}
        for _ in range(300):
            for p, q in zip(a.tolist(), b.tolist(), strict=True):
                label[p] = label[q] = min(label[p], label[q])
        return label
    assert parts(a, b) == parts(np.r_[u, a[:0]], np.r_[v, b[:0]]) | {k: k for k in parts(a, b) if k not in parts(u, v)}


@pytest.mark.parametrize("shard_rows", [50_000, 200])
def test_links_against_brute_force(spark, shard_rows):
    x = _vectors(5, 900)
    rows = [(int(k) * 3 + 1, [float(c) for c in v]) for k, v in enumerate(x)]
    rows += [(10_000, rows[0][1]), (10_001, rows[0][1]), (10_002, rows[600][1])]  # copies
    order = sorted(rows)
    n, label = brute(np.array([v for _, v in order]))
    got = H.link_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"),
                            shard_rows=shard_rows).orderBy("vec_id").collect()
    ids = [i for i, _ in order]
    assert [r.vec_id for r in got] == ids
    found = np.array([r.n_links for r in got])
    assert (found <= n).all() and found.sum() >= 0.99 * n.sum()
    assert [r.component_id for r in got] == [ids[k] for k in label]


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []),
            (8, [1.0, 0.0, 0.0]), (9, [2.0, -0.0]), (9, [2.0, 0.0]), (None, [1.0, 0.0]), (10, [0.0, 1.0]),
            (11, [3e38, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr(
        "*", "'x' as v", "'y' as n_links", "1 as component_id")
    got = sorted((str(r.vec_id), r.n_links, r.component_id) for r in H.link_embeddings(df).collect())
    assert got == sorted([("1", 4, 1), ("9", 4, 1), ("9", 4, 1), ("None", 4, 1), ("11", 4, 1), ("2", 0, 2), ("3", 0, 3),
                          ("4", 0, 4), ("5", 0, 5), ("6", 0, 6), ("7", 0, 7), ("8", 0, 8), ("10", 0, 10)])
    assert H.link_embeddings(df.where("false")).count() == 0


def test_audit_weighs_each_class_the_same():
    dense = {k: (1000, 1000) for k in range(100)}
    pairs = {k: (1, 1) for k in range(100, 140)}
    audit = dense | pairs
    full = {k: n for k, (n, _) in audit.items()}
    assert H.enough_found(audit, full, 0.99) and H.enough_found({}, {}, 0.99)
    # 99.96 % of all links are found, but none of the pairs
    assert not H.enough_found(audit, {k: 1000 for k in dense}, 0.99)
    # classes with many links can't hide those with few, nor some classes that miss all the mean
    many = {k: (10, 10) for k in range(10_000)} | {k: (1, 1) for k in range(10_000, 10_010)}
    assert not H.enough_found(many, {k: 10 for k in range(10_000)}, 0.99)
    assert not H.enough_found(dense, {k: 980 for k in dense} | {k: 1000 for k in range(95)}, 0.99)


def test_audit_draws_until_it_meets_links(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 24))
    x[400:420] = x[:20] + 0.001 * rng.normal(size=(20, 24))  # few pairs among many rows
    rows = spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)],
                                 "vec_id bigint, v array<double>")
    classes = H.staged(H._classes(rows), "classes")
    assert len(H.audit_sample(classes, 0.95, sample=20, blocks=1)) < 40
    audit = H.audit_sample(classes, 0.95, sample=20, blocks=100)
    assert len(audit) == 40 and set(audit.values()) == {(1, 1)}
    by_id = {r.least: r["class"] for r in classes.collect()}
    a, b = by_id[0], by_id[400]
    links = spark.createDataFrame([(a, a, 1), (a, b, 0)], "a bigint, b bigint, n bigint")
    counts = links.where("a = b").selectExpr("a as class", "n")
    # b, that its own search has not linked, is audited too
    seen = H.audit_linked(classes, links, counts, 0.95)
    assert seen == {a: (1, 1), b: (1, 1)}
    assert not H.enough_found(seen, H.found_links(counts, seen), 0.99)


def test_small_groups_beside_a_dense_one(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1500, 32))
    x[:500] = x[0] + 0.02 * rng.normal(size=(500, 32))
    x[1000:1200] = x[600:800] + 0.05 * rng.normal(size=(200, 32))  # pairs
    x = H.unit(x)
    n, _ = brute(x)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)]
    got = H.link_embeddings(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), ef=1).collect()
    share = {r.vec_id: r.n_links / n[r.vec_id] for r in got if n[r.vec_id]}
    few = [s for k, s in share.items() if n[k] <= H.FEW]
    assert len(few) >= 400 and np.mean(few) >= 0.99 and np.mean(list(share.values())) >= 0.99


def test_matrix_products_find_everything():
    x = _vectors(7, 700)
    q, node, crowded = H.HNSW(x).within(x[:300], 0.95, 700, np.arange(300))
    assert crowded.all()
    assert set(zip(q.tolist(), node.tolist(), strict=True)) == set(
        zip(*map(list, np.nonzero(x[:300] @ x.T >= 0.95)), strict=True))


def test_crowded_queries_are_compared_in_steps_of_bounded_bytes(monkeypatch):
    """A third of a shard in one group of different near copies: every link is found, and soon."""
    import time

    rng = np.random.default_rng(12)
    x = rng.normal(size=(6000, 64))
    x[:2000] = x[0] + 0.02 * rng.normal(size=(2000, 64))
    x = H.unit(x)
    graph = H.HNSW(x)
    monkeypatch.setattr(H, "PRODUCT_BYTES", 1 << 20)
    began = time.process_time()
    q, node, crowded = graph.within(x[:512], 0.95, 32, np.arange(512))
    assert time.process_time() - began < 20        # node by node it took more than a minute
    assert crowded.all() and len(q) == (x[:512] @ x.T >= 0.95).sum()


def test_a_link_found_from_one_end_counts_for_both(spark):
    shards = 4
    shard = {r.c: r.s for r in spark.range(40).select(F.col("id").alias("c"), H.shard_of("id", shards).alias("s")).collect()}
    a, b, c, d = 1, 2, 3, 4
    rows = [(shard[b], a, b, 2, 5),                                        # only a found b
            (shard[c], a, c, 2, 1), (shard[a], c, a, 1, 2),                # both found the other
            (shard[a], d, d, 1, 7), (shard[d], a, d, 2, 1),                # d saw all of a's shard: a is in its 7
            (shard[a], d, b, 0, 0)]                                        # joins components only
    links = spark.createDataFrame(rows, H._LINKS)
    got = {r["class"]: r.n for r in H.link_counts(links, shards).collect()}
    assert got == {a: 5 + 1 + 1, b: 2, c: 2, d: 7}


def test_counts_are_exact_at_both_ends(spark):
    """With beams of one node some links are found from one end only; every vector that is linked counts them."""
    x = _vectors(5, 900)
    n, label = brute(x)
    got = H.link_embeddings(spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(x)],
                                                  "vec_id bigint, embedding array<double>"), recall=0.0, ef=4).collect()
    size = {}
    for r in got:
        size[r.component_id] = size.get(r.component_id, 0) + 1
    assert all(r.n_links <= n[r.vec_id] for r in got)
    assert all((r.n_links > 0) == (size[r.component_id] > 1) for r in got)

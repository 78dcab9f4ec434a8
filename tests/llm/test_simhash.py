import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.llm import simhash as S


def brute_fingerprint(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words, at = [], ""
    for c in w + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            if at:
                words.append(at)
            at = ""
        else:
            at += c
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=3):
    """prints: id -> fingerprint; id -> smallest id reachable."""
    ids = sorted(prints)
    label = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a in ids:
            for b in ids:
                if label[a] < label[b] and (prints[a] ^ prints[b]).bit_count() <= radius:
                    label[b] = label[a]
                    moved = True
    return label


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_fingerprint(text):
    text = text.encode("utf-8", "ignore").decode()
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def test_spark_agrees_on_the_hash(spark):
    got = spark.sql("select xxhash64('ein wort mehr') as h").first().h
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"ein wort mehr", 42)


def _near(rng, base, bits):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def test_bk_tree_finds_all_within_the_radius():
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = np.array(sorted({_near(rng, rng.choice(base), rng.randint(0, 5)) for _ in range(600)}), np.uint64)
    got = {(node, int(q)) for node, near in S.BKTree(prints).search(prints, 3) for q in near}
    want = {(i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3)}
    assert got == want


@pytest.mark.parametrize("shard", [4096, 32])
def test_components_against_brute_force(spark, shard):
    """With a small shard bound the hot shards are cut again, several times over."""
    rng = random.Random(7)
    chain = rng.getrandbits(64)
    prints = {}
    for k in range(260):
        if k < 90:  # one dense group: a third of all rows
            prints[1000 - k] = _near(rng, 0x0F0F0F0F0F0F0F0F, rng.randint(0, 4))
        elif k < 120:  # a chain, each within the radius of the last one only
            chain = _near(rng, chain, 3)
            prints[1000 - k] = chain
        else:
            prints[1000 - k] = rng.getrandbits(64) if k % 2 else _near(rng, prints[1000 - k + 1], rng.randint(0, 6))
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in prints.items()]
    marked = spark.createDataFrame(rows, "doc_id bigint, fingerprint bigint")
    old, S.SHARD = S.SHARD, shard
    try:
        links = S.fingerprint_links(marked.select(marked.fingerprint.alias("fp")).distinct(), 3, shard)
        from emporia.llm.graph import connected_components
        root = {r.node: r.root for r in connected_components(links).collect()}
    finally:
        S.SHARD = old
    want = brute_components(prints)
    by_root, by_want = {}, {}
    for i, f in rows:
        by_root.setdefault(root.get(f, f), set()).add(i)
        by_want.setdefault(want[i], set()).add(i)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_want.values()))


def test_defined_cases(spark, odd_docs, no_docs):
    rows = S.simhash_components(odd_docs).collect()
    assert len(rows) == 12
    blank = [r for r in rows if r.fingerprint == 0]
    assert {r.doc_id for r in blank} == {None, 1, 2, 3} and {r.component_id for r in blank} == {1}
    fox = S.fingerprint(b"The quick brown fox jumps over the lazy dog.")
    fox = fox - (1 << 64) if fox >> 63 else fox
    assert [r.component_id for r in rows if r.fingerprint == fox] == [7] * 4
    assert S.simhash_components(no_docs).count() == 0


def test_one_row_of_each_component_stays(spark, odd_docs, no_docs):
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows) == [1, 4, 5, 6, 7, 9]
    assert all(r.fingerprint == "old fingerprint" for r in rows)
    assert S.keep_one(no_docs).count() == 0
    only_null = odd_docs.where("doc_id is null and text is not null")
    assert S.keep_one(only_null.unionByName(only_null)).count() == 1

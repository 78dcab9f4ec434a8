import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.llm import suffixes
from emporia.llm.suffixes import anchored_runs, least_owner, positions, remove_repeats

COLUMNS = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"]


def brute(docs, length):
    """Every string of every document in a dictionary with its smallest id."""
    least = {}
    texts = [(i, (t or "").encode()) for i, t in docs]
    for i, t in texts:
        for j in range(len(t) - length + 1):
            s = t[j:j + length]
            if i is not None and (s not in least or i < least[s]):
                least[s] = i
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for j in range(len(t) - length + 1):
            first = least.get(t[j:j + length])
            if first is not None and (i is None or first < i):
                gone[j:j + length] = b"\1" * length
        spans = sum(gone[j] and (j == 0 or not gone[j - 1]) for j in range(len(t)))
        out.append((i, bytes(b for b, g in zip(t, gone, strict=True) if not g), len(t), sum(gone), spans))
    return sorted(out, key=repr)


def result(df):
    return sorted([(r["doc_id"], bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"])
                   for r in df.select(*COLUMNS).collect()], key=repr)


def corpus(rng, n, letters="abcdé 😀"):
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(40)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 25))) for _ in range(25)]
    docs = []
    for i in range(n):
        kind = rng.randrange(6)
        if kind == 0 and docs:
            text = rng.choice(docs)[1]                                       # a copy
        elif kind == 1 and docs:
            text = rng.choice(docs)[1] or ""
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", "X", "YZ"]) + text[at + rng.randrange(2):]      # a near copy
        else:
            text = "\n".join(rng.choice([rng.choice(lines), " ".join(rng.choices(words, k=9))])
                             for _ in range(rng.randrange(0, 6)))
        docs.append((rng.choice([i, i, i, i // 3, None]), text))
    return docs


@pytest.mark.parametrize("length", [50, 12, 2])
def test_against_brute_force(spark, length, monkeypatch):
    rng = random.Random(length)
    docs = corpus(rng, 160)
    for name in ("BUCKET_BYTES", "SHARD_BYTES"):
        monkeypatch.setattr(suffixes, name, 8_000)                           # several buckets and shards
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    expected = brute(docs, length)
    assert any(0 < r[3] < r[2] and r[4] > 1 for r in expected)
    assert result(remove_repeats(df, length)) == expected


def test_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumns({c: F.lit("old") for c in ("pack", "ids", "kept", "n_bytes", "shared", "starts")})
    assert result(remove_repeats(clash)) == brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()], 50)
    assert remove_repeats(no_docs).collect() == []
    one = spark.createDataFrame([(3, "ab" * 100), (1, "ab" * 30), (2, "b" + "ab" * 30 + "c")], "doc_id bigint, text string")
    assert result(remove_repeats(one)) == brute([tuple(r) for r in one.collect()], 50)
    with pytest.raises(ValueError):
        remove_repeats(one, 1)


def test_query_counts_and_digests(spark, duck):
    from emporia.llm.queries import QUERIES

    docs = duck.sql("SELECT doc_id, text FROM documents").fetchall()
    got = [tuple(r) for r in QUERIES["op11_suffix_dedup"](spark, "/root/testdata/sf0.001").select(
        "doc_id", "kept_sha256", "n_bytes", "n_removed", "n_spans").collect()]
    assert sorted(got) == sorted((i, hashlib.sha256(k).hexdigest(), *rest) for i, k, *rest in brute(docs, 50))
    assert any(r[3] for r in got)


@pytest.mark.parametrize("depth", [1, 2, 3, 7, 50, 400])
def test_positions_order_suffixes(depth):
    rng = np.random.default_rng(depth)
    for n in [0, 1, 2, 3, 4, 5, 9, 10, 11, 60, 301]:
        for kinds in (1, 2, 4):
            s = rng.integers(1, kinds + 1, n)
            place = positions(s, depth)
            suffix = [tuple(s[i:i + depth]) for i in range(n)]
            order = sorted(range(n), key=lambda i: place[i])
            assert [suffix[i] for i in order] == sorted(suffix)
            assert all(suffix[i] == suffix[j] for i, j in zip(order, order[1:]) if place[i] == place[j])


def test_positions_with_large_symbols():
    s = np.random.default_rng(0).integers(1, 3_000_000, 40)
    s = np.concatenate([s, s[:30], s])
    place = positions(s, 100)
    assert sorted(range(len(s)), key=lambda i: place[i]) == sorted(range(len(s)), key=lambda i: tuple(s[i:]))


def test_least_owner_of_runs():
    rng = random.Random(2)
    runs = list({bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(6, 30))) for _ in range(80)})
    owner = np.array([rng.randrange(50) for _ in runs])
    least, begin = least_owner(runs, owner, 6)
    expected = {}
    for r, o in zip(runs, owner, strict=True):
        for j in range(len(r) - 5):
            expected[r[j:j + 6]] = min(o, expected.get(r[j:j + 6], 99))
    for r, b in zip(runs, begin, strict=True):
        assert [least[b + j] for j in range(len(r) - 5)] == [expected[r[j:j + 6]] for j in range(len(r) - 5)]


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(4)
    for length in (5, 20, 50):
        data = rng.integers(97, 99, 3000).astype(np.uint8)
        data[2000:2500] = data[100:600]
        bounds = np.array([0, 0, 1000, 1003, 2990, 3000])
        first, n, doc, h = anchored_runs(data, bounds, length)
        hash_of = {}
        covered = 0
        for f, k, d, x in zip(first, n, doc, h, strict=True):
            assert bounds[d] <= f and f + k - 1 + length <= bounds[d + 1]
            covered += k
            for i in range(f, f + k):
                assert hash_of.setdefault(data[i:i + length].tobytes(), x) == x
        assert covered == sum(max(0, s - length + 1) for s in np.diff(bounds))

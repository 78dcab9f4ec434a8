import hashlib

import numpy as np
import pytest

from emporia.llm import shards as S

P = pytest.importorskip("public_tokenizers")
RANKS, END = P.path("byte_bpe_50k.tiktoken"), 50256


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(S.Feistel(n, b"k").slots(np.arange(n)).tolist()) == list(range(n))


def test_feistel_depends_on_the_key():
    a, b = (S.Feistel(1000, k).slots(np.arange(1000)) for k in (b"a", b"b"))
    assert (a != b).mean() > 0.9 and (a != np.arange(1000)).mean() > 0.9


def _materialise(df, **kw):
    root, table = S.materialise(df, RANKS, P.PATTERN, END, b"key", **kw)
    return root, sorted(table.collect(), key=lambda r: r.slot)


def test_round_trip(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    root, rows = _materialise(df, length=128, shard_rows=50)
    ids = S.read_slots(root, 0, 10 ** 6, 128, 50)
    assert [r.slot for r in rows] == list(range(len(ids))) and len(ids) > 500
    assert all(r.shard == r.slot // 50 and r.byte_offset == r.slot % 50 * 256 for r in rows)
    assert all(hashlib.sha256(x.astype("<u2").tobytes()).hexdigest() == r.sha256 for x, r in zip(ids, rows, strict=True))
    assert (S.read_slots(root, 77, 111, 128, 50) == ids[77:188]).all()  # resumed in the middle
    parts = {}
    for x, r in zip(ids, rows, strict=True):
        assert sum(d.length for d in r.docs) == r.n_tokens and (x[r.n_tokens:] == END).all()
        for d in r.docs:
            parts.setdefault(d.doc_id, []).append((d.doc_from, x[d.start:d.start + d.length]))
    encoding = S._encoding(S.read_ranks(RANKS), P.PATTERN)
    for r in df.select("doc_id", "text").collect():
        got = np.concatenate([p for _, p in sorted(parts.pop(r.doc_id), key=lambda p: p[0])]).tolist()
        assert got == encoding.encode_ordinary(r.text or "") + [END]
    assert not parts


def test_a_repeated_task_writes_the_same_bytes(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ranks = S.read_ranks(RANKS)
    packing = S._packing(df, S._encoding(ranks, P.PATTERN), END)
    from emporia.llm.common import staged
    seq = staged(S.pack_sequences(df, ranks, P.PATTERN, END, packing, 256), "seq")
    table = S.write_shards(seq, packing, str(tmp_path), b"k", 256, 64)
    first, one = sorted(table.collect()), {p.name: p.read_bytes() for p in tmp_path.iterdir()}
    second, two = sorted(table.collect()), {p.name: p.read_bytes() for p in tmp_path.iterdir()}
    assert first == second and one == two and all(n.startswith("shard-") for n in one)


def test_defined_cases(odd_docs, no_docs):
    root, rows = _materialise(odd_docs, length=64, shard_rows=1000)
    docs = [d for r in rows for d in r.docs]
    assert sum(d.length == 1 and d.doc_from == 0 for d in docs) >= 3  # null and empty texts: the end id alone
    assert sum(d.doc_id is None for d in docs) >= 2 and len(rows) > 700
    _, none = _materialise(no_docs)
    assert none == []

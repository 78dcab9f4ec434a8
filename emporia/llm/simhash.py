"""SimHash near-duplicates: 64-bit fingerprints searched with BK-trees.

Fingerprints that differ in at most ``radius`` bits link, and links join into
components. Two such fingerprints agree on at least one of ``radius + 1``
blocks of their bits, so every fingerprint goes to one shard for each block.
Each shard grows a BK-tree (children keyed by their Hamming distance to the
parent) and asks it for all its members, following only edges within the radius
of the query's own distance. A shard with more than ``SHARD`` fingerprints is
cut again by blocks of the bits that its members need not share, which keeps
every pair; with few free bits left it can't be larger than that.

Defined cases: a null or blank text has fingerprint 0 and links like any other;
fewer words than a shingle are one shingle; repeated rows and equal texts share
a fingerprint and so a component; a row without id belongs to its component but
never names it (component null only if no member has an id).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField
from xxhash import xxh64_intdigest

from emporia.llm.common import staged, with_columns
from emporia.llm.graph import connected_components

#: Most fingerprints that one tree holds.
SHARD = 4096
_SLICE = 1 << 16


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of a UTF-8 text, A-Z lower-cased, repeats included."""
    w = text.lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    shingles = map(b" ".join, zip(*[w[k:] for k in range(words)], strict=False)) if len(w) >= words \
        else iter([b" ".join(w)])
    ones = np.zeros(64, np.int64)
    for _ in range(0, n, _SLICE):
        h = np.fromiter((xxh64_intdigest(s, seed) for s, _ in zip(shingles, range(_SLICE), strict=False)), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, words: int = 3, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every whole text, as a signed 64-bit number."""
    def make():
        def apply(texts):
            raw = pc.fill_null(texts, "").cast(pa.large_binary()).to_pylist()
            return [pa.array(np.array([fingerprint(t, words) for t in raw], np.uint64).view(np.int64))]
        return apply

    return with_columns(docs, [StructField(name, LongType())], make, text)


class BKTree:
    """Burkhard-Keller tree over distinct fingerprints; node k stands for ``prints[k]``."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        #: node -> (distances, child nodes), distances ascending
        self.edges: dict[int, tuple[list[int], list[int]]] = {}
        stack = [np.arange(len(prints))] if len(prints) else []
        while stack:
            members = stack.pop()
            root, rest = members[0], members[1:]
            if not len(rest):
                continue
            d = np.bitwise_count(prints[rest] ^ prints[root])
            order = np.argsort(d, kind="stable")
            rest, d = rest[order], d[order]
            cut = np.flatnonzero(d[1:] != d[:-1]) + 1
            parts = np.split(rest, cut)
            self.edges[int(root)] = ([int(d[0]), *d[cut].tolist()], [int(p[0]) for p in parts])
            stack += parts

    def search(self, queries: np.ndarray, radius: int):
        """Yield (node, indices of the queries within the radius of it), all queries at once."""
        stack = [(0, np.arange(len(queries)))] if len(self.prints) else []
        while stack:
            node, asked = stack.pop()
            d = np.bitwise_count(queries[asked] ^ self.prints[node]).astype(np.int16)
            near = asked[d <= radius]
            if len(near):
                yield node, near
            for e, child in zip(*self.edges.get(node, ((), ())), strict=True):
                follow = asked[np.abs(d - e) <= radius]
                if len(follow):
                    stack.append((child, follow))


def shard_roots(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each of a shard's fingerprints the first one that it reaches by links within the shard."""
    label = np.arange(len(prints))
    for _, near in BKTree(prints).search(prints, radius):
        if len(near) > 1:
            seen = np.unique(label[near])
            if len(seen) > 1:
                label[np.isin(label, seen)] = seen[0]
    return label


def _shard_links(radius: int):
    def links(group: np.ndarray):
        root = shard_roots(group, radius)
        moved = np.flatnonzero(root != np.arange(len(group)))
        return group[moved], group[root[moved]]

    def run(batches):
        # rows come sorted by shard; the last shard of a batch may go on in the next
        held_key, held = None, np.zeros(0, np.int64)
        for batch in batches:
            key = np.stack([batch.column("used").to_numpy(), batch.column("value").to_numpy()], 1)
            fp = batch.column("fp").to_numpy()
            if not len(fp):
                continue
            cut = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            bounds = np.r_[0, cut, len(fp)]
            a, b = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if held_key is not None and (key[lo] == held_key).all():
                    held = np.r_[held, fp[lo:hi]]
                else:
                    if len(held) > 1:
                        x, y = links(held.view(np.uint64))
                        a.append(x)
                        b.append(y)
                    held_key, held = key[lo], fp[lo:hi]
            if a:
                yield _pairs(a, b)
        if len(held) > 1:
            x, y = links(held.view(np.uint64))
            yield _pairs([x], [y])

    return run


def _pairs(a, b):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a).view(np.int64)),
                                       pa.array(np.concatenate(b).view(np.int64))], ["a", "b"])


def _blocks(bits: list[int], parts: int) -> list[int]:
    """Masks of ``parts`` nearly equal blocks of the given bits, as signed 64-bit numbers."""
    masks = [sum(1 << int(k) for k in block) for block in np.array_split(bits, parts)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _cut(rows: DataFrame, radius: int) -> DataFrame:
    """Send each row of a shard to one smaller shard for each block of its free bits."""
    children = F.udf(lambda used: [used | m for m in _blocks([k for k in range(64) if not used >> k & 1],
                                                             radius + 1)], "array<bigint>")
    kinds = rows.select("used").distinct().select("used", children("used").alias("next"))
    return (rows.select("fp", "used").join(kinds, "used").select("fp", F.explode("next").alias("used"))
            .withColumn("value", F.expr("fp & used")).distinct())


def fingerprint_links(prints: DataFrame, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """Links ``(a, b)`` that join all distinct fingerprints ``fp`` within the radius.

    Not every pair: within a shard one link for each member towards the first
    one that it reaches, which gives the same components.
    """
    first = F.explode(F.array(*[F.lit(m).cast("bigint") for m in _blocks(list(range(64)), radius + 1)]))
    rows = prints.select("fp", first.alias("used")).withColumn("value", F.expr("fp & used"))
    ready = None
    while True:
        # a shard whose members can differ in so few bits is never larger than `shard`
        can_be_large = F.lit(64) - F.bit_count("used") > int(np.log2(shard))
        hot = staged(rows.groupBy("used", "value").count().where((F.col("count") > shard) & can_be_large)
                     .select("used", "value"), "hot_shards")
        if hot.isEmpty():
            break
        cold = rows.join(hot, ["used", "value"], "left_anti")
        ready = cold if ready is None else ready.unionByName(cold)
        rows = staged(_cut(rows.join(hot, ["used", "value"], "left_semi"), radius), "cut_shards")
    rows = rows if ready is None else ready.unionByName(rows)
    return (rows.select("used", "value", "fp").repartition("used", "value")
            .sortWithinPartitions("used", "value", "fp")
            .mapInArrow(_shard_links(radius), "a bigint, b bigint"))


def simhash_components(docs: DataFrame, radius: int = 3, words: int = 3, doc_id: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, root, component_id)`` for every row of ``docs``.

    ``root`` is the smallest fingerprint of the component, ``component_id`` the
    smallest id of all its documents.
    """
    one = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = staged(with_fingerprint(one, words).drop("text"), "fingerprints")
    return components_of(marked, radius)


def components_of(marked: DataFrame, radius: int = 3) -> DataFrame:
    """Add ``root`` and ``component_id`` to a table with ``doc_id`` and ``fingerprint``."""
    prints = staged(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")), "prints")
    roots = staged(connected_components(fingerprint_links(prints, radius)), "roots")
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = staged(named.join(least, "root").select(F.col("fp").alias("fingerprint"), "root", "component_id"),
                   "components")
    return marked.join(named, "fingerprint")


def keep_one(docs: DataFrame, radius: int = 3, words: int = 3, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id, of repeated rows any one."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = staged(with_fingerprint(docs.withColumn("__row", F.monotonically_increasing_id()), words, text,
                                   "__fingerprint"), "marked")
    found = staged(components_of(rows.select(F.col(doc_id).alias("doc_id"), F.col("__fingerprint").alias("fingerprint"),
                                             "__row"), radius), "found")
    # a row without id is last
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first")
    kept = found.groupBy("root").agg(first).select(F.col("first.__row").alias("__row"))
    # the rows that go are fewer than those that stay: where Spark finds them small enough to broadcast, no text moves
    gone = staged(found.select("__row").join(kept, "__row", "left_anti"), "gone")
    return rows.join(gone, "__row", "left_anti").select(*columns)

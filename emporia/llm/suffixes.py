"""Exact substring deduplication with suffix arrays built by the difference-cover algorithm.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller id.

Suffixes are sorted in shards. A string of ``length`` bytes holds several ``GRAM``-byte grams; the one with the
smallest hash (the first of equal ones) is its anchor, which depends on nothing but the string. All equal strings
therefore have equal anchors, and strings are dealt to shards by the hash of their anchor: a shard's suffix array
holds every suffix that could share ``length`` bytes with another one of the shard, and none of them lies in two shards.
Inside a shard (``positions``) the suffixes at positions 1 and 2 modulo 3 are sorted by their triples, the algorithm
recurses on the names of the triples (not deeper than ``length`` bytes need), the other suffixes are merged by (symbol,
rank) pairs, and adjacent suffixes are compared over ``length`` bytes.

The way there: (1) texts are packed, about 2 MB a pack, compressed, and written once; (2) every pack sends the hashes of
its anchors to buckets, which send back those met in two different texts - a string whose anchor is in one text only
has no equal elsewhere; (3) packs send the stretches of strings with one anchor ("runs") to the shards; (4) shards send
back which starts are repeated; (5) packs are cut. Copies of a whole text are found by digest and leave (2) alone. What
moves is blobs of numpy arrays keyed by pack, bucket or shard; nothing passes through the driver but the total of bytes.

Skew: a pack sends a hash at most twice, a shard sorts equal runs once whoever holds them, and cuts what it got into
parts of ``PART_BYTES`` by further bits of the anchor's hash. Equal anchors are told by 64-bit hashes in (2) and (3):
unequal ones that collide are only compared for nothing. Different texts of one 64-bit tag (from SHA-256) would count as
one in (2).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import staged, strings, text_steps
from emporia.session import scratch_path

#: Text that one bucket of anchor hashes and one shard of runs answer for.
BUCKET_BYTES, SHARD_BYTES = 16 << 20, 4 << 20
#: Symbols that one suffix array is built over.
PART_BYTES = 1 << 20
_LAST = np.iinfo(np.int64).max
_MIX = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- suffix arrays

def _ranked(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 0 of tuples of non-negative numbers, equal ones sharing a rank."""
    packed = keys[0]
    for key in keys[1:]:
        width = int(key.max(initial=0)) + 1
        if int(packed.max(initial=0)) >= (1 << 62) // width:
            packed = _ranked(packed)
        packed = packed * width + key
    if int(packed.max(initial=0)) < 4 * len(packed) + 1024:         # few values: count instead of sorting
        there = np.bincount(packed) > 0
        return (np.cumsum(there) - 1)[packed]
    order = np.argsort(packed)
    found = packed[order]
    rank = np.empty(len(packed), np.int64)
    rank[order] = np.cumsum(np.concatenate([[False], found[1:] != found[:-1]]))
    return rank


def _less(ranks: np.ndarray, among: np.ndarray) -> np.ndarray:
    """How many of ``among`` are smaller than each rank (ranks are not much larger than their number)."""
    size = int(max(ranks.max(initial=0), among.max(initial=0))) + 1
    return (np.cumsum(np.bincount(among, minlength=size)) - np.bincount(among, minlength=size))[ranks]


def positions(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Place of each suffix in an order that is right over at least the first ``depth`` symbols (all >= 1).

    Suffixes that agree on so many symbols have neighbouring places, some of them maybe the same.
    """
    n = len(symbols)
    if n < 3 or depth <= 1:
        return _ranked(*[np.append(symbols[i:], np.zeros(i, np.int64)) for i in range(n if 0 < n < 3 else 1)])
    t = np.concatenate([symbols, np.zeros(3, np.int64)])
    end = n + (n % 3 == 1)                       # a triple of end marks parts the two halves of the recursion
    one, two, rest = np.arange(1, end, 3), np.arange(2, end, 3), np.arange(0, n, 3)
    sample = np.concatenate([one, two])
    if t.max() > 4 * n:                         # symbols as ranks, so that few of them make few triples
        t[:n] = _ranked(symbols) + 1
    names = _ranked(t[sample], t[sample + 1], t[sample + 2]) + 1
    if depth > 3 and names.max() < len(names):
        names = positions(names, -(-depth // 3)) + 1
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    one, two = one[one < n], two[two < n]
    place = np.zeros(n, np.int64)
    sampled = np.concatenate([one, two])
    place[sampled] = _less(rank[sampled], rank[sampled])
    # against positions 1 mod 3 one symbol is compared before ranks are known, against 2 mod 3 two are
    by_one = _ranked(t[np.concatenate([rest, one])], rank[np.concatenate([rest, one]) + 1])
    both = np.concatenate([rest, two])
    by_two = _ranked(t[both], t[both + 1], rank[both + 2])
    r = len(rest)
    place[rest] = _less(by_one[:r], by_one[:r]) + _less(by_one[:r], by_one[r:]) + _less(by_two[:r], by_two[r:])
    place[one] += _less(by_one[r:], by_one[:r])
    place[two] += _less(by_two[r:], by_two[:r])
    return place


def _ragged(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (count[0] of them), first[1], ..."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + count, count)


def _adjacent_equal(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """For each but the last of ``at``: do the ``length`` bytes there equal those at the next one?"""
    if length < 8:
        return (text[at[:-1, None] + np.arange(length)] == text[at[1:, None] + np.arange(length)]).all(1)
    words = np.ndarray((len(text) - 7,), np.uint64, np.ascontiguousarray(text).data, strides=(1,))
    same = np.ones(max(0, len(at) - 1), bool)
    for shift in [*range(0, length - 8, 8), length - 8]:
        found = words[at + shift]
        same &= found[:-1] == found[1:]
    return same


def least_owner(runs: list[bytes], owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest owner of each string of ``length`` bytes in any of the (different) runs, and where each run begins.

    Run i has ``len(runs[i]) - length + 1`` strings; the results stand at the run's beginning and after it.
    """
    sizes = np.array([len(r) for r in runs], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    text = np.frombuffer(b"\0".join(runs) + b"\0", np.uint8)
    symbols = text.astype(np.int64) + 1
    symbols[begin + sizes] = 0
    symbols = _ranked(symbols) + 1
    place = positions(symbols, length)
    starts = _ragged(begin, sizes - length + 1)
    order = np.argsort(place[starts])
    starts = starts[order]
    group = np.flatnonzero(np.concatenate([[True], ~_adjacent_equal(text, starts, length)]))
    owners = np.repeat(owner, sizes - length + 1)[order]
    least = np.full(len(text), _LAST)
    least[starts] = np.repeat(np.minimum.reduceat(owners, group), np.diff(np.append(group, len(starts))))
    return least, begin


# ---------------------------------------------------------------- anchors

def _sliding(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:span - width], x[width - span:]) if span < width else x


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of every ``gram`` bytes: a polynomial by doubling, then mixed."""
    powers, total, span, done = data.astype(np.uint64) + np.uint64(1), None, 1, 0
    while span <= gram:
        if gram & span:
            total = powers if total is None else powers[:len(data) - done - span + 1] * _power(done) + total[span:]
            total = total[:max(0, len(data) - done - span + 1)]
            done += span
        if span * 2 <= gram:
            powers = powers[:-span] * _power(span) + powers[span:]
        span *= 2
    h = total ^ (total >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_MIX), n, 1 << 64))


def gram_of(length: int) -> int:
    """Bytes of a gram: long enough to be rare, short enough that anchors are far apart."""
    return max(1, length * 2 // 5)


def anchored_runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(first start, number of starts, document, hash)`` of each stretch of strings with one anchor.

    ``bounds`` are where the documents begin in ``data``, and its end; strings don't cross them.
    """
    n, gram = len(data), gram_of(length)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.astype(np.uint64)
    h = _gram_hashes(data, gram)
    low = np.uint64(31)                          # the low bits hold the position, so that the first of equals wins
    keyed = (h >> low << low) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding(keyed, length - gram + 1) & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    sizes = np.diff(bounds)
    starts = _ragged(bounds[:-1], np.maximum(0, sizes - length + 1))
    if not len(starts):
        return none, none, none, none.astype(np.uint64)
    anchor = anchor[starts]
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(starts) != 1)]))
    first = starts[cut]
    return (first, np.diff(np.append(cut, len(starts))), np.searchsorted(bounds, first, "right") - 1, h[anchor[cut]])


# ---------------------------------------------------------------- packs

_PACK = "pack long, ids array<long>, digests array<binary>, sizes array<int>, body binary"


def pack_texts(docs: DataFrame) -> DataFrame:
    """The texts as written rows of at most 512 documents and about 2 MB: ids, SHA-256, byte counts, body (zstd)."""
    def run(batches):
        seq = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for part in text_steps(whole, "text"):
                texts = [t.encode() for t in strings(part.column("text"))]
                yield pa.RecordBatch.from_arrays([
                    pa.array([seq]), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([[hashlib.sha256(t).digest() for t in texts]], pa.list_(pa.binary())),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                    pa.array([squeeze.compress(b"".join(texts))], pa.binary())],
                    ["pack", "ids", "digests", "sizes", "body"])
                seq += 1

    spark = docs.sparkSession
    packs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PACK)
    path = scratch_path(spark, "suffix-packs")
    packs.write.option("parquet.block.size", 8 << 20).option("compression", "uncompressed").parquet(path)
    return spark.read.schema(packs.schema).parquet(path)


class _Pack:
    """One row of the packs table in a task."""

    def __init__(self, row: dict):
        self.pack, sizes = row["pack"], np.array(row["sizes"], np.int64)
        self.ids = row["ids"]
        self.order = np.array([_LAST if i is None else i for i in row["ids"]], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.body = zstandard.ZstdDecompressor().decompress(row["body"], max_output_size=int(self.bounds[-1]) + 1)
        self.data = np.frombuffer(self.body, np.uint8)
        self.tags = np.frombuffer(b"".join(d[:8] for d in row["digests"]), np.uint64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _array(dtype, blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype)


def _parts(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each different key with the indexes that have it."""
    order = np.argsort(key, kind="stable")
    if len(order):
        cut = np.flatnonzero(np.diff(key[order])) + 1
        for part in np.split(order, cut):
            yield int(key[part[0]]), part


def _bucket_key(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and the hash's low half, in one number."""
    return ((h >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def shared_anchors(packs: DataFrame, length: int, buckets: int) -> DataFrame:
    """``(pack, shared)``: keys of the pack's anchors that stand in two different texts of the corpus."""
    def send(batches):
        for row in _rows(batches):
            p = _Pack(row)
            _, _, doc, h = anchored_runs(p.data, p.bounds, length)
            key, tag = _bucket_key(h, buckets), p.tags[doc]
            order = np.lexsort((tag, key))
            key, tag = key[order], tag[order]
            # two different texts tell all: of each key the least and the greatest tag
            other = key[1:] != key[:-1]
            keep = np.concatenate([[True], other]) | np.append(other, True) if len(key) else other
            key, tag = key[keep], tag[keep]
            again = (key[1:] == key[:-1]) & (tag[1:] == tag[:-1])
            key, tag = key[np.append(~again, True)[:len(key)]], tag[np.append(~again, True)[:len(tag)]]
            out = [(b, p.pack, key[i].astype(np.uint32).tobytes(), *_indexed(tag[i]))
                   for b, i in _parts((key >> np.uint64(32)).astype(np.int64))]
            yield pa.RecordBatch.from_pylist([dict(zip(("bucket", "pack", "hashes", "which", "tags"), o, strict=True))
                                              for o in out], schema=sent)

    def meet(table: pa.Table) -> pa.Table:
        blobs = [b.as_py() for b in table.column("hashes")]
        counts = np.array([len(b) // 4 for b in blobs])
        hashes = _array(np.uint32, blobs)
        tags = np.concatenate([_array(np.uint64, [t.as_py()])[_array(np.uint16, [w.as_py()])]
                               for w, t in zip(table.column("which"), table.column("tags"), strict=True)])
        order = np.lexsort((tags, hashes))
        differ = (hashes[order][1:] == hashes[order][:-1]) & (tags[order][1:] != tags[order][:-1])
        hot = np.isin(hashes, np.unique(hashes[order][1:][differ]))
        ends = np.cumsum(counts)
        bucket = np.uint64(table.column("bucket")[0].as_py()) << np.uint64(32)
        found = [np.unique(hashes[e - c:e][hot[e - c:e]]) for e, c in zip(ends, counts, strict=True)]
        keep = [i for i, f in enumerate(found) if len(f)]
        return pa.table({"pack": table.column("pack").take(pa.array(keep, pa.int64())),
                         "shared": pa.array([(found[i].astype(np.uint64) | bucket).tobytes() for i in keep], pa.binary())})

    sent = pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), ("hashes", pa.binary()), ("which", pa.binary()),
                      ("tags", pa.binary())])
    hashes = packs.select("pack", "ids", "digests", "sizes", "body").mapInArrow(
        send, "bucket int, pack long, hashes binary, which binary, tags binary")
    found = hashes.groupBy("bucket").applyInArrow(meet, "pack long, shared binary")
    return found.groupBy("pack").agg(F.collect_list("shared").alias("shared"))


def _indexed(values: np.ndarray) -> tuple[bytes, bytes]:
    """Values of few kinds as two-byte indexes and the kinds."""
    kinds, which = np.unique(values, return_inverse=True)
    return which.astype(np.uint16).tobytes(), kinds.tobytes()


_RUNS = "shard int, pack long, doc binary, at binary, n binary, bits binary, owner binary, texts binary"


def send_runs(packs: DataFrame, shared: DataFrame, length: int, shards: int, buckets: int) -> DataFrame:
    """Runs of strings with a shared anchor, in one row for each pack and shard."""
    def send(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for row in _rows(batches):
            p = _Pack(row)
            first, n, doc, h = anchored_runs(p.data, p.bounds, length)
            hot = np.isin(_bucket_key(h, buckets), _array(np.uint64, row["shared"]))
            first, n, doc, h = first[hot], n[hot], doc[hot], h[hot]
            out = []
            for shard, i in _parts(((h >> np.uint64(8)) % np.uint64(shards)).astype(np.int64)):
                texts = p.data[_ragged(first[i], n[i] + length - 1)].tobytes()
                out.append({"shard": shard, "pack": p.pack, "doc": doc[i].astype(np.uint16).tobytes(),
                            "at": (first[i] - p.bounds[doc[i]]).astype(np.uint32).tobytes(),
                            "n": n[i].astype(np.uint16).tobytes(), "bits": (h[i] >> np.uint64(48)).astype(np.uint16).tobytes(),
                            "owner": p.order[doc[i]].tobytes(), "texts": squeeze.compress(texts)})
            yield pa.RecordBatch.from_pylist(out, schema=sent)

    sent = pa.schema([("shard", pa.int32()), ("pack", pa.int64())] + [(c, pa.binary()) for c in (
        "doc", "at", "n", "bits", "owner", "texts")])
    return packs.join(shared, "pack").mapInArrow(send, _RUNS)


def repeated_starts(table: pa.Table, length: int) -> pa.Table:
    """A shard's runs -> for each pack the starts (document, first, end) whose string an earlier document holds."""
    col = {c: [x.as_py() for x in table.column(c)] for c in ("doc", "at", "n", "bits", "owner", "texts")}
    n, bits = _array(np.uint16, col["n"]).astype(np.int64), _array(np.uint16, col["bits"])
    doc, at, owner = _array(np.uint16, col["doc"]), _array(np.uint32, col["at"]), _array(np.int64, col["owner"])
    row = np.repeat(np.arange(table.num_rows), [len(b) // 2 for b in col["doc"]])
    per_row = np.bincount(row, n + length - 1, table.num_rows).astype(np.int64)
    body = b"".join(zstandard.ZstdDecompressor().decompress(t, max_output_size=int(size) + 1)
                    for t, size in zip(col.pop("texts"), per_row, strict=True))
    begin = np.cumsum(n + length - 1) - n - length + 1
    found = []
    for _, runs in _parts(bits.astype(np.int64) % (len(body) // PART_BYTES + 1)):
        known: dict[bytes, int] = {}
        kind = np.array([known.setdefault(body[begin[r]:begin[r] + n[r] + length - 1], len(known)) for r in runs])
        least_of = np.full(len(known), _LAST)
        np.minimum.at(least_of, kind, owner[runs])
        least, where = least_owner(list(known), least_of, length)
        gone = least[_ragged(where[kind], n[runs])] < np.repeat(owner[runs], n[runs])
        ends = np.cumsum(n[runs])
        edge = np.zeros(len(gone) + 1, bool)
        edge[ends - n[runs]] = True                 # stretches end with their run
        opens = np.flatnonzero(gone & (edge[:-1] | ~np.concatenate([[False], gone[:-1]])))
        closes = np.flatnonzero(gone & (np.append(edge[1:-1], True) | ~np.concatenate([gone[1:], [False]]))) + 1
        of = np.searchsorted(ends, opens, "right")
        shift = at[runs][of].astype(np.int64) - (ends - n[runs])[of]
        found.append(np.stack([row[runs][of], doc[runs][of].astype(np.int64), opens + shift, closes + shift]))
    found = np.concatenate(found, axis=1)
    packs = table.column("pack").to_numpy()[found[0]]
    out = [(p, found[1:, i].T.astype(np.uint32).tobytes()) for p, i in _parts(packs)]
    return pa.table({"pack": pa.array([o[0] for o in out], pa.int64()),
                     "starts": pa.array([o[1] for o in out], pa.binary())})


def copied_texts(packs: DataFrame, length: int) -> DataFrame:
    """``(pack, copies)``: places in the pack of documents whose whole text a smaller id has (``length`` bytes or more).

    The join is on (digest, smallest id), so that a text of a third of all rows is no hot key.
    """
    last = F.lit(int(_LAST))
    rows = packs.select("pack", F.posexplode(F.arrays_zip("ids", "digests", "sizes")).alias("doc", "d")).select(
        "pack", "doc", F.coalesce("d.ids", last).alias("id"), F.col("d.digests").alias("digest"), "d.sizes")
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    return (rows.where(F.col("sizes") >= length).join(firsts, ["digest", "id"], "left").where("first IS NULL")
            .groupBy("pack").agg(F.collect_list("doc").alias("copies")))


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """One row for each row of ``docs(doc_id, text)``: ``doc_id, kept, n_bytes, n_removed, n_spans``.

    Texts are UTF-8 bytes. Each byte covered by ``length`` bytes (at least 2) that also start in a document with a
    smaller id is removed; overlaps count, strings are judged on the input, and don't cross documents. ``kept`` is what
    is left, as binary (a character may be cut in two); ``n_spans`` counts maximal removed stretches.

    Defined cases: a null text is empty; a null id comes after all others (nothing is removed for its sake); rows with
    one id are the same document to each other, nothing of them is removed for the other's sake; columns other than
    the two aren't read. An empty table gives no rows.
    """
    if length < 2:
        raise ValueError("length must be at least 2")
    packs = pack_texts(docs)
    total = packs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, s: a + s))).first()[0] or 0
    buckets, shards = total // BUCKET_BYTES + 1, total // SHARD_BYTES + 1
    runs = send_runs(packs, staged(shared_anchors(packs, length, buckets), "suffix-anchors"), length, shards, buckets)
    starts = staged(runs.groupBy("shard").applyInArrow(lambda t: repeated_starts(t, length), "pack long, starts binary")
                    .groupBy("pack").agg(F.collect_list("starts").alias("starts")), "suffix-starts")
    schema = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long"

    def cut(batches):
        for row in _rows(batches):
            p = _Pack(row)
            doc, first, end = _array(np.uint32, row["starts"] or []).astype(np.int64).reshape(-1, 3).T
            sizes, copies = np.diff(p.bounds), np.array(row["copies"] or [], np.int64)
            change = np.zeros(len(p.data) + 1, np.int64)
            np.add.at(change, p.bounds[doc] + first, 1)
            np.add.at(change, p.bounds[doc] + end + length - 1, -1)
            np.add.at(change, p.bounds[copies], 1)
            np.add.at(change, p.bounds[copies + 1], -1)
            gone = np.cumsum(change[:-1]) > 0
            opens = gone & ~np.concatenate([[False], gone[:-1]])
            begins = p.bounds[:-1][sizes > 0]
            opens[begins] = gone[begins]
            counts = [np.concatenate([[0], np.cumsum(x)])[p.bounds] for x in (gone, opens)]
            removed, spans = (np.diff(c) for c in counts)
            left = p.data[~gone].tobytes()
            ends = np.cumsum(sizes - removed)
            kept = [left[e - s:e] for e, s in zip(ends, sizes - removed, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.ids, pa.int64()), pa.array(kept, pa.binary()), pa.array(sizes), pa.array(removed.astype(np.int64)),
                 pa.array(spans.astype(np.int64))], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return packs.join(starts, "pack", "left").join(copied_texts(packs, length), "pack", "left").mapInArrow(cut, schema)

"""Token ids in training order: fixed-stride binary shards of packed sequences.

1. Every document is tokenised and its ids, closed by an end id, are packed one
   after another into sequences of ``length`` ids; the sequences of each input
   task are numbered and written as a table.
2. From the number of sequences of each task every sequence gets a global index
   0 .. n - 1, and a keyed Feistel permutation of that range (cycle-walking down
   from the next power of four) gives its global slot.
3. Shard k holds the slots k * rows .. (k + 1) * rows - 1. The sequences are
   partitioned by shard, sorted by slot and written as little-endian 16-bit ids,
   so a slot's place in its file is a product. Reading may stop and go on at any
   slot (:func:`read_slots`).

A shard is written under a temporary name and moved into place when complete; a
task that runs again writes the same bytes. Paths are pyarrow file systems
(local or shared mounts, hdfs, s3).

Defined cases: a null or empty text is the end id alone; a longer text runs on
in the following sequences; the last sequence of a task is filled up with end ids
(``n_tokens`` counts the others); repeated rows are packed as often as they
occur, null ids are kept; an empty table gives no shard.
"""

from __future__ import annotations

import base64
import hashlib
import os

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import staged, strings, text_steps
from emporia.session import scratch_path

LENGTH = 2048
#: Sequences in a shard: 64 MB of ids.
SHARD_ROWS = 16_384
#: Documents whose ids tell which ids are frequent (only the size of the work files depends on it).
SAMPLE = 500
_STAGED = ("part int, place bigint, n_tokens int, ids binary, "
           "docs array<struct<doc_id:bigint,doc_from:int,start:int,length:int>>")
_RESULT = ("slot bigint, shard int, byte_offset bigint, n_tokens int, sha256 string, "
           "docs array<struct<doc_id:bigint,doc_from:int,start:int,length:int>>")


class Feistel:
    """Keyed permutation of 0 .. n - 1 on arrays."""

    rounds = 6

    def __init__(self, n: int, key: bytes):
        self.n = n
        self.half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
        self.keys = [np.uint64(int.from_bytes(hashlib.blake2b(bytes([r]), key=key, digest_size=8).digest(), "little"))
                     for r in range(self.rounds)]

    def _once(self, x: np.ndarray) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        a, b = x >> half, x & mask
        for key in self.keys:
            h = (b + key) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            a, b = b, a ^ ((h ^ (h >> np.uint64(32))) & mask)
        return a << half | b

    def slots(self, index: np.ndarray) -> np.ndarray:
        x = self._once(index.astype(np.uint64))
        while (out := np.flatnonzero(x >= self.n)).size:  # walk on until inside the range
            x[out] = self._once(x[out])
        return x.astype(np.int64)


def read_ranks(path: str) -> bytes:
    """The text of a tiktoken vocabulary file on the driver."""
    with open(path, "rb") as f:
        return f.read()


def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=known, special_tokens={})


class _Packing:
    """Turns ids into work bytes and back: frequent ids first, low bytes before high bytes, zstandard."""

    def __init__(self, order: np.ndarray):
        self.order = order
        self.place = np.empty(1 << 16, np.uint16)
        self.place[order] = np.arange(1 << 16, dtype=np.uint16)

    def pack(self, ids: np.ndarray) -> bytes:
        planes = np.ascontiguousarray(self.place[ids].view(np.uint8).reshape(-1, 2).T)
        return zstandard.ZstdCompressor(3).compress(planes.tobytes())

    def unpack(self, raw: bytes) -> np.ndarray:
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(2, -1)
        return self.order[np.ascontiguousarray(planes.T).view(np.uint16)[:, 0]]


def _packing(docs: DataFrame, encoding, end: int, doc_id: str = "doc_id", text: str = "text") -> _Packing:
    # a few more rows than wanted by a hash, so that what each task sends doesn't add up
    share = min(1.0, 4 * SAMPLE / max(1, docs.count()))
    head = docs.select(F.xxhash64(doc_id, text).alias("h"), F.substring(text, 1, 2000).alias("t")).where("t is not null")
    sample = head.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).orderBy("h").limit(SAMPLE).collect()
    counts = np.zeros(1 << 16, np.int64)
    counts[end] = 1
    for r in sample:
        np.add.at(counts, encoding.encode_ordinary(r.t), 1)
    return _Packing(np.argsort(-counts, kind="stable").astype(np.uint16))


def pack_sequences(docs: DataFrame, ranks: bytes, pattern: str, end: int, packing: _Packing,
                   length: int = LENGTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each sequence of ``length`` ids (packed), numbered within its task."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, packing))
    spans = pa.list_(pa.struct([("doc_id", pa.int64()), ("doc_from", pa.int32()), ("start", pa.int32()),
                                ("length", pa.int32())]))

    def run(batches):
        ranks, packing = shared.value
        encoding = _encoding(ranks, pattern)
        part, place = TaskContext.get().partitionId(), 0
        held, fill, docs_held = np.full(length, end, np.uint16), 0, []
        rows = []

        def emit():
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()),
                 pa.array([r[3] for r in rows], spans)], ["part", "place", "n_tokens", "ids", "docs"])

        for whole in batches:
            for step in text_steps(whole, "text"):
                for key, t in zip(step.column("doc_id").to_pylist(), strings(step.column("text")), strict=True):
                    ids = np.array([*encoding.encode_ordinary(t), end], np.uint16)
                    at = 0
                    while at < len(ids):
                        n = min(len(ids) - at, length - fill)
                        held[fill:fill + n] = ids[at:at + n]
                        docs_held.append({"doc_id": key, "doc_from": at, "start": fill, "length": n})
                        at, fill = at + n, fill + n
                        if fill == length:
                            rows.append((place, length, packing.pack(held), docs_held))
                            place, fill, docs_held = place + 1, 0, []
                            if len(rows) == 256:
                                yield emit()
                                rows.clear()
        if fill:
            held[fill:] = end
            rows.append((place, fill, packing.pack(held), docs_held))
        if rows:
            yield emit()

    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _STAGED)


def write_shards(sequences: DataFrame, packing: _Packing, root: str, key: bytes, length: int = LENGTH,
                 shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Write the shard files under ``root``; one row for each sequence, with its slot and place."""
    counts = {r.part: r.n for r in sequences.groupBy("part").agg((F.max("place") + 1).alias("n")).collect()}
    parts = sorted(counts)  # one number for each task of the packing job
    first = np.zeros(max(parts, default=-1) + 1, np.int64)
    first[parts] = np.cumsum([0, *[counts[p] for p in parts]])[:-1]
    total = sum(counts.values())
    permutation = Feistel(total, key)
    stride = 2 * length

    def slots(batches):
        for b in batches:
            slot = permutation.slots(first[b.column("part").to_numpy()] + b.column("place").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array((slot // shard_rows).astype(np.int32)), b.column("n_tokens"),
                 b.column("ids"), b.column("docs")], ["slot", "shard", "n_tokens", "ids", "docs"])

    fields = _RESULT.replace("byte_offset bigint, ", "").replace("sha256 string", "ids binary")
    dealt = (sequences.mapInArrow(slots, fields).repartitionById(max(1, -(-total // shard_rows)), "shard")
             .sortWithinPartitions("slot"))

    def write(batches):
        files, base = open_root(root)
        out, shard, due = None, None, 0
        name = ""
        for b in batches:
            here = b.column("shard").to_numpy()
            slot = b.column("slot").to_numpy()
            digests = []
            for k, raw in enumerate(b.column("ids").to_pylist()):
                if here[k] != shard:
                    if out is not None:
                        _close(files, out, name, base, shard)
                    shard, due = int(here[k]), int(here[k]) * shard_rows
                    name = f"{base}/_{shard:06d}-{TaskContext.get().taskAttemptId()}.tmp"
                    out = files.open_output_stream(name)
                if slot[k] != due:
                    raise ValueError(f"slot {due} of shard {shard} is missing")
                record = packing.unpack(raw).astype("<u2").tobytes()
                out.write(record)
                digests.append(hashlib.sha256(record).hexdigest())
                due += 1
            yield pa.RecordBatch.from_arrays(
                [b.column("slot"), b.column("shard"), pa.array((slot - here.astype(np.int64) * shard_rows) * stride),
                 b.column("n_tokens"), pa.array(digests, pa.string()), b.column("docs")],
                ["slot", "shard", "byte_offset", "n_tokens", "sha256", "docs"])
        if out is not None:
            _close(files, out, name, base, shard)

    return dealt.mapInArrow(write, _RESULT)


def open_root(root: str):
    """The file system of a folder and the folder's path in it; the folder is made."""
    if "://" not in root:
        root = "file://" + os.path.abspath(root.removeprefix("file:"))
    files, base = fs.FileSystem.from_uri(root)
    files.create_dir(base, recursive=True)
    return files, base


def _close(files, out, name: str, base: str, shard: int) -> None:
    out.close()
    files.move(name, f"{base}/shard-{shard:06d}.bin")


def read_slots(root: str, start: int, count: int, length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> np.ndarray:
    """Sequences ``start`` .. ``start + count - 1`` (fewer at the end) as rows of ids, read in order."""
    files, base = open_root(root)
    parts = []
    while count > 0:
        shard, place = divmod(start, shard_rows)
        path = f"{base}/shard-{shard:06d}.bin"
        if files.get_file_info(path).type != fs.FileType.File:
            break
        with files.open_input_file(path) as f:
            n = min(count, shard_rows - place, f.size() // (2 * length) - place)
            if n <= 0:
                break
            f.seek(place * 2 * length)
            parts.append(np.frombuffer(f.read(n * 2 * length), "<u2").reshape(n, length))
        start, count = start + n, count - n
    return np.concatenate(parts) if parts else np.zeros((0, length), np.uint16)


def materialise(docs: DataFrame, ranks_path: str, pattern: str, end: int, key: bytes, root: str | None = None,
                length: int = LENGTH, shard_rows: int = SHARD_ROWS) -> tuple[str, DataFrame]:
    """Tokenise, permute and write ``docs``; returns the shards' folder and the table of sequences."""
    root = root or scratch_path(docs.sparkSession, "shards")
    ranks = read_ranks(ranks_path)
    packing = _packing(docs, _encoding(ranks, pattern), end)
    sequences = staged(pack_sequences(docs, ranks, pattern, end, packing, length), "sequences")
    return root, staged(write_shards(sequences, packing, root, key, length, shard_rows), "slots")

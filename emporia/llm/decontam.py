"""Benchmark decontamination: BM25 over test items with block-max WAND.

The index holds the test items (cut to pieces of ``PIECE`` words), as postings
with BM25 impacts divided by the piece's own score, so that a passage with all
terms of a piece scores 1 against it. Every passage of a document (``2 * PIECE``
words, beginning every ``PIECE`` words, so any piece lies whole in one of them)
is a query. First the sums of block maxima over the passage's terms rule out
blocks of pieces that can't reach the threshold; in the blocks left, WAND walks
the postings from pivot to pivot. Each retrieved item is verified in the
document around the passage: 5-word shingles of its question, word triples of
its answer (fewer words: the whole sequence).

Words are runs of letters and digits, lower-cased, so marks around a word don't
hide a leak. Defined cases: null or wordless texts leak nothing; wordless items
are never found; an item without an id is found as a null; repeated items and rows are reported like any other; an item of
one sentence is a question without an answer. A benchmark with more than
``INDEX_PIECES`` pieces is searched index after index, each of that bound.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField

from emporia.llm.common import staged, strings, with_columns
from emporia.session import scratch_path

PIECE = 64
BLOCK = 4
#: Pieces in one broadcast index: at most 512 * 64 postings and 128 block maxima a term (below 20 MB).
INDEX_PIECES = 512
THRESHOLD = 0.6
QUESTION, ANSWER = 0.8, 0.6
K1, B = 1.2, 0.75
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence that has words is the answer, what stands before it the question."""
    parts = [w for s in _SENTENCE.split(text) if (w := words(s))]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


def grams(seq, n: int) -> set[tuple]:
    n = min(n, len(seq))
    return set(zip(*[seq[k:] for k in range(n)], strict=False)) if n else set()


class Index:
    """Inverted index over pieces ``(piece words, question, answer, item ids)``."""

    def __init__(self, pieces: list[tuple[list[str], list[str], list[str], object]], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.items = [p[3] for p in pieces]
        n = len(pieces)
        df = Counter(t for p in pieces for t in set(p[0]))
        self.vocab = {t: k for k, t in enumerate(sorted({t for p in pieces for part in p[:3] for t in part}))}
        mean = sum(len(p[0]) for p in pieces) / max(1, n)
        size = len(self.vocab)
        #: block -> term -> (pieces ascending, impacts); the last row of maxima is for unknown terms
        self.postings: list[dict[int, tuple[list[int], list[float]]]] = [{} for _ in range(-(-n // BLOCK))]
        self.maxima = np.zeros((size + 1, len(self.postings)), np.float32)
        for k, (piece, *_) in enumerate(pieces):
            tf = Counter(piece)
            impact = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (K1 + 1)
                      / (f + K1 * (1 - B + B * len(piece) / mean)) for t, f in tf.items()}
            own = sum(impact.values())
            for t, x in impact.items():
                term, block = self.vocab[t], k // BLOCK
                where, how = self.postings[block].setdefault(term, ([], []))
                where.append(k)
                how.append(x / own)
                self.maxima[term, block] = max(self.maxima[term, block], x / own * (1 + 1e-6))
        ids = [[[self.vocab[t] for t in part] for part in p[1:3]] for p in pieces]
        self.question = [grams(q, 5) for q, _ in ids]
        self.answer = [grams(a, 3) for _, a in ids]
        self.lengths = [(min(5, len(q)), min(3, len(a)), len(q) + len(a)) for q, a in ids]

    def encode(self, text: str) -> np.ndarray:
        w = words(text)
        unknown = len(self.vocab)
        get = self.vocab.get
        return np.fromiter((get(t, unknown) for t in w), np.int32, len(w))

    def live_blocks(self, terms: np.ndarray) -> np.ndarray:
        """Blocks whose maxima over the distinct terms can reach the threshold."""
        return np.flatnonzero(self.maxima[terms].sum(0) >= self.threshold)

    def retrieve(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """WAND over distinct terms: every piece that scores the threshold or more."""
        hits = []
        for block in self.live_blocks(terms):
            postings, bound = self.postings[block], self.maxima[:, block]
            # cursor: [piece, bound, place, pieces, impacts]
            live = [[p[0][0], float(bound[t]), 0, *p] for t in terms.tolist() if (p := postings.get(t))]
            while live:
                live.sort(key=lambda c: c[0])
                reach, pivot = 0.0, None
                for c in live:
                    reach += c[1]
                    if reach >= self.threshold:
                        pivot = c[0]
                        break
                if pivot is None:
                    break
                if live[0][0] == pivot:
                    score = sum(c[4][c[2]] for c in live if c[0] == pivot)
                    if score >= self.threshold - 1e-6:
                        hits.append((pivot, score))
                    target = pivot + 1
                else:
                    target = pivot
                for c in live:
                    if c[0] < target:
                        c[2] = bisect_left(c[3], target, c[2])
                        c[0] = c[3][c[2]] if c[2] < len(c[3]) else -1
                live = [c for c in live if c[0] >= 0]
        return hits

    def verified(self, piece: int, ids: np.ndarray, start: int) -> bool:
        """Do the question and the answer overlap the document around a passage?"""
        q, a, length = self.lengths[piece]
        around = ids[max(0, start - length):start + 2 * PIECE + length].tolist()
        found = self.question[piece]
        if not found or len(found & grams_of(around, q)) < QUESTION * len(found):
            return False
        answer = self.answer[piece]
        return not answer or len(answer & grams_of(around, a)) >= ANSWER * len(answer)

    def leaks(self, text: str) -> list:
        """Ids of the items that a whole text contains, ascending."""
        ids = self.encode(text)
        known = len(self.vocab)
        out: set = set()
        last = max(1, -(-len(ids) // PIECE) - 1)  # one passage reaches over two steps
        for k in range(last if len(ids) else 0):
            passage = ids[k * PIECE:(k + 2) * PIECE]
            terms = np.unique(passage)
            if terms[-1] == known:
                terms = terms[:-1]
            for piece, _ in self.retrieve(terms) if len(terms) else ():
                if not out.issuperset(self.items[piece]) and self.verified(piece, ids, k * PIECE):
                    out.update(self.items[piece])
        return sorted(out, key=lambda i: (i is None, i or 0))


def grams_of(seq: list[int], n: int) -> set[tuple]:
    return set(zip(*[seq[k:] for k in range(n)], strict=False)) if 0 < n <= len(seq) else set()


def _pieces(rows: Iterable) -> Iterable[tuple]:
    for r in rows:
        question, answer = question_and_answer(r.text)
        whole = question + answer
        # the last piece keeps its full length by beginning earlier
        starts = range(0, max(1, len(whole) - PIECE + 1), PIECE)
        starts = [*starts, len(whole) - PIECE] if len(whole) > PIECE and (len(whole) % PIECE) else starts
        for s in starts if whole else ():
            yield whole[s:s + PIECE], question, answer, r.items


def find_leaks(docs: DataFrame, benchmark: DataFrame, name: str = "items", text: str = "text",
               threshold: float = THRESHOLD, index_pieces: int = INDEX_PIECES) -> DataFrame:
    """``docs`` with the ids of the benchmark items that each whole text contains (empty: none).

    An item without an id stands in the result as a null. An index holds at most ``index_pieces`` pieces and is a
    broadcast of bounded size; a benchmark of one index is searched in place, a larger one index after index, each a job
    of its own that writes (digest of the text, ids) of what it found and lets its index go. Plan and memory are the
    same for any number of items.
    """
    spark = docs.sparkSession
    distinct = staged(benchmark.where("text is not null").groupBy("text")
                      .agg(F.transform(F.collect_set(F.struct("item_id")), lambda i: i["item_id"]).alias("items"))
                      .orderBy("text"), "items")

    def indexes():
        held: list[tuple] = []
        for piece in _pieces(distinct.toLocalIterator()):
            held.append(piece)
            if len(held) == index_pieces:
                yield Index(held, threshold)
                held = []
        if held:
            yield Index(held, threshold)

    def search(df, shared):
        def make():
            index = shared.value

            def apply(texts):
                return [pa.array([index.leaks(t) for t in strings(texts)], pa.list_(pa.int64()))]
            return apply

        return with_columns(df, [StructField(name, ArrayType(LongType()))], make, text)

    todo = indexes()
    first, second = next(todo, None), next(todo, None)
    if first is None:
        return docs.withColumn(name, F.array().cast("array<bigint>"))
    if second is None:
        return search(docs, spark.sparkContext.broadcast(first))
    path = scratch_path(spark, "leaks")
    digest, leaks = (f"{c}_{path[-12:]}" for c in ("digest", "leaks"))       # names that no table of the caller has
    key = F.sha2(F.col(f"`{text}`").cast("binary"), 256).alias(digest)
    for index in chain((first, second), todo):
        shared = spark.sparkContext.broadcast(index)
        (search(docs.select(F.col(f"`{text}`")), shared).where(F.size(name) > 0).select(key, F.col(name).alias(leaks))
         .dropDuplicates([digest]).write.mode("append").parquet(path))
        shared.destroy()
    found = (spark.read.schema(f"{digest} string, {leaks} array<bigint>").parquet(path).groupBy(digest)
             .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(leaks)))).alias(leaks)))
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != name], key)
    return (kept.join(found, digest, "left")
            .withColumn(name, F.coalesce(leaks, F.array().cast("array<bigint>"))).drop(digest, leaks))

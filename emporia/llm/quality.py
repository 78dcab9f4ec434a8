"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (64 words each, the last one shorter). Every
passage is encoded from its bytes and words; gated attention weighs the encoded
passages, and the score is a logistic unit on their weighted mean. Only the
document has a label, so the attention weights are learned from document labels.

Defined cases: a null text counts as empty; an empty text is one passage whose
features are zero; without any labelled row of both classes every score is the
share of label 1 (0.5 without labels), repeated rows are scored alike, a label
table with several rows for a document counts as their mean (1 from 0.5 up),
null labels and null ids teach nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from emporia.llm.common import bucket, fit_passage, text_steps, utf8_buffers, with_columns

PASSAGE_WORDS = 64
#: At most so many labelled documents of each class fit the model ...
FIT_ROWS = 1500
#: ... and only those up to this length (bounds what reaches the driver).
FIT_CHARS = 20_000

# Byte classes: 0 lower case, 1 upper case, 2 digit, 3 blank, 4 line end,
# 5 sentence marks, 6 other ASCII marks, 7 beyond ASCII.
_CLASS = np.full(256, 7, np.uint8)
_CLASS[:128] = 6
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in ".,;:?!'\"-()"]] = 5
N_PAIRS = 64
N_FEATURES = N_PAIRS + 6
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, lower-cased ASCII, whatever stands around it."""
    low = raw | ((_CLASS[raw] == 1) << 5).astype(np.uint8)
    value = (low.astype(np.uint64) + np.uint64(1)) * _ODD
    value ^= value >> np.uint64(29)
    out = np.zeros(len(starts), np.uint64)
    size = ends - starts
    for k in range(int(size.max(initial=0))):
        live = np.flatnonzero(size > k) if k else slice(None)
        at = starts[live] + k
        h = (out[live] ^ value[at]) * np.uint64(0xBF58476D1CE4E5B9)
        out[live] = h ^ (h >> np.uint64(31))
        if k == 40:  # the rest of a longer word counts through its sum
            more = np.flatnonzero(size > 41)
            total = np.concatenate([[np.uint64(0)], np.cumsum(value)])
            out[more] ^= total[ends[more]] - total[starts[more] + 41]
            break
    return out


def encode_passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and at which passage each document begins."""
    raw, at = utf8_buffers(texts)
    n_docs = len(at) - 1
    cls = _CLASS[raw]
    blank = (cls == 3) | (cls == 4)
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = blank[:-1]
    edge[at[:-1]] = True  # a word never runs on into the next text
    starts = np.flatnonzero(edge[:-1] & ~blank)
    stops = np.ones(len(raw) + 1, bool)
    stops[1:-1] = blank[1:]
    stops[at[1:]] = True
    ends = np.flatnonzero(stops[1:] & ~blank) + 1
    words_before = np.searchsorted(starts, at)
    n_words = np.diff(words_before)
    n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(n_passages)])
    word_doc = np.repeat(np.arange(n_docs), n_words)
    word_passage = first[word_doc] + (np.arange(len(starts)) - words_before[word_doc]) // PASSAGE_WORDS
    # byte positions where passages begin: at their first word, the first one at the text's start
    begin = np.zeros(first[-1] + 1, np.int64)
    if len(starts):
        new = np.flatnonzero(np.r_[True, np.diff(word_passage) > 0])
        begin[word_passage[new]] = starts[new]
    begin[first[:-1]] = at[:-1]
    begin[-1] = len(raw)
    passages = first[-1]
    size = np.diff(begin)
    byte_passage = np.repeat(np.arange(passages), size)
    x = np.zeros((passages, N_FEATURES), np.float32)
    if len(raw) > 1:
        pair = cls[:-1].astype(np.int64) * 8 + cls[1:]
        inside = np.ones(len(raw), bool)
        inside[at[1:][at[1:] > 0] - 1] = False  # a text's last byte has no next one
        counts = np.bincount((byte_passage[:-1] * N_PAIRS + pair)[inside[:-1]], minlength=passages * N_PAIRS)
        x[:, :N_PAIRS] = np.sqrt(counts.reshape(passages, N_PAIRS) / np.maximum(1, size)[:, None])
    n = np.bincount(word_passage, minlength=passages).astype(np.float64)
    if len(starts):
        length = (ends - starts).astype(np.float64)
        some = np.maximum(n, 1)
        mean = np.bincount(word_passage, length, passages) / some
        spread = np.sqrt(np.maximum(0, np.bincount(word_passage, length ** 2, passages) / some - mean ** 2))
        h = _word_hashes(raw, starts, ends)
        order = np.lexsort((h, word_passage))
        ph, pp = h[order], word_passage[order]
        same = np.r_[False, (ph[1:] == ph[:-1]) & (pp[1:] == pp[:-1])]
        repeated = np.bincount(pp[same], minlength=passages) / some
        next_same = np.r_[(h[1:] == h[:-1]) & (word_passage[1:] == word_passage[:-1]), False]
        adjacent = np.bincount(word_passage[next_same], minlength=passages) / some
        # words that stand elsewhere in the document too
        doc_order = np.lexsort((h, word_doc))
        dh, dd = h[doc_order], word_doc[doc_order]
        again = np.r_[False, (dh[1:] == dh[:-1]) & (dd[1:] == dd[:-1])]
        long_words = length[doc_order] >= 6
        copied = np.bincount(word_passage[doc_order][again & long_words], minlength=passages) / some
        x[:, N_PAIRS:] = np.stack([mean / 10, spread / 10, repeated, adjacent, copied,
                                   n / PASSAGE_WORDS], 1)
    return x, first


class Model:
    """Encoder, gated attention and logistic unit, with their gradients."""

    hidden, gate = 24, 12

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f, d, g = N_FEATURES, self.hidden, self.gate
        self.mean, self.scale = np.zeros(f), np.ones(f)
        self.base: float | None = 0.5
        self.p = {"we": rng.normal(0, f ** -0.5, (f, d)), "be": np.zeros(d),
                  "v": rng.normal(0, d ** -0.5, (d, g)), "u": rng.normal(0, d ** -0.5, (d, g)),
                  "w": rng.normal(0, g ** -0.5, g), "o": rng.normal(0, d ** -0.5, d), "b": np.zeros(1)}

    def forward(self, x: np.ndarray, first: np.ndarray, keep: bool = False):
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["we"] + p["be"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * s) @ p["w"]
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        a = np.exp(e - np.maximum.reduceat(e, first[:-1])[doc])
        a /= np.add.reduceat(a, first[:-1])[doc]
        z = np.add.reduceat(a[:, None] * h, first[:-1])
        y = 1 / (1 + np.exp(-(z @ p["o"] + p["b"][0])))
        return (y, (x, h, t, s, a, z, doc)) if keep else (y, a)

    def gradients(self, y, kept, first, target, weight):
        p = self.p
        x, h, t, s, a, z, doc = kept
        dy = (y - target) * weight
        dz = dy[:, None] * p["o"]
        dh = a[:, None] * dz[doc]
        da = (h * dz[doc]).sum(1)
        de = a * (da - np.add.reduceat(a * da, first[:-1])[doc])
        dt, ds = de[:, None] * p["w"] * s * (1 - t ** 2), de[:, None] * p["w"] * t * s * (1 - s)
        dh += dt @ p["v"].T + ds @ p["u"].T
        dx = dh * (1 - h ** 2)
        return {"o": z.T @ dy, "b": np.array([dy.sum()]), "w": (t * s).T @ de, "v": h.T @ dt,
                "u": h.T @ ds, "we": x.T @ dx, "be": dx.sum(0)}

    def fit(self, x: np.ndarray, first: np.ndarray, target: np.ndarray, epochs: int = 60,
            batch: int = 64, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> "Model":
        if len(target) == 0 or target.min() == target.max():
            self.base = float(target.mean()) if len(target) else 0.5
            return self
        self.base = None
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        rng = np.random.default_rng(seed)
        share = target.mean()
        weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            lr = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for part in np.array_split(rng.permutation(len(target)), max(1, len(target) // batch)):
                size = first[part + 1] - first[part]
                at = np.r_[0, np.cumsum(size)]
                rows = np.repeat(first[part] - at[:-1], size) + np.arange(at[-1])
                y, kept = self.forward(x[rows], at, keep=True)
                g = self.gradients(y, kept, at, target[part], weight[part] / len(part))
                step += 1
                for k in self.p:
                    d = g[k] + decay * self.p[k]
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v2[k] = 0.999 * v2[k] + 0.001 * d * d
                    self.p[k] = self.p[k] - lr * (m[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.base is not None:
            return np.full(len(texts), self.base)
        x, first = encode_passages(texts)
        return self.forward(x, first)[0]


def _encoded(batches):
    for whole in batches:
        for part in text_steps(whole, "text"):
            x, first = encode_passages(part.column("text"))
            rows = [x[first[i]:first[i + 1]].tobytes() for i in range(len(first) - 1)]
            yield pa.RecordBatch.from_arrays([part.column("target"), pa.array(rows, pa.binary())],
                                             ["target", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3,
                held_out: int = 1, rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents of each class.

    Rows whose crc32(doc_id) mod ``modulus`` is ``held_out`` are never learned
    from. The sample is the ids with the smallest hashes, so it does not depend
    on the partitioning. Of a text of more than FIT_CHARS characters so many are
    learned.
    """
    known = (labels.where(F.col(label).isNotNull() & (bucket("doc_id", modulus) != held_out))
             .groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("target")))
    order = [F.xxhash64("doc_id", F.lit("quality")), F.col("doc_id")]
    picked = [known.where(F.col("target") == k).orderBy(*order).limit(rows) for k in (0, 1)]
    # at most 2 * rows pairs of numbers: their size is known, so they may be broadcast
    sample = F.broadcast(picked[0].unionByName(picked[1]))
    found = (docs.select("doc_id", fit_passage("text", FIT_CHARS, "quality").alias("text"))
             .where("text IS NOT NULL").join(sample, "doc_id").select("target", "text")
             .mapInArrow(_encoded, "target int, x binary")
             # copies of an id would break the bound; the order makes the fit repeatable
             .orderBy(F.xxhash64("x"), "target").limit(2 * rows).collect())
    x = [np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in found]
    first = np.r_[0, np.cumsum([len(a) for a in x])].astype(np.int64)
    target = np.array([r.target for r in found], np.float64)
    return Model().fit(np.concatenate(x) if x else np.zeros((0, N_FEATURES)), first, target)


def score_quality(docs: DataFrame, model: Model, score: str = "score",
                  predicted: str = "predicted") -> DataFrame:
    """``docs`` with the score (0 to 1) and the predicted class of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = shared.value

        def apply(texts):
            y = fitted.score(texts)
            return [pa.array(y, pa.float64()), pa.array((y >= 0.5).astype(np.int32))]
        return apply

    return with_columns(docs, [StructField(score, DoubleType()), StructField(predicted, IntegerType())], make)

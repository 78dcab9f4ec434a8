"""Toxicity: cumulative-link ordinal regression on sparse text features.

Severity grades run from 0 (not toxic) to 3. One weight vector serves all
grades: P(grade > k) = sigmoid(w.x - t_k) with thresholds t_0 <= t_1 <= t_2; the
expected severity is the sum of these probabilities. Features are the words of a
text and their beginnings (3 to 6 letters), counted as log(1 + n); only features
that the labels set apart from clean texts are kept, so a long clean text has
no more of them than a short one.

Labels mark a document as toxic or not. The grade of a toxic one follows from how
many words of it the kept features touch, by terciles over the toxic documents
of the fit: the third with the fewest is grade 1, the third with the most
grade 3. A label column that has grades itself is used as it is (``graded``).

Defined cases: a null or wordless text has no features (the lowest severity that
the model gives); without labels of both kinds severity is 0 for all; rows with
null ids or labels teach nothing, several labels of a document count as their
maximum; repeated rows are scored alike.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField

from emporia.llm.common import bucket, fit_passage, strings, with_columns

GRADES = 3
#: At most so many labelled documents, toxic and clean, fit the model, up to this length each.
FIT_TOXIC, FIT_CLEAN, FIT_CHARS = 1500, 3000, 10_000
FEATURES = 3000
_PREFIXES = (3, 4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings (marked with a star)."""
    return [word] + [word[:n] + "*" for n in _PREFIXES if len(word) > n]


class _Hits(dict):
    """Word -> numbers of its kept features, filled on demand and emptied when large."""

    def __init__(self, kept: dict[str, int]):
        super().__init__()
        self.kept = kept

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(k for f in features_of(word) if (k := self.kept.get(f)) is not None)
        if len(self) > 300_000:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


class SeverityModel:
    def __init__(self):
        self.kept: dict[str, int] = {}
        self.weights = np.zeros(0)
        self.thresholds = np.full(GRADES, np.inf)
        self._hits = _Hits(self.kept)

    def __getstate__(self):
        return {"kept": self.kept, "weights": self.weights, "thresholds": self.thresholds}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._hits = _Hits(self.kept)

    def words_touched(self, text: str) -> list[tuple[int, ...]]:
        hits = self._hits
        return [h for w in _WORD.findall(text.lower()) if (h := hits[w])]

    def vector(self, text: str) -> tuple[list[int], np.ndarray]:
        n = Counter(k for h in self.words_touched(text) for k in h)
        return list(n), np.log1p(np.fromiter(n.values(), np.float64, len(n)))

    def select(self, texts: list[str], toxic: np.ndarray) -> None:
        """Keep the features that toxic documents hold far more often than clean ones."""
        pos, neg = Counter(), Counter()
        for t, is_toxic in zip(texts, toxic, strict=True):
            (pos if is_toxic else neg).update({f for w in set(_WORD.findall(t.lower())) for f in features_of(w)})
        n_pos, n_neg = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
        strength = {}
        for f, n in pos.items():
            if n < 3:
                continue
            ratio = np.log((n + 0.5) / (n_pos + 1)) - np.log((neg[f] + 0.5) / (n_neg + 1))
            if ratio > 2.5:
                strength[f] = ratio * n
        best = sorted(strength, key=lambda f: (-strength[f], f))[:FEATURES]
        self.kept = {f: k for k, f in enumerate(best)}
        self._hits = _Hits(self.kept)

    def grades(self, texts: list[str], toxic: np.ndarray) -> np.ndarray:
        touched = np.array([len(self.words_touched(t)) if x else 0 for t, x in zip(texts, toxic, strict=True)])
        cuts = np.quantile(touched[toxic], [k / GRADES for k in range(1, GRADES)])
        return np.where(toxic, 1 + (touched[:, None] > cuts).sum(1), 0)

    def fit(self, texts: list[str], label: np.ndarray, graded: bool = False, penalty: float = 1e-4,
            steps: int = 400) -> "SeverityModel":
        toxic = label > 0
        if not toxic.any() or toxic.all():
            return self
        self.select(texts, toxic)
        grade = np.minimum(label, GRADES) if graded else self.grades(texts, toxic)
        x = np.zeros((len(texts), len(self.kept)))
        for row, t in zip(x, texts, strict=True):
            cols, values = self.vector(t)
            row[cols] = values
        w = np.zeros(x.shape[1])
        share = np.array([(grade > k).mean() for k in range(GRADES)]).clip(1e-3, 1 - 1e-3)
        t = np.maximum.accumulate(np.log(1 / share - 1))
        # thresholds as the first one and positive steps, so that their order holds
        u = np.r_[t[0], np.log(np.maximum(np.diff(t), 1e-2))]
        state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(u), np.zeros_like(u)]
        rows = np.arange(len(grade))
        for step in range(1, steps + 1):
            t = u[0] + np.r_[0, np.cumsum(np.exp(u[1:]))]
            # P(grade > k) with 1 before and 0 after; the likelihood of a grade is the difference of its ends
            p = 1 / (1 + np.exp(np.clip(t - (x @ w)[:, None], -30, 30)))
            ends = np.c_[np.ones(len(x)), p, np.zeros(len(x))]
            mass = np.maximum(ends[rows, grade] - ends[rows, grade + 1], 1e-9)
            slope = p * (1 - p)
            lower = grade[:, None] == np.arange(1, GRADES + 1)
            upper = grade[:, None] == np.arange(GRADES)
            d = (lower.astype(float) - upper) * slope / mass[:, None] / len(x)
            g_w = -(x.T @ d.sum(1)) + penalty * w
            g_t = d.sum(0)
            g_u = np.r_[g_t.sum(), [np.exp(u[k]) * g_t[k:].sum() for k in range(1, GRADES)]]
            rate = 0.1 * 0.5 * (1 + np.cos(np.pi * step / steps)) + 1e-3
            for v, g, m, s in ((w, g_w, state[0], state[1]), (u, g_u, state[2], state[3])):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
        self.weights = w
        self.thresholds = u[0] + np.r_[0, np.cumsum(np.exp(u[1:]))]
        return self

    def exceed(self, text: str) -> np.ndarray:
        """P(grade > k) for k = 0, 1, 2 of a whole text."""
        cols, values = self.vector(text)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds - values @ self.weights[cols]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", graded: bool = False,
                 modulus: int = 5, held_out: int | None = 0) -> SeverityModel:
    """Fit on at most FIT_TOXIC toxic and FIT_CLEAN clean labelled documents, by the smallest hashes of their ids.

    Of a text of more than FIT_CHARS characters so many are learned.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if held_out is not None:
        known = known.where(bucket("doc_id", modulus) != held_out)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("target"))
    order = [F.xxhash64("doc_id", F.lit("toxicity")), F.col("doc_id")]
    # a bounded number of ids, so they may be broadcast
    sample = F.broadcast(known.where("target > 0").orderBy(*order).limit(FIT_TOXIC).unionByName(
        known.where("target <= 0").orderBy(*order).limit(FIT_CLEAN)))
    found = (docs.select("doc_id", fit_passage("text", FIT_CHARS, "toxicity").alias("text"))
             .where("text IS NOT NULL").join(sample, "doc_id")
             .orderBy(F.xxhash64("doc_id", "text")).limit(FIT_TOXIC + FIT_CLEAN).select("target", "text").collect())
    return SeverityModel().fit([r.text for r in found], np.array([r.target for r in found], int), graded)


def score_toxicity(docs: DataFrame, model: SeverityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (expected grade, 0 to 3), ``grade`` (the median grade) and ``toxic`` (grade > 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = shared.value

        def apply(texts):
            p = np.array([fitted.exceed(t) for t in strings(texts)]).reshape(-1, GRADES)
            return [pa.array(p.sum(1), pa.float64()), pa.array((p >= 0.5).sum(1).astype(np.int32)),
                    pa.array(p[:, 0] >= 0.5)]
        return apply

    return with_columns(docs, [StructField("severity", DoubleType()), StructField("grade", IntegerType()),
                               StructField("toxic", BooleanType())], make, text)

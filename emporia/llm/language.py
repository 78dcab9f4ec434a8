"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts counts the letter n-grams of
every length 1 to ``MAX_N`` that both hold, each length normalised by its number
of distinct n-grams. Landmark texts span a Nystroem space; kernel ridge
regression in it, one language against the rest, gives weights for the
landmarks. A batch of texts is scored by two matrix products: presence times
landmarks (the kernel), kernel times weights.

Texts are lower-cased; every run of characters that aren't letters is one blank.
Letters that no landmark holds count as one and the same unknown letter.

Defined cases: a null text or one without a letter is ``und`` with score 0;
equal scores go to the language that sorts first; with no text to learn from
every language is ``und``; rows without id or language teach nothing; repeated
rows are predicted alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from emporia.llm.common import bucket, fit_passage, strings, with_columns

MAX_N = 3
#: At most so many texts of a language fit the model, and only those up to this length ...
FIT_ROWS, FIT_CHARS = 400, 4000
#: ... and at most so many of them, dealt over the languages, are landmarks.
LANDMARKS = 128
RIDGE = 1e-3
_BATCH = 128
_TABLE = 1 << 24


class Grams:
    """Distinct n-grams of a text over an alphabet, as numbers."""

    def __init__(self, alphabet: list[str], max_n: int = MAX_N):
        #: 0 blank, 1 to A the alphabet, A + 1 any other letter
        self.base = len(alphabet) + 2
        self.max_n = max_n
        code = np.zeros(0x110000, np.int32)
        code[[c for c in range(0x110000) if chr(c).isalpha()]] = self.base - 1
        code[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self._code = code
        self._seen = {n: np.zeros(self.base ** n, np.int32) for n in range(1, max_n + 1) if self.base ** n <= _TABLE}

    def symbols(self, text: str) -> np.ndarray:
        """The text's symbols between two blanks; empty without a letter."""
        s = self._code[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not s.any():
            return s[:0]
        s = np.concatenate([[0], s, [0]])
        return s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])]

    def distinct(self, text: str) -> list[np.ndarray]:
        """For n = 1, 2, ...: the distinct n-grams, no blank among the single letters."""
        s = self.symbols(text).astype(np.int64)
        out, g = [], s
        for n in range(1, self.max_n + 1):
            if n > 1:
                g = g[:-1] * self.base + s[n - 1:] if len(g) else g
            grams = g[g > 0] if n == 1 else g
            seen = self._seen.get(n)
            if seen is None:
                out.append(np.unique(grams))
            else:  # of equal n-grams the last write stands
                place = np.arange(len(grams), dtype=np.int32)
                seen[grams] = place
                out.append(grams[seen[grams] == place])
        return out


class LanguageModel:
    """Landmarks and one weight for each landmark and language."""

    def __init__(self, languages: list[str], landmarks: list[str], max_n: int = MAX_N):
        self.languages = languages
        self.alphabet = sorted({c for t in landmarks for c in t.lower() if c.isalpha()})
        self.max_n = max_n
        self._open()
        held = [self.grams.distinct(t) for t in landmarks]
        self.vocab = [np.unique(np.concatenate([h[k] for h in held])) if held else np.zeros(0, np.int64)
                      for k in range(max_n)]
        self._index()
        self.landmarks = self._presence(held)
        self.weights = np.zeros((len(landmarks), len(languages)))

    def _open(self):
        self.grams = Grams(self.alphabet, self.max_n)

    def _index(self):
        self.first = np.concatenate([[0], np.cumsum([len(v) for v in self.vocab])])
        self._column = {}
        for k, v in enumerate(self.vocab):
            if self.grams.base ** (k + 1) <= _TABLE:
                at = np.full(self.grams.base ** (k + 1), -1, np.int32)
                at[v] = np.arange(len(v)) + self.first[k]
                self._column[k] = at

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("grams", "_column", "first")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._open()
        self._index()

    def _presence(self, held: list[list[np.ndarray]]) -> np.ndarray:
        """One row for each text: 1 / sqrt(number of its n-grams) where it holds a landmark's n-gram."""
        p = np.zeros((len(held), self.first[-1]), np.float32)
        for row, grams in zip(p, held, strict=True):
            for k, g in enumerate(grams):
                if not len(g):
                    continue
                if k in self._column:
                    c = self._column[k][g]
                    c = c[c >= 0]
                else:
                    at = np.minimum(np.searchsorted(self.vocab[k], g), len(self.vocab[k]) - 1)
                    c = at[self.vocab[k][at] == g] + self.first[k]
                row[c] = len(g) ** -0.5
        return p

    def kernel(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Kernel of the texts with the landmarks, and which texts have a letter."""
        held = [self.grams.distinct(t) for t in texts]
        return self._presence(held) @ self.landmarks.T / self.max_n, np.array([len(h[0]) > 0 for h in held], bool)

    def fit(self, texts: list[str], target: np.ndarray, ridge: float = RIDGE) -> "LanguageModel":
        """Ridge regression of the one-against-rest targets in the Nystroem space."""
        near = (self.landmarks @ self.landmarks.T / self.max_n).astype(np.float64)
        value, vector = np.linalg.eigh(near)
        use = value > 1e-6 * value.max()
        root = vector[:, use] / np.sqrt(value[use])
        space = np.concatenate([self.kernel(texts[k:k + _BATCH])[0] for k in range(0, len(texts), _BATCH)]) @ root
        goal = (target[:, None] == np.arange(len(self.languages))).astype(np.float64)
        # every language weighs the same, however many texts it has
        weight = (1 / np.maximum(1, goal.sum(0)))[target][:, None]
        gram = space.T @ (weight * space) + ridge * np.eye(space.shape[1])
        self.weights = root @ np.linalg.solve(gram, space.T @ (weight * goal))
        return self

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs: list[str] = []
        scores = np.zeros(len(texts))
        for k in range(0, len(texts), _BATCH):
            near, letters = self.kernel(texts[k:k + _BATCH])
            f = near @ self.weights if self.languages else np.zeros((len(letters), 1))
            best = f.argmax(1)
            known = letters & bool(self.languages)
            langs += [self.languages[b] if ok else "und" for b, ok in zip(best, known, strict=True)]
            scores[k:k + _BATCH] = np.where(known, np.clip(f.max(1), 0, 1), 0)
        return langs, scores


def fit_language(docs: DataFrame, modulus: int = 4, held_out: int = 2, rows: int = FIT_ROWS,
                 landmarks: int = LANDMARKS) -> LanguageModel:
    """Fit on at most ``rows`` texts of each language.

    Rows whose crc32(doc_id) mod ``modulus`` is ``held_out`` are never learned
    from. The sample is the ids with the smallest hashes of each language; of a text
    of more than FIT_CHARS characters so many are learned, whatever its language.
    """
    known = (docs.where(F.col("lang").isNotNull() & (bucket("doc_id", modulus) != held_out))
             .select("doc_id", "lang", F.xxhash64("doc_id", F.lit("language")).alias("h")))
    counts = known.groupBy("lang").count()
    # a little more than `rows` ids of each language by the hash, so that the exact choice is among few
    share = F.least(F.lit(1.0), F.lit(4.0 * rows) / F.col("count"))
    # one row a language, so they may be broadcast: ids are filtered where they are read, not brought together by language
    few = (known.join(F.broadcast(counts), "lang").where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
           .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
           .where(F.col("place") <= rows).select("doc_id", "lang", "h"))
    n_languages = counts.count()
    # at most rows * languages ids: their size is known, so they may be broadcast
    found = (docs.select("doc_id", fit_passage("text", FIT_CHARS, "language").alias("text"), F.col("lang").alias("__lang"))
             .where("text IS NOT NULL").join(F.broadcast(few), "doc_id")
             .where("__lang = lang").orderBy("h", "doc_id", "text").limit(rows * max(1, n_languages))
             .select("lang", "text").collect())
    found = [r for r in found if any(c.isalpha() for c in r.text)]
    languages = sorted({r.lang for r in found})
    by = {lang: [r.text for r in found if r.lang == lang] for lang in languages}
    # the longest texts of the sample are the landmarks: they span the most n-grams
    chosen = [t for lang in languages
              for t in sorted(by[lang], key=lambda t: (-len(t), t))[:max(1, landmarks // len(languages))]]
    model = LanguageModel(languages, chosen)
    if len(languages) == 0:
        return model
    target = np.array([languages.index(r.lang) for r in found])
    return model.fit([r.text for r in found], target)


def predict_language(docs: DataFrame, model: LanguageModel, lang: str = "lang_pred", score: str = "score",
                     text: str = "text") -> DataFrame:
    """``docs`` with the predicted language of every whole text and its score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        fitted = shared.value

        def apply(texts):
            langs, scores = fitted.predict(strings(texts))
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
        return apply

    return with_columns(docs, [StructField(lang, StringType()), StructField(score, DoubleType())], make, text)

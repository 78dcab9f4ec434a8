"""BPE encoding and decoding by dynamic programming over prefixes.

Every prefix of a word has one last token in its encoding: the token that
matches at the prefix's end and is compatible with the last token of the prefix
before it. A suffix automaton of all tokens finds the matches; two tokens are
compatible when no merge rule would join pieces across their border before
either side's own merges use those pieces up. Following the last tokens back
from the end gives the ids of the merge procedure, without running merges.

The tokenizer is a file of the tokenizers library (word ends, lower case,
byte-level symbols); its path is a parameter. The driver reads it (a few MB) and
broadcasts its text. Python keeps the encodings of recent words, and of recent
chunks of text between white space, at most ``CACHE`` of each in two generations.

Defined cases: null counts as empty; an empty or blank text has no ids and
decodes to the empty text; the strings of special tokens in a text become those
tokens; words of any length are encoded whole.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import string
import struct
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField

from emporia.llm.common import strings, with_columns

CACHE = 600_000
_END = "</w>"
_NEVER = 1 << 60
_BLANKS = re.compile(r"[^\S\x1c-\x1f]+")  # Python counts four separators as white space, Unicode doesn't
_CONTROL = re.compile(r"[\x1c-\x1f]")

# Code points that the regex module counts as letters or numbers and the tokenizers
# library, whose tables end with Unicode 16, doesn't.
_LATER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE),
    (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6),
    (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191),
    (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F)]
_LATER = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _LATER) + "]")
# Lower case of letters newer than Python's own tables, and of the capital sigma, which
# the library maps alike at a word's end.
_LOWER = {0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
          0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {
              c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}


def byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class SuffixAutomaton:
    """Generalised suffix automaton of the tokens; symbols are 0 to 511 (256 and up end a word)."""

    def __init__(self, tokens: dict[int, list[int]]):
        link, size, edges = [-1], [0], [{}]

        def clone(p: int, q: int, c: int) -> int:
            new = len(size)
            size.append(size[p] + 1)
            link.append(link[q])
            edges.append(dict(edges[q]))
            link[q] = new
            while p >= 0 and edges[p].get(c) == q:
                edges[p][c] = new
                p = link[p]
            return new

        ends = {}
        for token, symbols in tokens.items():
            last = 0
            for c in symbols:
                p, q = last, edges[last].get(c)
                if q is not None:
                    last = q if size[p] + 1 == size[q] else clone(p, q, c)
                    continue
                new = len(size)
                size.append(size[p] + 1)
                link.append(0)
                edges.append({})
                while p >= 0 and c not in edges[p]:
                    edges[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = edges[p][c]
                    link[new] = q if size[p] + 1 == size[q] else clone(p, q, c)
                last = new
            ends[last] = token
        self.link, self.size, self.edges = link, size, edges
        #: state -> (token, length) of all tokens that end where the state's longest text ends, longest first
        self.ending: list[tuple] = [()] * len(size)
        for s in sorted(range(1, len(size)), key=size.__getitem__):
            own = ((ends[s], size[s]),) if s in ends else ()
            self.ending[s] = own + self.ending[link[s]]


class Encoder:
    """Encode and decode with the rules of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != _END or spec.get("decoder"):
            raise ValueError("not a BPE tokenizer with word ends and plain decoding")
        self.strings = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: t for t, i in self.special.items()}
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._words = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}"))
        of = byte_symbols()
        symbols = {}
        for t, i in model["vocab"].items():
            ends = t.endswith(_END)
            s = [of[c] for c in (t[:-len(_END)] if ends else t)]
            if ends:
                s[-1] += 256
            symbols[i] = s
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab = model["vocab"]
        #: (left, right) -> rank of the merge; token -> its two parts
        self._rank = {vocab[a] << 20 | vocab[b]: r for r, (a, b) in enumerate(merges)}
        self._parts = {vocab[a + b]: (vocab[a], vocab[b], r) for r, (a, b) in enumerate(merges)}
        self._length = {i: len(s) for i, s in symbols.items()}
        self._automaton = SuffixAutomaton(symbols)
        self._right: dict[int, tuple] = {}
        self._left: dict[int, tuple] = {}
        self._fits: dict[int, bool] = {}
        self._known = _Recent(lambda word: _packed(self.encode_word(word.encode())))

    def _spine(self, token: int, side: int, known: dict) -> tuple:
        """Pieces that stand at one edge of a token while it is merged, with the rank that uses each up."""
        if token not in known:
            out, used = [], _NEVER
            at = token
            while True:
                out.append((at, used))
                if at not in self._parts:
                    break
                used = self._parts[at][2]
                at = self._parts[at][side]
            known[token] = tuple(reversed(out))
        return known[token]

    def compatible(self, first: int, second: int) -> bool:
        """Does the encoding of the two tokens' text keep them apart?"""
        key = first << 20 | second
        fits = self._fits.get(key)
        if fits is not None:
            return fits
        left, right = self._spine(first, 1, self._right), self._spine(second, 0, self._left)
        i = j = 0
        while True:
            (a, a_used), (b, b_used) = left[i], right[j]
            rank = self._rank.get(a << 20 | b, _NEVER)
            # of equal ranks the merge further left comes first
            if rank < a_used and rank <= b_used and rank != _NEVER:
                fits = False
                break
            if a_used == b_used == _NEVER:
                fits = True
                break
            if a_used <= b_used:
                i += 1
            else:
                j += 1
        if len(self._fits) > 2_000_000:
            self._fits.clear()
        self._fits[key] = fits
        return fits

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one word's bytes."""
        sam = self._automaton
        edges, link, size, ending = sam.edges, sam.link, sam.size, sam.ending
        compatible, known = self.compatible, self._fits.get
        n = len(word)
        last, back = [0] * (n + 1), [0] * (n + 1)
        state = length = 0
        for i, c in enumerate(word, 1):
            if i == n:
                c += 256
            to = edges[state].get(c)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = edges[state].get(c)
            state, length = (to, length + 1) if to is not None else (0, 0)
            # a match shorter than the state's longest text ends in the tokens of the states above
            for t, z in ending[state] if length == size[state] else ending[link[state]]:
                j = i - z
                if j:
                    fits = known(last[j] << 20 | t)
                    if not (compatible(last[j], t) if fits is None else fits):
                        continue
                last[i], back[i] = t, j
                break
        ids = []
        i = n
        while i > 0:
            ids.append(last[i])
            i = back[i]
        ids.reverse()
        return ids

    def _split(self, part: str) -> list[str]:
        """The words of a lower-cased chunk."""
        if part.isalpha():
            return [part]
        word = part.rstrip(string.punctuation)
        if word.isalpha():  # marks after a word's letters are one word
            return [word, part[len(word):]]
        if part.isascii() or not _LATER.search(part):
            return self._words.findall(part)
        shown = _LATER.sub("\ufffd", part)  # a character that is neither letter nor number, in the same places
        return [part[m.start():m.end()] for m in self._words.finditer(shown)]

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space, as little-endian 32-bit numbers."""
        out = []
        for part in self._cut.split(chunk) if self._cut and "<" in chunk else (chunk,):
            if part in self.special:
                out.append(_packed([self.special[part]]))
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).translate(_LOWER)
            out += [self._known[word] for word in self._split(part.lower())]
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return _unpacked(b"".join([self.encode_chunk(chunk) for chunk in chunks(text)]))

    def decode(self, ids) -> str:
        """Text of ids; special tokens are kept."""
        return " ".join(map(self.strings.__getitem__, ids))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _unpacked(raw: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def chunks(text: str) -> list[str]:
    """The parts of a text between white space."""
    if _CONTROL.search(text):
        return [c for c in _BLANKS.split(text) if c]
    return text.split()


class _Recent(dict):
    """What ``make`` gives for a key, kept for recent keys: at most ``bound`` in two generations."""

    def __init__(self, make, bound: int = CACHE):
        super().__init__()
        self.make, self.half, self.old = make, bound // 2, {}

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = found
        return found


_LOADED: dict[str, tuple[Encoder, _Recent]] = {}


def _loaded(text: str) -> tuple[Encoder, _Recent]:
    """A worker's encoder and its ids of recent chunks, kept between tasks."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        encoder = Encoder(text)
        gc.freeze()  # the automaton never becomes garbage
        _LOADED[key] = encoder, _Recent(encoder.encode_chunk)
    return _LOADED[key]


def read_tokenizer(path: str) -> str:
    """The text of a tokenizer file on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _apply(docs: DataFrame, tokenizer: str, fields: list[StructField], row, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))

    def make():
        encoder, cache = _loaded(shared.value)

        def apply(texts):
            rows = []
            for t in strings(texts):
                raw = b"".join([cache[c] for c in chunks(t)])
                rows.append(row(raw, encoder.decode(_unpacked(raw))))
            return [pa.array(col, f.dataType) for col, f in zip(
                list(zip(*rows, strict=True)) or [()] * len(fields), arrow, strict=True)]
        return apply

    kinds = {StringType(): pa.string(), IntegerType(): pa.int32(), BinaryType(): pa.binary(),
             ArrayType(IntegerType()): pa.list_(pa.int32())}
    arrow = [type("Field", (), {"dataType": kinds[f.dataType]}) for f in fields]
    return with_columns(docs, fields, make, text)


def encode(docs: DataFrame, tokenizer: str, ids: str = "ids", decoded: str = "decoded",
           text: str = "text") -> DataFrame:
    """``docs`` with the ids of every whole text (array<int>) and the text they decode to."""
    def row(raw: bytes, out: str):
        return _unpacked(raw), out

    return _apply(docs, tokenizer, [StructField(ids, ArrayType(IntegerType())), StructField(decoded, StringType())],
                  row, text)


def encode_digests(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of what :func:`encode` returns."""
    def row(raw: bytes, out: str):
        return len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(out.encode()).hexdigest()

    return _apply(docs, tokenizer, [StructField("n_tokens", IntegerType()), StructField("ids_sha256", StringType()),
                                    StructField("decoded_sha256", StringType())], row, text)

"""PII: every detected entity gets a keyed surrogate of its own kind and format.

Mail addresses, phone numbers, IPv4 and IPv6 addresses, card and account numbers,
IBANs, US social security numbers, quoted secrets (``token = "..."``) and names
after a title. Everything goes through a keyed permutation of all strings of its
format (a Feistel network with cycle-walking), so two of a kind never share a
surrogate; digits stay digits, letters stay letters of their script and case,
check digits stay valid. In names vowels stay vowels and consonants consonants
of their script, and given names keep or get an ending of their gender (from the
title; ``Dr.`` and the like have none).

Coreference: the surrogate depends on the key and the entity's canonical form
(case and separators don't matter) and nothing else, so an entity has the same
surrogate in every document. Collision checks run on the table of distinct
entities: a surrogate that is itself an entity of the corpus, or that another
entity of the kind holds already, is drawn again with the next attempt number
until none collides; neither check is ever left out. Mail addresses and names
grow from the second attempt on and phone numbers from the 17th, as short formats
may be crowded; should the corpus hold nearly all strings of another format, the
run fails after 64 attempts rather than let an entity stand. Only entities with a
later attempt are joined back, to the documents that hold them.

Entities never reach over a line end. Defined cases: null texts stay null, texts
without entities are returned unchanged, repeated rows alike. A number of 13 to
19 digits is a card or account number whatever its check digit, unless it is an
ISBN; four numbers after ``version`` or ``release`` are no address. Letters of
other scripts than those of ``_RANGES`` stay in names as they are.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField

from emporia.llm.common import staged, text_steps

#: Attempts after which phone numbers get further digits, and after which the run fails.
CROWDED, MOST = 16, 64

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAME = r"[^\W\d_a-zà-öø-ÿа-яα-ω][\w'’-]+"
# Titles by gender ("n": any).
TITLES = {"f": ("Mrs.", "Ms.", "Frau", "Madame", "Mme.", "Señora", "Sra.", "Г-жа", "Κυρία"),
          "m": ("Mr.", "Herr", "Monsieur", "Señor", "Sr.", "Г-н", "Κύριος"),
          "n": ("Dr.", "Prof.", "Professor", "Д-р")}
# Last letters that given names of a gender keep, and the one that others get.
ENDINGS = {("f", "latin"): ("ae", "a"), ("f", "cyrillic"): ("ая", "а"), ("f", "greek"): ("αάηήωώ", "α"),
           ("m", "latin"): ("iou", "n"), ("m", "cyrillic"): ("", "н"), ("m", "greek"): ("σ", "σ")}
# Vowels and consonants that stand for one another in names, and what a crowded name grows by.
_NAME_ALPHABETS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåèéêëìíîïòóôõöøùúûü", "çčćđłñňřšśžźż",
                   "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ"]
_GROWTH = {"latin": "na", "cyrillic": "на", "greek": "να"}
# First and last letters of further scripts (Armenian to Hangul).
_RANGES = ["աֆ", "את", "ءغ", "في", "अह", "กฮ", "აჰ", "ぁゖ", "ァヺ", "一鿿", "가힣"]
_NAME_ALPHABETS += ["".join(map(chr, range(ord(r[0]), ord(r[1]) + 1))) for r in _RANGES]
_NAME_ALPHABET = {c: a for a in _NAME_ALPHABETS for c in a}

_ENTITY = re.compile(
    r"(?P<email>(?<![\w.+-])[\w.+-]*\w@\w[\w-]*(?:\.\w[\w-]*)*\.[^\W\d_]{2,})"
    r"|(?P<lead>\b(?i:token|secret|password|api[_-]?key)[ \t]*[=:][ \t]*[\"'])(?P<secret>[^\"'\s]{8,})(?=[\"'])"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    rf"|(?P<ip>(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d))"
    r"|(?P<ip6>(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,4}(?!\w)"
    r"|(?<![\w+-])(?:\(\d{3}\) ?|\d{3}[-. ])\d{3}[-. ]\d{4}(?![\w-]))"
    r"|(?P<card>(?<!\w)(?:\d{4}[ -]){3}\d{4}(?!\w)|(?<!\w)\d{13,19}(?!\w))"
    rf"|(?P<title>(?<!\w)(?:{'|'.join(re.escape(t) for ts in TITLES.values() for t in ts)}) )"
    rf"(?P<name>{_NAME}(?: {_NAME})?)")
_HEX = re.compile("[0-9a-fA-F]+")
_DIGIT = re.compile(r"[@\d]|[=:][ \t]*[\"']")
_TITLE_WORDS = tuple(t + " " for ts in TITLES.values() for t in ts)
_GENDER = {t: g for g, ts in TITLES.items() for t in ts}
_VERSION = re.compile(r"\b(?i:version|ver|release)[.:]?[ \t]*$")


def script_of(word: str) -> str:
    """``latin``, ``cyrillic``, ``greek``, ``cjk``, ``hebrew`` and so on, by the first letter."""
    return unicodedata.name(word[0], "latin").split()[0].lower()


def is_isbn(digits: str) -> bool:
    return (len(digits) == 13 and digits[:3] in ("978", "979")
            and sum(int(d) * (3 if k % 2 else 1) for k, d in enumerate(digits)) % 10 == 0)


def luhn(digits: str) -> bool:
    total = sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def permute(key: bytes, tweak: str, value: int, size: int) -> int:
    """A keyed permutation of 0 .. size - 1: Feistel rounds on a square, walked until inside."""
    side = math.isqrt(size - 1) + 1
    width = side.bit_length() // 8 + 9

    def draw(turn: int, x: int) -> int:
        h = hashlib.shake_256(key + bytes([turn]) + tweak.encode() + b"\0" + str(x).encode())
        return int.from_bytes(h.digest(width), "big")

    while True:
        a, b = divmod(value, side)
        for turn in range(0, 8, 2):
            a = (a + draw(turn, b)) % side
            b = (b + draw(turn + 1, a)) % side
        value = a * side + b
        if value < size:
            return value


# Letters that stand for one another, by script and case.
_ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
              "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
              "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"]
_ALPHABET = {c: a for a in _ALPHABETS for c in a}


def permute_text(key: bytes, tweak: str, text: str, alphabet: str | None = None, table: dict = _ALPHABET) -> str:
    """Permute all texts of this format: each character of ``table`` keeps its alphabet, others stay."""
    kinds = [alphabet if alphabet and c in alphabet else table.get(c) for c in text]
    value, size, shape = 0, 1, ""
    for c, k in zip(text, kinds, strict=True):
        if k:
            value, size = value * len(k) + k.index(c), size * len(k)
        shape += k[0] if k else c
    if size == 1:
        return text
    value = permute(key, tweak + "\0" + shape, value, size)
    out = []
    for c, k in zip(reversed(text), reversed(kinds), strict=True):
        if k:
            value, at = divmod(value, len(k))
            c = k[at]
        out.append(c)
    return "".join(reversed(out))


def canonical(kind: str, value: str) -> str:
    """What all spellings of one entity share."""
    if kind in ("phone", "card", "ssn"):
        return ("+" if value.startswith("+") else "") + re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "secret":
        return value.lower() if re.fullmatch(r"[0-9a-fA-F]+", value) else value
    if kind == "ip6":
        return str(ipaddress.IPv6Address(value))
    return value.lower() if kind == "email" else value


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of a canonical entity; another attempt draws another one."""
    tweak = f"{kind}\0{attempt}"
    more = max(0, attempt - 1)  # formats without a fixed length grow when theirs is crowded
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        if labels[-2:-1] != ["example"]:  # reserved domains belong to nobody
            labels[:-1] = [permute_text(key, "domain", x) for x in labels[:-1]]
        return permute_text(key, f"{tweak}\0{domain}", local + "0" * more) + "@" + ".".join(labels)
    if kind == "ip":
        number = int.from_bytes(bytes(map(int, value.split("."))), "big")
        return ".".join(map(str, permute(key, tweak, number, 1 << 32).to_bytes(4, "big")))
    if kind == "ip6":
        return str(ipaddress.IPv6Address(permute(key, tweak, int(ipaddress.IPv6Address(value)), 1 << 128)))
    if kind == "phone":
        code = (2 if value[1] in "17" else 3) if value[0] == "+" else 0  # the country code stays
        return value[:code] + permute_text(key, tweak, value[code:] + "0" * max(0, attempt - CROWDED))
    if kind == "card":
        valid, out = luhn(value), permute_text(key, tweak, value)
        while luhn(out) != valid:
            out = permute_text(key, tweak, out)
        return out
    if kind == "iban":
        out = permute_text(key, tweak + value[:2], value[4:])
        return f"{value[:2]}{98 - iban_rest(f'{value[:2]}00{out}'):02d}{out}"
    if kind == "secret":
        return permute_text(key, tweak, value, "0123456789abcdef" if re.fullmatch("[0-9a-f]+", value) else None)
    if kind == "ssn":
        return permute_text(key, tweak, value)
    return name_surrogate(key, kind, value, tweak, more)


def name_surrogate(key: bytes, kind: str, value: str, tweak: str, more: int = 0) -> str:
    """A name of the same script, vowels and consonants; given names end as their gender does."""
    script, gender, last = script_of(value), kind[-1], value[-1]
    stem, end = value, ""
    if kind == "family":
        # a Cyrillic family name in -a is the feminine form of the name without it
        if script == "cyrillic" and last == "а":
            stem, end = value[:-1], "а"
    elif (gender, script) in ENDINGS:
        own, extra = ENDINGS[gender, script]
        if last in own:
            stem, end = value[:-1], last
        elif gender == "f" or script == "greek" or _NAME_ALPHABET.get(last, "")[:1] in ("a", "а"):
            end, tweak = extra, tweak + "+"
    return permute_text(key, tweak, stem + _GROWTH.get(script, last) * more, table=_NAME_ALPHABET) + end


def entities(text: str) -> Iterator[tuple[int, int, str, str]]:
    """``(start, end, kind, canonical form)`` of every entity, in order of place."""
    places = [0] if any(t in text for t in _TITLE_WORDS) else None
    at = 0
    while at < len(text):
        if places is None:  # only lines with a digit, an @ or a quoted value can hold an entity
            hint = _DIGIT.search(text, at)
            if hint is None:
                return
            start = text.rfind("\n", at, hint.start()) + 1 or at
        else:
            start = at
        stop = text.find("\n", start if places else hint.start())
        stop = len(text) if stop < 0 else stop
        for m in _ENTITY.finditer(text, start, stop):
            kind = m.lastgroup
            if kind == "iban" and iban_rest(m["iban"].replace(" ", "")) != 1:
                continue
            if kind == "card" and is_isbn(m["card"]) or kind == "ip" and _VERSION.search(text, at, m.start()):
                continue
            if kind == "ip6":
                try:
                    ipaddress.IPv6Address(m["ip6"])
                except ValueError:
                    continue
                if len(re.findall(r"[0-9A-Fa-f]+", m["ip6"])) < 3 or not re.search(r"\d", m["ip6"]):
                    continue  # names joined by two colons
            if kind == "phone" and not 8 <= len(re.sub(r"\D", "", m["phone"])) <= 15:
                continue
            if kind != "name":
                yield m.start(kind), m.end(kind), kind, canonical(kind, m[kind])
                continue
            gender, parts, place = _GENDER[m["title"][:-1]], m["name"].split(" "), m.start("name")
            for k, word in enumerate(parts):
                given = len(parts) == 2 and k == 0
                yield place, place + len(word), f"given-{gender}" if given else "family", word.casefold()
                place += len(word) + 1
        at = stop + 1


def _fit(original: str, out: str, kind: str) -> str:
    """Write a canonical surrogate as the original was written: case and separators."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(out.lstrip("+"))
        return "".join([next(digits) if c.isdigit() else c for c in original]) + "".join(digits)
    if kind == "iban":
        chars = iter(out)
        return "".join(" " if c == " " else next(chars) for c in original)
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(original.ljust(len(out)), out, strict=True))
    if kind == "ip6":
        out = out if "::" in original else ":".join(f"{int(x, 16):x}" for x in ipaddress.IPv6Address(out).exploded.split(":"))
    if kind == "family" or kind[:5] == "given":
        out = re.sub("σ(?![^\\W\\d_])", "ς", out)
        if not original.isupper() or len(original) == 1:
            return "".join(n.upper() if o.isupper() else n for o, n in zip(original.ljust(len(out)), out))
    letters = [c for c in original if c.isalpha()]
    if letters and all(c.isupper() for c in letters) and (kind[:5] in ("given", "famil", "ip6") or _HEX.fullmatch(original)):
        return out.upper()
    return out


def replace(text: str, key: bytes, attempts: dict | None = None, known: dict | None = None) -> tuple[str, int]:
    """The text with all entities replaced, and how many there were."""
    out, at, n = [], 0, 0
    known = {} if known is None else known
    for start, stop, kind, value in entities(text):
        attempt = (attempts or {}).get(f"{kind}\0{value}", 0)
        new = known.get((kind, value, attempt))
        if new is None:
            new = known[kind, value, attempt] = surrogate(key, kind, value, attempt)
        out += [text[at:start], _fit(text[start:stop], new, kind)]
        at, n = stop, n + 1
    return ("".join([*out, text[at:]]), n) if n else (text, 0)


def find_entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct ``(kind, value)`` of the corpus, canonical forms."""
    def run(batches):
        for whole in batches:
            for part in text_steps(whole, text):
                found = {e[2:] for t in part.column(text).to_pylist() if t for e in entities(t)}
                if found:
                    kinds, values = zip(*sorted(found), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(values)], ["kind", "value"])

    return docs.select(text).mapInArrow(run, "kind string, value string").distinct()


def later_attempts(found: DataFrame, key: bytes) -> DataFrame:
    """Entities whose first surrogates collide: ``(kind, value, attempt)``; ``found`` must be a table."""
    def draw(attempt: int):
        def run(batches):
            for b in batches:
                kinds, values = b.column("kind").to_pylist(), b.column("value").to_pylist()
                new = [canonical_of(k, surrogate(key, k, v, attempt)) for k, v in zip(kinds, values, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("value"), pa.array(new, pa.string())],
                                                 ["kind", "value", "new"])
        return run

    def canonical_of(kind: str, value: str) -> str:
        return value.casefold() if kind[:5] in ("given", "famil") else canonical(kind, value)

    taken = None
    later = None
    pending = found
    for attempt in range(MOST):
        drawn = staged(pending.mapInArrow(draw(attempt), "kind string, value string, new string"), "drawn")
        entity = found.select("kind", F.col("value").alias("new"))
        # of several entities with one surrogate the first keeps it
        good = drawn.groupBy("kind", "new").agg(F.min("value").alias("value"))
        good = good.join(entity, ["kind", "new"], "left_anti")
        if taken is not None:
            good = good.join(taken, ["kind", "new"], "left_anti")
        good = staged(good.select("kind", "value", "new"), "surrogates")
        if attempt:
            step = good.select("kind", "value", F.lit(attempt).alias("attempt"))
            later = step if later is None else later.unionByName(step)
        pending = staged(drawn.join(good, ["kind", "value"], "left_anti").select("kind", "value"), "collided")
        if pending.isEmpty():
            return later
        held = good.select("kind", "new")
        taken = held if taken is None else taken.unionByName(held)
    raise RuntimeError("a format has too few free surrogates")


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with all entities of the text column replaced (and, if named, their number)."""
    found = staged(find_entities(docs, text), "entities")
    later = later_attempts(found, key)
    columns = [c for c in docs.columns if c != count]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns]).withColumn("__later", F.lit(None).cast("map<string,int>"))
    if later is not None:
        def holders(batches):
            for whole in batches:
                for part in text_steps(whole, "text"):
                    out = [(hashlib.sha256(t.encode()).hexdigest(), *k) for t in part.column("text").to_pylist() if t
                           for k in {e[2:] for e in entities(t)}]
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)],
                                                         ["__text", "kind", "value"])

        held = docs.select(F.col(text).alias("text")).mapInArrow(
            holders, "__text string, kind string, value string")
        entry = F.struct(F.concat_ws("\0", "kind", "value"), "attempt")
        # repeated texts give equal entries
        maps = staged(held.join(staged(later, "later"), ["kind", "value"]).groupBy("__text")
                      .agg(F.map_from_entries(F.collect_set(entry)).alias("__map")), "attempts")
        rows = (rows.withColumn("__text", F.sha2(F.col(text).cast("binary"), 256)).join(maps, "__text", "left")
                .withColumn("__later", F.col("__map")).drop("__text", "__map"))
    fields = [f for f in rows.schema.fields if f.name not in ("__later", text)]
    new = [StructField(text, StringType())] + ([StructField(count, IntegerType())] if count else [])

    def run(batches):
        known: dict = {}
        for whole in batches:
            for part in text_steps(whole, text):
                done = [(None, 0) if t is None else replace(t, key, dict(m or ()), known)
                        for t, m in zip(part.column(text).to_pylist(), part.column("__later").to_pylist(), strict=True)]
                if len(known) > 100_000:
                    known.clear()
                arrays = [part.column(f.name) for f in fields] + [pa.array([d[0] for d in done], pa.string())]
                if count:
                    arrays.append(pa.array([d[1] for d in done], pa.int32()))
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields + new])

    schema = type(rows.schema)(fields + new)
    return rows.mapInArrow(run, schema).select(*[F.col(f"`{c}`") for c in columns], *([count] if count else []))

"""Spelling variant grouping: words one edit apart, found by PartEnum signatures of letter multisets.

A word's letters are a multiset, that is a binary vector over (letter, how manieth of its kind). One replaced
code point changes two of its elements, one inserted or deleted code point a single one, so near words have vectors
at a Hamming distance of at most two. PartEnum deals the alphabet into parts and enumerates, for distance d, every
choice of all but d parts: vectors at distance d agree on at least one choice, so an equality join on signatures
loses no pair. Each signature also names the word length and the half of the word that the edit leaves whole (one edit
can't touch both halves) and takes its vector from the other half alone; this keeps buckets small without losing
pairs. What meets is verified by the edit distance inside the join, so only near pairs leave it.

All of it is built-in functions and joins: a word crosses the network with 12 signatures for replacements and 8 for
insertions, whatever the text behind it. Every join is a merge join: the tables grow with the vocabulary, and Spark sizes
them by compressed files, signatures even by the file of their words, so it would broadcast a dozen rows a word.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import staged

RUN = "([A-Za-z\\u00C0-\\u00FF]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: One run in so many loses a code point.
NOISE = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: Parts of the alphabet for replacements (distance two) and for insertions (distance one).
PARTS = {2: 4, 1: 2}


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)`` of all texts: lower-cased runs, some of them with a code point taken out.

    A run loses code point ``h % length`` when 97 divides h, the crc32 of ``<doc_id>:<run>`` (a null doc_id is empty).
    Runs are counted inside each task before words are shuffled.
    """
    run = F.col("__run")
    h = F.crc32(F.concat(F.coalesce(F.col("__id").cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    word = F.when(h % NOISE == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
                  ).otherwise(run)
    runs = docs.select(F.col("doc_id").alias("__id"), F.explode(
        F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(RUN))).alias("__run"))
    return (runs.where(F.length("__run") >= min_length).select(word.alias("word"))
            .where(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


def alphabet_parts(words: DataFrame, n_parts: int) -> list[str]:
    """The letters of all words dealt into parts of like weight, commonest first, to and fro.

    The driver gets one row a letter (at most 90 by the pattern of a run).
    """
    letters = (words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
               .orderBy(F.desc("count"), "letter").collect())
    parts = [""] * n_parts
    for i, row in enumerate(letters):
        lap, place = divmod(i, n_parts)
        parts[place if lap % 2 == 0 else n_parts - 1 - place] += row["letter"]
    return parts


def signatures(word: Column, length: Column, half: Column, parts: list[str], distance: int) -> Column:
    """Array of signatures; ``length`` and ``half`` (code points of the whole half) are those of the pair's shorter word.

    A signature is the xxhash64 of its key: keys that collide meet and are told apart by the edit distance.
    """
    found = []
    for side in (0, 1):
        whole = F.substring(word, F.lit(1), half) if side == 0 else F.right(word, half)
        other = F.substring(word, half + 1, F.length(word)) if side == 0 else F.left(word, F.length(word) - half)
        for choice, left_out in enumerate(combinations(parts, distance)):
            letters = F.translate(other, "".join(left_out), "")
            vector = F.array_join(F.array_sort(F.split(letters, "")), "")
            found.append(F.xxhash64(length, F.lit(side), F.lit(choice), whole, vector))
    return F.array(*found)


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, n_a, b, n_b)``: every two words of ``(word, n)`` one edit apart, once, in no stated order."""
    word, n = F.col("word"), F.length("word")
    replaced = alphabet_parts(words, PARTS[2])
    inserted = alphabet_parts(words, PARTS[1])

    def signed(length, half, parts, distance, side):
        return words.select(F.explode(signatures(word, length, half, parts, distance)).alias("signature"),
                            word.alias(side), F.col("n").alias(f"n_{side}"))

    # of l code points one is replaced: l - 1 stay, so a half of ceil((l - 1) / 2) is whole
    half = F.expr("length(word) div 2").cast("int")
    same = signed(n, half, replaced, 2, "a").join(signed(n, half, replaced, 2, "b").hint("merge"), "signature")
    # the l code points of the shorter word all stay, so a half of ceil(l / 2) is whole
    short = signed(n, F.expr("(length(word) + 1) div 2").cast("int"), inserted, 1, "a")
    long = signed(n - 1, F.expr("length(word) div 2").cast("int"), inserted, 1, "b")
    one_edit = F.levenshtein("a", "b", 1) == 1
    found = same.where((F.col("a") < F.col("b")) & one_edit).unionByName(
        short.join(long.hint("merge"), "signature").where(one_edit))
    return found.drop("signature").distinct()


def last_forms(forms: DataFrame) -> DataFrame:
    """``(word, form)`` -> ``(word, root)``: forms followed to the last by pointer jumping.

    A form has at least twice its word's count, so chains end, and each round halves what is left of them.
    """
    known = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = staged(known.join(ahead.hint("merge"), "root", "left")
                      .select("word", F.coalesce("ahead", "root").alias("root"),
                              F.col("ahead").isNotNull().alias("moved")), "roots")
        known = step.select("word", "root")
        if step.where("moved").isEmpty():
            return known


def group_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """One row for each word of ``docs(doc_id, text)``: ``word, n, n_near, form, form_n, root``.

    ``n_near`` words differ by exactly one inserted, deleted or replaced code point. ``form`` is the near word of
    the largest count (of equal ones the first in code-point order) if that is at least ``2 * n``, else null; ``root`` is
    the end of the chain of forms, the word itself if it has none.

    Defined cases: a null text has no words; a null doc_id hashes as the empty text; repeated rows count each
    time; other columns are not read, whatever their names. A table without words gives no rows.
    """
    words = staged(vocabulary(docs, min_length, min_count), "vocabulary")
    pairs = staged(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best"))
    rows = words.join(best.hint("merge"), "word", "left")
    has_form = -F.col("best.minus_n") >= 2 * F.col("n")
    rows = staged(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.near")).alias("form"),
        F.when(has_form, -F.col("best.minus_n")).alias("form_n")), "variants")
    roots = last_forms(rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(roots.hint("merge"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

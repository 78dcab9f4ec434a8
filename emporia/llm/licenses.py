"""Licence scan: Dice coefficient over word bigrams against licence templates.

Texts are normalised (lower case, runs of letters and digits) and compared with the
templates - notices (``TEMPLATES``, ``NOTICES``) and the full texts in
``license_texts`` - by ``2 |A n B| / (|A| + |B|)`` over their sets of word bigrams.
What is compared are a text's passages: the whole text, its lines, its paragraphs
(lines without a letter or digit are blank), its sentences, and every window of a
template's number of words (the whole text if that is shorter); for a template of
one sentence the windows within each sentence, since the end of a notice and the
begin of its repetition can look like another one. Two sets can only reach the
threshold t if neither is larger than (2 - t) / t times the other, so a passage is
held against the templates of its size only.

``dice`` is the best passage's. ``n_segments`` is the most passages of one kind
(text, lines, paragraphs, sentences, windows) that match one template of the
licence; windows that begin at neighbouring words are one.

To reach t a set must hold t / (2 - t) of the template's bigrams, so it holds one
of any larger share of them: only texts that hold one of a template's rarest
bigrams (``anchors``) are kept, and only held against the templates of which they
hold enough bigrams, which an equality join on the bigram counts. No match is lost by
this. The windows' sets are counted by a running sum: a bigram counts in the windows
that begin after its occurrence before.

Built-in functions only. Defined cases: null and empty texts match nothing; a
segment or template of one word has that word as its only item, and no windows;
ties keep all licences; segments of repeated rows are added up for their document;
a null id is an id like any other; other columns aren't read.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporia.llm.common import staged

THRESHOLD = 0.8
#: Texts that one task cuts into windows.
TEXTS_A_TASK = 1000

# Licence notices by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

# Further notices.
GNU = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU {}General "
       "Public License as published by the Free Software Foundation; either version {} of the License, or (at your "
       "option) any later version.")
NOTICES = [
    ("GPL-2.0", GNU.format("", "2")),
    ("LGPL-2.1", GNU.format("Lesser ", "2.1").replace("This program", "This library")),
    ("LGPL-3.0", GNU.format("Lesser ", "3")),
    ("AGPL-3.0", GNU.format("Affero ", "3")),
    ("AGPL-3.0", "Notwithstanding any other provision of this License, if you modify the Program, your modified version "
                 "must prominently offer all users interacting with it remotely through a computer network (if your "
                 "version supports such interaction) an opportunity to receive the Corresponding Source of your version "
                 "by providing access to the Corresponding Source from a network server at no charge, through some "
                 "standard or customary means of facilitating copying of software."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at"),
    ("EPL-2.0", "Licensed under the Eclipse Public License, Version 2.0."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
]

# The commonest words of English: bigrams of them are no anchors if there are others.
COMMON = frozenset("a all an and any are as at be by for from in is it its must not of on or such that the this to under "
                   "which with you your".split())


@cache
def passage_templates() -> tuple[tuple[str, str], ...]:
    """All templates for passages: the notices and the full texts by SPDX name."""
    texts = sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
    return (*TEMPLATES, *NOTICES, *((p.stem, p.read_text(encoding="utf-8")) for p in texts))


def template_items(text: str) -> list[str]:
    """The distinct word bigrams of a normalised text, in order; of one word that word."""
    w = re.findall(r"[^\W_]+", text.lower())
    pairs = [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)] if len(w) > 1 else w
    return list(dict.fromkeys(pairs))


def _several(template: str) -> bool:
    """Has a template more than one sentence?"""
    return bool(re.search(r"[.!?]\s+\w|\n\W*\n", template.strip()))


def size_bounds(size: int, threshold: float) -> list[int]:
    """Sizes of the sets that can reach the threshold with a set of this size."""
    return [k for k in range(1, int(size * 2 / threshold) + 2) if 2 * min(k, size) >= threshold * (k + size)]


def anchors(own: list[str], threshold: float) -> list[str]:
    """So many of a template's items, the rarest, that every set which reaches the threshold holds one."""
    least = size_bounds(len(own), threshold)[0]
    return sorted(own, key=lambda p: (sum(w in COMMON for w in p.split()), -len(p)))[:len(own) - least + 1]


# Ends of paragraphs (lines without a letter or digit are blank) and of sentences.
BLANK = r"\n[^\p{L}\p{N}]*\n"
SENTENCE = BLANK + r"|(?<=[.!?])\s+|(?<=[\u3002\uff01\uff1f])"


def passages(text: Column) -> Column:
    """Four arrays: the whole text, its lines, its paragraphs and their sentences."""
    return F.array(F.array(text), F.split(text, "\n"), F.split(text, BLANK), F.split(text, SENTENCE))


def words(segment: Column) -> Column:
    """The words of a normalised segment."""
    return F.filter(F.split(F.regexp_replace(F.lower(segment), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")


def pairs(w: Column) -> Column:
    """The bigrams of an array of words, in order and with repeats; of one word that word."""
    n = F.size(w)
    both = F.zip_with(F.slice(w, 1, n - 1), F.slice(w, 2, n - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(n > 1, both).otherwise(w)


def bigrams(segment: Column) -> Column:
    """The distinct word bigrams of a normalised segment; of one word that word."""
    # the one-element array binds the words, so that they are computed once however often they are used
    return F.transform(F.array(words(segment)), lambda w: F.array_distinct(pairs(w)))[0]


def _constant(items: list[str]) -> Column:
    """A constant array of normalised items."""
    return F.split(F.lit("\n".join(items)), "\n")


def _candidates(hot: DataFrame, known: DataFrame, items: DataFrame) -> DataFrame:
    """The kept texts with each template of which they hold enough bigrams.

    ``items`` and ``known`` are the fixed templates, so their broadcasts don't grow with the data.
    """
    enough = (hot.select("row", F.explode("held").alias("gram")).join(F.broadcast(items), "gram")
              .groupBy("row", "t").agg(F.count(F.lit(1)).alias("n_held"))
              .join(F.broadcast(known.select("t", "least")), "t").where("n_held >= least")
              .groupBy("row").agg(F.collect_list("t").alias("ts")))
    return (hot.drop("held").join(enough, "row").withColumn("t", F.explode("ts")).drop("ts")
            .join(F.broadcast(known), "t"))


def _passages(hot: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """``(doc_id, license, dice, n)`` of each kept text: the best passage and the most matches of one kind."""
    items = known.select("t", F.explode("own").alias("gram"))
    known = known.withColumn("n_own", F.size("own"))
    # a task for so many texts: windows are far more work than their bytes say
    tasks = max(8, hot.count() // TEXTS_A_TASK + 1)
    here = staged(_candidates(hot, known, items).drop("own").repartition(tasks, "row", "t"), "licenses")
    here = here.join(F.broadcast(known.select("t", "own")), "t")
    items = items.withColumn("own", F.lit(1))

    def dice(shared, size):
        return shared * 2.0 / (size + F.col("n_own"))

    def matches(kind):
        near = F.filter(F.transform(kind, bigrams), lambda g: F.size(g).between(F.col("least"), F.col("most")))
        return F.filter(F.transform(near, lambda g: dice(F.size(F.array_intersect(g, F.col("own"))), F.size(g))),
                        lambda d: d >= threshold)

    scores = F.filter(F.transform(passages(F.col("text")), matches), lambda d: F.size(d) > 0)
    whole = (here.select("row", "doc_id", "license", F.explode(F.array(scores)).alias("scores"))
             .where(F.size("scores") > 0)
             .select("row", "doc_id", "license", F.array_max(F.flatten("scores")).alias("dice"),
                     F.array_max(F.transform("scores", lambda d: F.size(d))).alias("n")))

    # bigram i counts in the windows that begin after its occurrence before and hold i
    units = F.when(F.col("several"), F.array("text")).otherwise(F.split("text", SENTENCE))
    grams = F.filter(F.transform(units, lambda u: F.transform(F.array(words(u)), pairs)[0]),
                     lambda g: F.size(F.array_intersect(g, "own")) >= F.col("least"))
    unit, keys = ["row", "t", "unit"], ["row", "t", "unit", "doc_id", "license", "n_own", "last"]
    at = Window.partitionBy(*unit, "gram").orderBy("i")
    held = (here.where(F.col("n_words") > 1)
            .select("row", "t", "doc_id", "license", "n_own", "n_words", F.posexplode(grams).alias("unit", "grams"))
            .withColumn("wide", F.least(F.col("n_words") - 1, F.size("grams")))
            .withColumn("last", F.size("grams") - F.col("wide"))
            .select(*keys, "wide", F.posexplode("grams").alias("i", "gram"))
            .join(F.broadcast(items), ["t", "gram"], "left")
            .repartition(tasks, "row", "t")
            .withColumn("before", F.coalesce(F.lag("i").over(at), F.lit(-1)))
            .withColumn("low", F.greatest(F.col("before") + 1, F.col("i") - F.col("wide") + 1))
            .withColumn("high", F.least("i", "last")).where("low <= high"))
    own = F.coalesce("own", F.lit(0))
    steps = (held.select(*keys, F.explode(F.array(
        F.struct(F.col("low").alias("at"), F.lit(1).alias("size"), own.alias("shared")),
        F.struct((F.col("high") + 1).alias("at"), F.lit(-1).alias("size"), (-own).alias("shared")))).alias("s"))
        .groupBy(*keys, F.col("s.at").alias("at"))
        .agg(F.sum("s.size").alias("size"), F.sum("s.shared").alias("shared")))
    run = Window.partitionBy(*unit).orderBy("at")
    so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    windows = (steps.withColumn("dice", dice(F.sum("shared").over(so_far), F.sum("size").over(so_far)))
               .where("at <= last")
               .withColumn("first", ~F.coalesce(F.lag("dice").over(run) >= threshold, F.lit(False)))
               .where(F.col("dice") >= threshold)
               .groupBy("row", "t", "doc_id", "license")
               .agg(F.max("dice").alias("dice"), F.sum(F.col("first").cast("int")).alias("n")))
    return (whole.withColumn("n", F.col("n").cast("bigint"))
            .unionByName(windows.select("row", "doc_id", "license", "dice", "n"))
            .groupBy("row", "doc_id", "license").agg(F.max("dice").alias("dice"), F.max("n").alias("n")).drop("row"))


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD, templates=None, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """``(doc_id, license, dice, n_segments)``: the best passage and the number of matching ones (see the module).

    ``templates`` replaces the notices and the full texts.
    """
    rows = []
    for t, (name, body) in enumerate(passage_templates() if templates is None else templates):
        if own := template_items(body):
            sizes = size_bounds(len(own), threshold)
            n_words = len(re.findall(r"[^\W_]+", body))
            rows.append((t, name, own, n_words, _several(body), sizes[0], sizes[-1]))
    known = docs.sparkSession.createDataFrame(
        rows, "t int, license string, own array<string>, n_words int, several boolean, least int, most int")
    every = sorted({p for r in rows for p in r[2]})
    some = sorted({p for r in rows for p in anchors(r[2], threshold)})
    one_word = any(r[3] == 1 for r in rows)

    def items(w):
        return F.concat(w, pairs(w)) if one_word else pairs(w)

    # texts without an anchor leave within the generator, so that their items are computed once
    held = F.transform(F.array(words(F.col(text))), lambda w: F.array_distinct(items(w)))
    held = F.filter(held, lambda g: F.arrays_overlap(g, _constant(some)))
    hot = (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.explode(held).alias("held"))
           .withColumn("held", F.array_intersect("held", _constant(every)))
           .withColumn("row", F.monotonically_increasing_id()))
    hot = staged(hot, "licenses")
    return (_passages(hot, known, threshold).groupBy("doc_id", "license")
            .agg(F.max("dice").alias("dice"), F.sum("n").alias("n_segments")))


def scan_sql(threshold: float = THRESHOLD) -> str:
    """The same result in DuckDB SQL over ``documents``: every passage and window written out and compared."""
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    rows = [(t, name, body, len(re.findall(r"[^\W_]+", body)), str(_several(body)).lower())
            for t, (name, body) in enumerate(passage_templates())]
    values = ", ".join(f"({t}, {quoted(name)}, {quoted(body)}, {n}, {several})" for t, name, body, n, several in rows)

    def normal(column: str) -> str:
        return (f"list_filter(string_split(regexp_replace(lower({column}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), "
                "lambda w: w <> '')")

    def grams(w: str) -> str:
        return (f"list_distinct(case when len({w}) > 1 then list_transform(range(1, len({w})), "
                f"lambda i: {w}[i] || ' ' || {w}[i + 1]) else {w} end)")

    blank = "regexp_replace(text, '\\n[^\\p{L}\\p{N}]*\\n', chr(1), 'g')"
    ends = (f"regexp_replace(regexp_replace({blank}, '([.!?])[ \\t\\n\\x0B\\f\\r]+', '\\1' || chr(1), 'g'), "
            "'([\u3002\uff01\uff1f])', '\\1' || chr(1), 'g')")
    return f"""
with templates as materialized (
  select t, license, {grams('w')} as own, n_words, several
  from (select t, license, n_words, several, {normal('body')} as w
        from (values {values}) v(t, license, body, n_words, several))),
docs as materialized (
  select row_number() over () as r, doc_id, replace(text, chr(1), ' ') as text from documents where text is not null),
held as (select r, {grams('w')} as held from (select r, {normal('text')} as w from docs)),
here as materialized (
  select r, t from (select r, unnest(held) as gram from held) join (select t, len(own) as n, unnest(own) as gram
  from templates) using (gram) group by r, t, n having count(*) >= n * {threshold / (2 - threshold) - 1e-9}),
cut as (
  select r, doc_id, 'text' as kind, text as passage from docs
  union all select r, doc_id, 'line', unnest(string_split(text, chr(10))) from docs
  union all select r, doc_id, 'paragraph', unnest(string_split({blank}, chr(1))) from docs
  union all select r, doc_id, 'sentence', unnest(string_split({ends}, chr(1))) from docs),
hot as materialized (
  select r, doc_id, kind, row_number() over () as unit, {normal('passage')} as w from cut where r in (select r from here)),
segments as (
  select r, doc_id, t, kind, 2.0::double * len(list_intersect({grams('w')}, own)) / (len({grams('w')}) + len(own)) as dice,
    1 as first from hot join here using (r) join templates using (t) where len(w) > 0),
starts as (
  select *, unnest(range(1, greatest(2, len(w) - n_words + 2))) as i from hot join here using (r) join templates using (t)
  where kind = case when several then 'text' else 'sentence' end and n_words > 1 and len(w) > 1
   and len(list_intersect({grams('w')}, own)) >= len(own) * {threshold / (2 - threshold) - 1e-9}),
windows as (
  select r, doc_id, t, unit, i, 2.0::double * len(list_intersect(g, own)) / (len(g) + len(own)) as dice
  from (select *, {grams('part')} as g from (select *, list_slice(w, i, i + n_words - 1) as part from starts))),
runs as (
  select r, doc_id, t, 'window' as kind, dice,
    (coalesce(lag(dice) over (partition by r, t, unit order by i), 0) < {threshold})::int as first from windows),
found as (
  select r, doc_id, license, t, kind, max(dice) as dice, sum(first) as n
  from (select * from segments union all select * from runs) join templates using (t)
  where dice >= {threshold} group by r, doc_id, license, t, kind),
best as (select r, doc_id, license, max(dice) as dice, max(n) as n from found group by r, doc_id, license)
select doc_id, license, max(dice) as dice, sum(n)::bigint as n_segments from best group by doc_id, license"""

import random
import re

import duckdb
import pandas as pd

from emporia.llm import common
from emporia.llm import licenses as L
from emporia.plans.oracle_check import compare


def held_against_sql(spark, rows):
    """The result and its SQL, which writes out every passage and window of the same rows."""
    con = duckdb.connect()
    con.register("rows", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.sql("CREATE VIEW documents AS SELECT * FROM rows")
    found = L.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    result = compare(found, con, L.scan_sql())
    assert result["ok"], result
    return {(r.doc_id, r.license): (r.dice, r.n_segments) for r in found.collect()}


def test_against_sql(spark):
    half = L.TEMPLATES[2][1].split()
    rows = [(1, "Some text.\nReleased under the MIT License.\nMore."), (2, "RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!"),
            (3, L.TEMPLATES[2][1]), (4, "x\n\n" + " ".join(half[:30]) + "\n" + " ".join(half[30:]) + "\n\ny"),
            (5, " ".join(half[:20])), (6, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."),
            (7, "Licensed under the Apache License, Version 2.0 today."), (8, None), (9, ""), (10, "License"),
            (None, "Licensed under CC BY 4.0."), (1, "Released under the MIT License."),
            (11, "the the the the MIT license " * 40), (12, "Licensed under the Apache Licence of the MIT."),
            (13, "See the file LICENSE. Released under the MIT License. Thanks to all.")]
    got = held_against_sql(spark, rows)
    assert got[1, "MIT"] == (1.0, 2) and got[6, "CC-BY-NC-4.0"] == (1.0, 2) and got[13, "MIT"] == (1.0, 1)
    assert {k for k, _ in got} == {1, 2, 3, 4, 6, 7, 13, None}


def test_notices_in_all_places_against_sql(spark):
    """Notices and full texts with changed words, within lines, over lines, in comment blocks, one after another."""
    rng = random.Random(1)
    known = [t for _, t in L.passage_templates()]
    rows = []
    for i in range(100):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            w = [rng.choice(["foo", "bar.", "the", "license", "mit!", "x"]) for _ in range(rng.randrange(1, 30))]
            if rng.random() < 0.4:
                w = rng.choice(known if rng.random() < 0.2 else known[:-13]).split()
                for _ in range(rng.randrange(3)):
                    w[rng.randrange(len(w))] = rng.choice(["x", "the", "license"])
            parts.append(rng.choice([" ", " ", "\n", "\n# "]).join(w))
        rows.append((rng.choice([None, i, i // 2]), rng.choice(["\n", " ", "\n\n", ". ", "\n#\n", "。"]).join(parts)))
    assert len(held_against_sql(spark, rows)) > 50


def test_size_bounds_lose_nothing():
    for size in range(1, 60):
        ok = L.size_bounds(size, 0.8)
        assert ok == [k for k in range(1, 400) if 2 * min(k, size) / (k + size) >= 0.8]


def test_plans_are_native_and_join_on_keys(spark, monkeypatch):
    """Of the last query and of each table that is written before it."""
    seen = []

    def staged(df, name):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return common.staged(df, name)

    monkeypatch.setattr(L, "staged", staged)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen.append(L.scan_licenses(df)._jdf.queryExecution().executedPlan().toString())
    assert len(seen) == 3
    for plan in seen:
        for node in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"):
            assert node not in plan, node
    assert "BroadcastHashJoin" in seen[1]


def test_defined_cases(spark, odd_docs, no_docs):
    assert L.scan_licenses(odd_docs).count() == 0
    assert L.scan_licenses(no_docs).count() == 0
    assert L.scan_licenses(odd_docs, templates=[("none", "..."), ("one", "A")]).first().doc_id == 5


def test_query_against_its_sql(spark, duck):
    from emporia.llm.queries import ORACLE, QUERIES

    result = compare(QUERIES["op4_licenses"](spark, "/root/testdata/sf0.001"), duck, ORACLE["op4_licenses"])
    assert result["ok"] and result["spark_rows"] > 0, result


def brute_windows(text, template):
    """Best Dice over every window of the template's words, and the runs of neighbouring windows that match."""
    w, k = re.findall(r"[^\W_]+", text.lower()), len(re.findall(r"[^\W_]+", template))
    own = set(L.template_items(template))
    dices = []
    for i in range(max(1, len(w) - k + 1)):
        g = {f"{a} {b}" for a, b in zip(w[i:i + k], w[i + 1:i + k], strict=False)}
        dices.append(2 * len(g & own) / (len(g) + len(own)))
    ok = [d >= L.THRESHOLD for d in dices]
    return max(dices), sum(a and not b for a, b in zip(ok, [False, *ok], strict=False))


def _body(name):
    return next(t for n, t in reversed(L.passage_templates()) if n == name)


def test_notices_within_other_words(spark):
    gpl = next(t for n, t in L.TEMPLATES if n == "GPL-3.0" and "redistribute" in t).split()
    block = "\n".join(["# Copyright 2020 A. Person and others, all of them", "#", "# " + " ".join(gpl[:18]),
                       "# " + " ".join(gpl[18:36]), "# " + " ".join(gpl[36:]), "#", "# Some more words on this program: " + "it does this and that, " * 8,
                       "import os"])
    rows = [(1, "Released under the MIT License. See LICENSE for details."), (2, " ".join(_body("MIT").split())), (3, block),
            (4, "A tool. This project is licensed under the MIT license. It does many things and more."),
            (5, "We, the authors,\nreleased this, not\nunder a license of MIT."), (6, _body("BSD-2-Clause")),
            (7, _body("ISC")), (8, "Words before it.\n" + _body("EPL-2.0") + "\nand after it"),
            (9, _body("GPL-3.0")), (10, _body("Apache-2.0") + "Something else. " * 800 + _body("Apache-2.0")),
            (1, "Released under the MIT License. See LICENSE for details.")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.license): (r.dice, r.n_segments) for r in L.scan_licenses(df).collect()}
    assert got[1, "MIT"] == (1.0, 2) and got[2, "MIT"][0] == 1.0 and got[3, "GPL-3.0"][0] == 1.0
    assert got[4, "MIT"][0] >= 0.8 and 5 not in {k for k, _ in got}
    assert got[6, "BSD-2-Clause"][0] == got[7, "ISC"][0] == got[8, "EPL-2.0"][0] == 1.0
    assert got[9, "GPL-3.0"][0] == 1.0 and got[10, "Apache-2.0"] == (1.0, 2)


def test_windows_against_brute_force(spark):
    rng = random.Random(3)
    template = "a b c d e a b f g h i j k l m n o p"
    rows = []
    for i in range(150):
        w = [rng.choice("abcdefxyz") for _ in range(rng.randrange(5, 60))]
        for _ in range(rng.randrange(3)):
            own = template.split()
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice("abcxyz")
            at = rng.randrange(len(w))
            w[at:at] = own
        rows.append((i, "x " + " ".join(w) + " y"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.dice, r.n_segments) for r in L.scan_licenses(df, templates=[("T", template)]).collect()}
    want = {i: brute_windows(text, template) for i, text in rows}
    # the text, its line, its paragraph and its sentence are one passage here
    own = set(L.template_items(template))
    whole = {i: 2 * len(own & (g := set(L.template_items(t)))) / (len(own) + len(g)) for i, t in rows}
    want = {i: (max(d, whole[i]), max(n, int(whole[i] >= L.THRESHOLD))) for i, (d, n) in want.items()}
    assert got == {i: w for i, w in want.items() if w[0] >= L.THRESHOLD} and len(got) > 20

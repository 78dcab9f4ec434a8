"""Inferred schemas against a plain walk of the lines."""

import json
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from emporia.sources import infer

DECLARED = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                         T.StructField("score", T.DoubleType()), T.StructField("gone", T.StringType())])


def lines_of(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string").repartition(5)


def mixed_lines(n=500, seed=3):
    rng, out = random.Random(seed), []
    for i in range(n):
        row = {"id": i if i % 9 else f"id-{i}", "name": rng.choice([None, "a", "b", 7])}
        if i % 3:
            row["score"] = rng.choice([1, 2, 2.5e300])
        if i % 5 == 0:
            row["extra.field"] = {"p": i} if i % 2 else {"q": "x", "p": None}
        out.append(json.dumps(row) if i % 50 else rng.choice(["{", "[1, 2]", "17", '{"a": 1, "a": 2}']))
    return out + ["", "  ", None, "{}"]


def plain(lines):
    present, nulls, kinds, bad = Counter(), Counter(), defaultdict(set), 0
    name = {int: "BIGINT", float: "DOUBLE", str: "STRING", dict: "OBJECT", bool: "BOOLEAN", list: "ARRAY"}
    for line in lines:
        if line is None or not line.strip():
            continue
        try:
            pairs = json.loads(line, object_pairs_hook=lambda p: ("o", p))
        except ValueError:
            pairs = None
        if not (isinstance(pairs, tuple) and len(dict(pairs[1])) == len(pairs[1])):
            bad += 1
            continue
        for k, v in pairs[1]:
            v = dict(v[1]) if isinstance(v, tuple) else v
            present[k] += 1
            nulls[k] += v is None
            kinds[k] |= set() if v is None else {name[type(v)]}
    return present, nulls, kinds, bad


def test_report_equals_a_plain_walk(spark):
    lines = mixed_lines()
    rows = {r.field: r for r in infer.json_report(lines_of(spark, lines), DECLARED).collect()}
    present, nulls, kinds, bad = plain(lines)
    assert set(rows) == set(present) | {"gone", None}
    for k in present:
        assert (rows[k].present, rows[k].nulls, rows[k].types) == (present[k], nulls[k], ",".join(sorted(kinds[k]))), k
    assert rows[None].present == bad and rows[None].drift == "malformed"
    assert rows["id"].inferred == "VARIANT" and rows["id"].drift == "unreadable"
    assert rows["id"].unreadable == sum('"id-' in (x or "") for x in lines)
    assert rows["name"].inferred == "VARIANT" and rows["name"].drift == "mixed" and rows["name"].unreadable == 0
    assert rows["score"].inferred == "DOUBLE" and rows["score"].drift == "ok"
    assert rows["extra.field"].inferred == "OBJECT<p: BIGINT, q: STRING>" and rows["extra.field"].drift == "unexpected"
    assert rows["gone"].drift == "missing" and rows["gone"].present == 0 and rows["gone"].inferred is None


def test_widened_columns_lose_nothing(spark):
    lines = mixed_lines()
    df = lines_of(spark, lines)
    fields = infer.inferred_fields(infer.json_report(df, DECLARED))
    assert fields == {"id": "string", "name": "string", "score": "DOUBLE", "extra.field": "STRUCT<p: BIGINT, q: STRING>"}
    got = infer.read_widened(df, fields).collect()
    want = []
    for line in lines:
        if line and line.strip() and line[:1] == "{" and len(line) > 1 and '"a": 2' not in line:
            d = json.loads(line)
            text = {k: None if d.get(k) is None else str(d[k]) for k in ("id", "name")}
            x = d.get("extra.field")
            want.append((text["id"], text["name"], d.get("score"), None if x is None else (x.get("p"), x.get("q"))))
    assert Counter(repr((r.id, r.name, r.score, r["extra.field"] and tuple(r["extra.field"]))) for r in got) == Counter(
        repr((a, b, None if c is None else float(c), x)) for a, b, c, x in want)


def test_defined_cases(spark, monkeypatch):
    none = infer.json_report(spark.createDataFrame([], "value string"), DECLARED).collect()
    assert {(r.field, r.drift) for r in none} == {(f.name, "missing") for f in DECLARED}
    odd = {r.field: r for r in infer.json_report(lines_of(spark, [
        '{"a b": null, "é\\"": 1, "n": 1}', '{"a b": null, "n": 2.5, "l": [1, "x"], "key": 1, "value": 2}']), T.StructType([])).collect()}
    assert odd["a b"].inferred == "VOID" and odd["n"].types == "BIGINT,DECIMAL" and odd["l"].inferred == "ARRAY<VARIANT>"
    fields = infer.inferred_fields(infer.json_report(lines_of(spark, ['{"é\\"": 1, "it\'s": "x", "a b": null}']), T.StructType([])))
    row = infer.read_widened(lines_of(spark, ['{"é\\"": 1, "it\'s": "x", "a b": null}']), fields).first()
    assert row['é"'] == 1 and row["it's"] == "x" and row["a b"] is None
    monkeypatch.setattr(infer, "MOST_FIELDS", 2)
    with pytest.raises(ValueError, match="more than 2 fields"):
        infer.inferred_fields(infer.json_report(lines_of(spark, ['{"a": 1, "b": 1, "c": 1}']), T.StructType([])))


def test_one_field_in_every_line_is_merged_before_the_shuffle(spark):
    df = infer.json_report(lines_of(spark, mixed_lines(50)), DECLARED)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_schema_of_variant_agg" in plan and "Python" not in plan.replace("PythonRDD", "")


def test_csv_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,when,share,flag,mess,empty\n1,2024-01-02 03:04:05,0.5,true,3,\n'
                                    '2,,7,false,"x, ""y""\nz",\n,2024-01-02 00:00:00,1e3,true,,\n')
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("mess", T.LongType()),
                             T.StructField("gone", T.StringType())])
    rows = {r.field: r for r in infer.csv_report(spark, str(tmp_path), declared).collect()}
    assert {k: r.inferred for k, r in rows.items()} == {
        "id": "bigint", "when": "timestamp_ntz", "share": "double", "flag": "boolean", "mess": "string", "empty": "string",
        "gone": None}
    assert (rows["id"].present, rows["id"].nulls, rows["id"].drift) == (3, 1, "ok")
    assert (rows["mess"].unreadable, rows["mess"].drift) == (1, "unreadable")
    assert rows["gone"].drift == "missing" and rows["flag"].drift == "unexpected"

import numpy as np
import pytest

from emporia.llm import language as L

TEXTS = {"aa": "bado keli mura tane bado sifu", "bb": "xarth grunk vlox yrtz grunk mnorb", "cc": "ζωη μερα νυχτα φως γη"}


def _docs(spark):
    rows = [(k, f"{t} {t[k % 9:]} {t[:k % 13]}", lang) for k, (lang, t) in enumerate(list(TEXTS.items()) * 60)]
    return spark.createDataFrame(rows + [(None, "xarth", "bb"), (900, None, "aa"), (901, "bado", None)],
                                 "doc_id bigint, text string, lang string")


def test_predicts_all_rows(spark):
    docs = _docs(spark)
    rows = L.predict_language(docs, L.fit_language(docs)).collect()
    assert len(rows) == 183
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.lang_pred == ("und" if r.text is None else r.lang or "aa")


def test_kernel_against_sets():
    a, b = "Abra cadabra, abra!", "cadaver bracket"
    grams = L.Grams(sorted(set("abracdvekt")))

    def sets(t):
        t = " " + "".join(c if c.isalpha() else " " for c in t.lower()) + " "
        t = " ".join([""] + t.split() + [""])
        return [{t[k:k + n] for k in range(len(t) - n + 1)} - ({" "} if n == 1 else set()) for n in (1, 2, 3)]

    assert [len(g) for g in grams.distinct(a)] == [len(s) for s in sets(a)]
    m = L.LanguageModel(["x"], [a, b])
    want = [[sum(len(p & q) / np.sqrt(len(p) * len(q)) for p, q in zip(sets(u), sets(v), strict=True)) / 3
             for v in (a, b)] for u in (a, b)]
    assert np.allclose(m.kernel([a, b])[0], want, atol=1e-5)


def test_large_alphabets_use_the_same_kernel():
    texts = ["".join(chr(0x4E00 + (k * 37 + s * 311) % 2003) for k in range(300)) for s in range(4)]
    m = L.LanguageModel(["x"], texts)
    assert 2 not in m._column and np.allclose(np.diag(m.kernel(texts)[0]), 1, atol=1e-5)


def test_held_out_rows_teach_nothing(spark):
    docs = _docs(spark)
    from emporia.llm.common import bucket
    changed = docs.withColumn("lang", __import__("pyspark.sql.functions", fromlist=["when"]).when(
        bucket("doc_id", 4) == 2, "zz").otherwise(docs.lang))
    assert L.fit_language(changed).languages == ["aa", "bb", "cc"]


def test_defined_cases(spark, odd_docs, no_docs):
    model = L.fit_language(_docs(spark))
    out = L.predict_language(odd_docs, model)
    rows = out.collect()
    assert len(rows) == 12 and sorted(out.columns) == sorted(odd_docs.columns)
    for r in rows:
        assert (r.lang_pred == "und" and r.score == 0) == (not any(c.isalpha() for c in r.text or ""))
    assert L.predict_language(no_docs, model).count() == 0
    blank = L.fit_language(_docs(spark).where("false"))
    assert {r.lang_pred for r in L.predict_language(odd_docs, blank).collect()} == {"und"}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, sf):
    from emporia.llm.queries import QUERIES
    rows = QUERIES["op1_language"](spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98


def test_a_language_of_long_texts_is_learned(spark):
    """All texts of one class are longer than the bound of the fit."""
    rows = [(i, "de", "der hund und die katze sind nicht im haus gewesen " * 2) for i in range(200)]
    rows += [(1000 + i, "en", "the dog and the cat were not inside of the house " * 190) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = L.fit_language(df)
    assert model.languages == ["de", "en"]
    found = L.predict_language(df, model)
    assert found.where("lang = lang_pred").count() == 400


def test_no_language_is_brought_together_in_one_task(spark, monkeypatch):
    """Even where nothing is small enough to be broadcast by its size, ids meet the counts without a shuffle."""
    seen = []
    df = spark.createDataFrame([(i, "xy"[i % 2], "some words") for i in range(50)], "doc_id bigint, lang string, text string")
    real = type(df).collect

    def collect(frame):
        seen.append(frame._jdf.queryExecution().executedPlan().toString())
        return real(frame)

    monkeypatch.setattr(type(df), "collect", collect)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        L.fit_language(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen and "SortMergeJoin" not in "".join(seen)

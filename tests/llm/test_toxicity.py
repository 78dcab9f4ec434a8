import numpy as np

from emporia.llm import toxicity as T

CLEAN = "the garden was quiet and the rain fell on the old stone wall "
VILE = "vermin"


def _tables(spark):
    docs = [(k, CLEAN * (1 + k % 3) + (VILE + " filth ") * (k % 4) + str(k)) for k in range(160)]
    labels = [(k, int(k % 4 > 0)) for k in range(160)] + [(None, 1), (3, None), (999, 0), (5, 0)]
    return (spark.createDataFrame(docs, "doc_id bigint, text string"),
            spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_severity_grows_with_the_grade(spark):
    docs, labels = _tables(spark)
    model = T.fit_toxicity(docs, labels)
    rows = T.score_toxicity(docs, model).collect()
    assert len(rows) == 160 and all(r.toxic == (r.doc_id % 4 > 0) for r in rows)
    mean = [np.mean([r.severity for r in rows if r.doc_id % 4 == k]) for k in range(4)]
    assert mean == sorted(mean) and mean[3] > mean[1] + 0.5 and mean[0] < 0.2
    assert (np.diff(model.thresholds) >= 0).all()


def test_one_weight_vector_for_all_thresholds(spark):
    docs, labels = _tables(spark)
    model = T.fit_toxicity(docs, labels)
    logit = lambda p: np.log(p / (1 - p))
    a, b = (logit(model.exceed(CLEAN + t)) for t in ("vermin", "vermin filth vermin"))
    assert np.allclose(a - b, (a - b)[0], atol=1e-4)


def test_graded_labels_are_used_as_they_are(spark):
    docs, _ = _tables(spark)
    graded = spark.createDataFrame([(k, k % 4) for k in range(160)], "doc_id bigint, toxic int")
    rows = T.score_toxicity(docs, T.fit_toxicity(docs, graded, graded=True)).collect()
    assert np.mean([r.grade == r.doc_id % 4 for r in rows]) > 0.9


def test_long_clean_text_stays_clean(spark):
    docs, labels = _tables(spark)
    model = T.fit_toxicity(docs, labels)
    assert model.exceed(CLEAN * 20_000)[0] < 0.1 and model.exceed(CLEAN * 2_000 + VILE)[0] > 0.5


def test_defined_cases(spark, odd_docs, no_docs):
    docs, labels = _tables(spark)
    model = T.fit_toxicity(docs, labels)
    out = T.score_toxicity(odd_docs, model)
    rows = out.collect()
    assert len(rows) == 12 and sorted(out.columns) == sorted({*odd_docs.columns, "grade"})
    assert not any(r.toxic for r in rows) and len({r.severity for r in rows if not r.text}) == 1
    assert T.score_toxicity(no_docs, model).count() == 0
    blank = T.fit_toxicity(docs, labels.where("false"))
    assert {r.severity for r in T.score_toxicity(odd_docs, blank).collect()} == {0.0}


def test_classes_of_long_texts_are_learned(spark):
    """All texts are longer than the bound of the fit, and the classes are still told apart."""
    rows = [(i, ("vile hateful rubbish " if i % 2 else "kind gentle letters ") * 700) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id bigint, toxic int")
    found = T.score_toxicity(docs, T.fit_toxicity(docs, labels))
    assert found.where("toxic = (doc_id % 2 = 1)").count() == 120

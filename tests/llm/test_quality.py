import numpy as np
import pyarrow as pa

from emporia.llm import quality as Q

GOOD = "The river bends slowly past the old mill and the children walk home in the evening light. "
BAD = "WIN!! CASH!! NOW!! $$$ ### CLICK!! HERE!! %%% FREE!! "


def _tables(spark):
    docs = [(k, (GOOD if k % 2 else BAD) * (1 + k % 4) + str(k)) for k in range(120)]
    labels = [(k, k % 2) for k in range(120)] + [(None, 1), (3, None), (500, 1)]
    return (spark.createDataFrame(docs, "doc_id bigint, text string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int"))


def test_learns_the_labels_and_scores_held_out_rows(spark):
    docs, labels = _tables(spark)
    rows = Q.score_quality(docs, Q.fit_quality(docs, labels)).collect()
    assert len(rows) == 120
    assert all(r.predicted == r.doc_id % 2 and 0 <= r.score <= 1 for r in rows)


def test_attention_weights_are_shares_and_gradients_hold():
    m, texts = Q.Model(), pa.array([GOOD * 20, BAD, GOOD + BAD * 9])
    x, first = Q.encode_passages(texts)
    _, a = m.forward(x, first)
    assert np.allclose(np.add.reduceat(a, first[:-1]), 1)
    target, weight = np.array([1.0, 0, 1]), np.array([0.3, 0.2, 0.5])

    def loss():
        y, _ = m.forward(x, first)
        return -(weight * (target * np.log(y) + (1 - target) * np.log(1 - y))).sum()

    y, kept = m.forward(x, first, keep=True)
    grad = m.gradients(y, kept, first, target, weight)
    for name in m.p:
        flat = m.p[name].reshape(-1)
        at = len(flat) // 2
        was, step = flat[at], 1e-5
        flat[at] = was + step
        up = loss()
        flat[at] = was - step
        down = loss()
        flat[at] = was
        assert np.isclose(grad[name].reshape(-1)[at], (up - down) / (2 * step), rtol=1e-3, atol=1e-7), name


def test_passages_do_not_depend_on_the_batch():
    texts = [GOOD * 9, "", BAD, GOOD + "\n" + BAD, " ", "Ä" * 70]
    x, first = Q.encode_passages(pa.array(texts))
    for k, t in enumerate(texts):
        alone, _ = Q.encode_passages(pa.array([t]))
        assert np.allclose(x[first[k]:first[k + 1]], alone, atol=1e-6), t
    assert not x[first[1]].any()
    assert first[1] - first[0] == -(-len(texts[0].split()) // Q.PASSAGE_WORDS)


def test_defined_cases(spark, odd_docs, no_docs):
    docs, labels = _tables(spark)
    model = Q.fit_quality(docs, labels)
    out = Q.score_quality(odd_docs, model)
    rows = out.collect()
    assert len(rows) == 12 and sorted(out.columns) == sorted(odd_docs.columns)
    same = {r.score for r in rows if r.text and r.text.startswith("The quick")}
    assert len(same) == 1
    assert len({r.score for r in rows if not r.text}) == 1
    assert Q.score_quality(no_docs, model).count() == 0
    empty = Q.fit_quality(no_docs, labels)
    assert {r.score for r in Q.score_quality(odd_docs, empty).collect()} == {0.5}
    assert Q.fit_quality(docs, labels.where("quality = 1")).base == 1.0


def test_classes_of_long_texts_are_learned(spark):
    """All texts are longer than the bound of the fit, and scores aren't one constant."""
    rows = [(i, ("#$ 99 || XX && " if i % 2 else "a quiet sentence, well formed. ") * 1500) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "doc_id bigint, quality int")
    found = Q.score_quality(docs, Q.fit_quality(docs, labels))
    assert found.where("predicted = 1 - doc_id % 2").count() == 120

import random

import pytest
from pyspark.sql import functions as F

from emporia.llm import decontam as D


def _corpus(n_items, n_docs, seed=3):
    rng = random.Random(seed)
    words = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "ta", "so") for b in ("", "n", "ris", "do", "ve", "pal")]

    def sentence(k):
        return " ".join(rng.choice(words) for _ in range(k)).capitalize() + "."

    items = [(k, " ".join(sentence(rng.randint(4, 25)) for _ in range(rng.choice([1, 2, 3, 6])))) for k in range(n_items)]
    docs = []
    for k in range(n_docs):
        text = " ".join(sentence(rng.randint(3, 30)) for _ in range(rng.randint(0, 12)))
        if k % 3 == 0:
            leak = rng.choice(items)[1]
            leak = {0: leak, 1: leak.upper(), 2: leak.replace(" ", " *** ")}[k % 9 // 3]
            text = f"{text}\n{leak} {sentence(9)}"
        elif k % 3 == 1:  # half an item is no leak
            w = rng.choice(items)[1].split()
            text = f"{text} {' '.join(w[:len(w) // 2])}"
        docs.append((k, text))
    return items, docs


def brute(items, docs):
    """Every item whose question and answer overlap the document enough, by looking at all pairs."""
    out = set()
    for i, t in docs:
        w = D.words(t)
        for k, item in items:
            q, a = D.question_and_answer(item)
            gq, ga = D.grams(q, 5), D.grams(a, 3)
            hit = len(gq & D.grams_of(w, min(5, len(q)))) >= D.QUESTION * len(gq)
            if gq and hit and (not ga or len(ga & D.grams_of(w, min(3, len(a)))) >= D.ANSWER * len(ga)):
                out.add((i, k))
    return out


@pytest.mark.parametrize("bound", [512, 25])
def test_leaks_against_brute_force(spark, bound):
    items, docs = _corpus(60, 150)
    found = D.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"),
                         spark.createDataFrame(items, "item_id bigint, text string"), index_pieces=bound).collect()
    got = {(r.doc_id, k) for r in found for k in r["items"]}
    assert len(found) == 150 and got == brute(items, docs) and len(got) >= 50


def test_wand_retrieves_what_full_scoring_does():
    items, docs = _corpus(80, 60, seed=4)
    row = type("Row", (), {})
    rows = []
    for k, t in items:
        r = row()
        r.text, r.items = t, [k]
        rows.append(r)
    index = D.Index(list(D._pieces(rows)), threshold=0.3)
    n = 0
    for _, t in docs:
        terms = sorted({x for x in index.encode(t)[:128].tolist() if x < len(index.vocab)})
        full = {}
        for postings in index.postings:
            for term in terms:
                for piece, x in zip(*postings.get(term, ((), ())), strict=True):
                    full[piece] = full.get(piece, 0) + x
        import numpy as np
        got = dict(index.retrieve(np.array(terms, int)))
        assert set(got) == {p for p, s in full.items() if s >= 0.3 - 1e-6}
        assert all(abs(got[p] - full[p]) < 1e-9 for p in got)
        n += len(got)
    assert n > 20


def test_defined_cases(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, "some words here and there"),
                                   (4, "The quick brown fox jumps over the lazy dog."),
                                   (5, "The quick brown fox jumps over the lazy dog.")], "item_id bigint, text string")
    out = D.find_leaks(odd_docs, bench)
    rows = out.collect()
    assert len(rows) == 12 and sorted(out.columns) == sorted(odd_docs.columns)
    assert all(r["items"] == ([4, 5] if (r.text or "").startswith("The quick") else []) for r in rows)
    assert D.find_leaks(no_docs, bench).count() == 0
    assert {len(r["items"]) for r in D.find_leaks(odd_docs, bench.where("false")).collect()} == {0}


@pytest.mark.parametrize("bound", [512, 1])
def test_items_without_an_id_are_found(spark, bound):
    text = "which of these numbers is the largest prime below one hundred? it is ninety seven of course"
    docs = spark.createDataFrame([(1, f"before it {text} and after"), (2, "nothing of the kind"), (3, None)],
                                 "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, text), (7, text), (None, "some other words that stand nowhere at all"),
                                   (9, "and one more that nobody ever wrote down")], "item_id bigint, text string")
    got = {r.doc_id: r["items"] for r in D.find_leaks(docs, bench, index_pieces=bound).collect()}
    assert got == {1: [7, None], 2: [], 3: []}
    only = D.find_leaks(docs, bench.where("item_id IS NULL"), index_pieces=bound)
    assert [r.doc_id for r in only.where(F.size("items") == 0).collect()] == [2, 3]


def test_plan_does_not_grow_with_the_benchmark(spark):
    items, docs = _corpus(60, 10)
    plans = []
    for n in (20, 60):
        found = D.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"),
                             spark.createDataFrame(items[:n], "item_id bigint, text string"), index_pieces=5)
        plans.append(found._jdf.queryExecution().executedPlan().toString().count("+-"))
    assert plans[0] == plans[1]

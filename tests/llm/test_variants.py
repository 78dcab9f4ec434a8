import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from emporia.llm import variants
from emporia.llm.variants import group_variants, near_pairs

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def counts(docs):
    n = Counter()
    for i, text in docs:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: c for w, c in n.items() if c >= 3 and len(w) >= 5}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = counts(docs)
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    form, out = {}, {}
    for w in n:
        found = [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if near(w, v)]
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = [n[w], len(found), form[w], n[form[w]] if form[w] else None]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def result(df):
    rows = df.select(*COLUMNS).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {r["word"]: tuple(r)[1:] for r in rows}


def test_against_brute_force(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("aabcdeéèü") for _ in range(rng.randrange(5, 10))) for _ in range(60)]

    def typo(w):
        at, kind = rng.randrange(len(w)), rng.randrange(4)
        letter = rng.choice("abcdeé×")
        return (w[:at] + letter + w[at:], w[:at] + w[at + 1:], w[:at] + letter + w[at + 1:], w.upper())[kind]

    docs = []
    for i in range(300):
        words = [rng.choice(base) if rng.random() < 0.7 else typo(typo(rng.choice(base[:20]))) for _ in range(60)]
        docs.append((rng.choice([None, i, i, i]), rng.choice([" ", "1", "-\n", "Ā"]).join(words)))
    docs += docs[:20] + [(900, None), (901, ""), (902, "hello " * 50_000), (903, "a b cd ÀÉÎÕÜ ÀÉÎÕÜ ÀÉÎÕÜ")]
    expected = brute(docs)
    assert sum(v[2] is not None for v in expected.values()) > 50
    assert any(v[2] and v[4] != v[2] for v in expected.values())        # a chain of two forms
    assert result(group_variants(spark.createDataFrame(docs, "doc_id bigint, text string"))) == expected


def test_words_of_few_letters_and_anagrams(spark):
    """One bucket for many words: two letters only, every order of them."""
    rng = random.Random(6)
    n = {"".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))): rng.randrange(3, 90) for _ in range(200)}
    pairs = near_pairs(spark.createDataFrame(list(n.items()), "word string, n long")).collect()
    got = [tuple(sorted((r["a"], r["b"]))) for r in pairs]
    assert len(got) == len(set(got))
    assert set(got) == {tuple(sorted((a, b))) for a in n for b in n if a < b and near(a, b)}
    assert all(n[r["a"]] == r["n_a"] and n[r["b"]] == r["n_b"] for r in pairs)


def test_ties_take_the_first_word_in_code_point_order(spark):
    docs = [(1000, "zello " * 8 + "éello " * 8 + "hello " * 3 + "Zello")]
    got = result(group_variants(spark.createDataFrame(docs, "doc_id bigint, text string")))
    assert got == brute(docs)
    tie = spark.createDataFrame([(None, " ".join(["qello"] * 8 + ["éello"] * 8 + ["hello"] * 4))], "doc_id bigint, text string")
    assert result(group_variants(tie)) == brute([tuple(tie.first())])


def test_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumns({c: F.lit("old") for c in ("word", "n", "form", "__run", "__id", "signature")})
    assert result(group_variants(clash)) == brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert group_variants(no_docs).count() == 0


def test_no_word_table_is_broadcast(spark, monkeypatch):
    """The files of a vocabulary are small, its signatures a dozen times as many rows: none may be sent to the driver."""
    plans, staged = [], variants.staged

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return staged(df, name)

    monkeypatch.setattr(variants, "staged", noted)
    docs = [(i, "hello hello hello hello hello hello hallo hallo hallo halloo world") for i in range(9)]
    got = group_variants(spark.createDataFrame(docs, "doc_id bigint, text string"))
    plans.append(("result", got._jdf.queryExecution().executedPlan().toString()))
    assert {name for name, _ in plans} == {"vocabulary", "near-words", "variants", "roots", "result"}
    assert [name for name, plan in plans if "Broadcast" in plan] == []
    assert sum(plan.count("SortMergeJoin") for _, plan in plans) >= 5
    assert result(got) == brute(docs)

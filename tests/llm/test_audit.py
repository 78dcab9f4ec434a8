import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from emporia.llm.audit import COLUMNS, Diagram, adjacent_swaps, audit_filters, audit_part

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    """Every order applied from left to right to the list of documents."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for i, text, part in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = {f for f, bad in {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and text in least and i > least[text]}.items() if bad}
        parts[part or ""].append((fails, i in good, i in toxic))
    rows = {}
    for part, held in parts.items():
        total = defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            left = held
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                total[f] += len(gone)
                rows[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in d[0] for d in held) - len(gone), sum(d[0] == {f} for d in held),
                    sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for key in [k for k in rows if k[0] == part]:
            rows[key].append(total[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in rows.items()}


def result(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in df.collect()}


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_every_order_against_brute_force(spark):
    rng = random.Random(3)
    docs = []
    for i in range(150):
        n = rng.choice([0, 5, 99, 100, 101, 140])
        words = [rng.choice(["ab", "Cd", "x#y", f"w{j}", f"v{j}", "É"]) for j in range(n)]
        docs.append((rng.choice([None, i, i, i, i // 7]), rng.choice([" ", "\n", "\x0b \t", "  "]).join(words),
                     rng.choice(["en", "fr", None, ""])))
    docs += [(500 + i, docs[i % 20][1], "en") for i in range(60)]
    docs += [(700, None, "fr"), (701, "", None), (None, None, None), (702, " \n", "de"), (703, "word " * 40_000, "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 560)]
    labels += [(5, 1, 0), (5, 0, 1), (None, 1, 1)]
    got = audit_filters(spark.createDataFrame(docs, "doc_id bigint, text string, lang string"), labels_of(spark, labels))
    assert result(got) == brute(docs, labels)


def test_zeros_and_odd_rows(spark, odd_docs, no_docs):
    labels = labels_of(spark, [(7, 1, 1)])
    found = audit_filters(odd_docs.withColumns({c: F.lit("old") for c in ("lang", "mask", "part", "n", "step")}), labels)
    rows = result(found)
    assert len(rows) == 600 and {k[0] for k in rows} == {"old"}
    assert audit_filters(no_docs.withColumn("lang", F.lit("x")), labels).count() == 0
    # rows of one id are no copies of each other, and a null id never fails E
    alike = [(1, "a", "x"), (1, "a", "x"), (None, "a", "x"), (2, "a", "x")]
    got = result(audit_filters(spark.createDataFrame(alike, "doc_id bigint, text string, lang string"), labels))
    assert got["x", "EABCD", 1][:2] == (3, 1)
    only = labels_of(spark, []).where("false")
    assert result(audit_filters(spark.createDataFrame(alike, "doc_id bigint, text string, lang string"), only))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_swaps_visit_every_order_once(n):
    order, seen = list(range(n)), []
    seen.append(tuple(order))
    for level in adjacent_swaps(n):
        order[level], order[level + 1] = order[level + 1], order[level]
        seen.append(tuple(order))
    assert len(seen) == len(set(seen)) == len(list(itertools.permutations(range(n))))


def test_swap_equals_a_diagram_built_in_that_order():
    rng = random.Random(1)
    cells = {m: (rng.randrange(3), rng.randrange(2), 0) for m in range(32) if rng.random() < 0.6}
    diagram = Diagram(cells, 5)
    for level in adjacent_swaps(5):
        diagram.swap(level)
        node_of = dict(zip(diagram.order, range(5), strict=True))
        for mask in range(32):
            node = diagram.root
            for f in diagram.order:
                node = diagram.nodes[node][mask >> f & 1]
            assert diagram.totals[node] == cells.get(mask, (0, 0, 0)), node_of
    # equal sub-diagrams are shared: a part without documents has one node a level
    assert len(Diagram({}, 5).nodes) == 6 and len(audit_part({})) == 600

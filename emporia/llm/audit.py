"""Filter interaction audit: what each order of five quality filters removes, part by part.

One scan states for every document which filters it fails (a mask); the masks are
counted by part, so that a part is at most 32 rows however large it is. Each part's
counts become a decision diagram: one level a filter, equal sub-diagrams shared,
leaves with the counts of documents, of good and of toxic ones. All orders of the
filters are visited by swaps of two adjacent levels, each of which rebuilds only the
two levels it touches; the path of passing edges of an order gives its five steps.

Defined cases: a null text is the empty text, a null part the empty string. A null
doc_id isn't larger than any other, so its row never fails E, and has no label; a
label row counts as good or toxic if any row of its doc_id does. Repeated rows with one
doc_id are not copies of each other. Columns other than ``doc_id``, ``text`` and the
part are not read. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import staged

FILTERS = "ABCDE"
#: ASCII white space; words are what lies between.
_SPACE = " \t\n\x0b\f\r"
_SPLIT = "[\\x20\\x09-\\x0D]+"
MIN_WORDS, DISTINCT_PCT, CAPITAL_PCT, MARKS = 100, 80, 10, "[#$%&*|]"


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails (A is bit 0)."""
    text = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACE))
    words = F.split(trimmed, _SPLIT)
    n = F.when(trimmed == "", 0).otherwise(F.size(words))
    distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    conditions = [n < MIN_WORDS, 100 * distinct < DISTINCT_PCT * n,
                  100 * capitals > CAPITAL_PCT * F.length(text), text.rlike(MARKS)]
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame, part: str) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by the set of filters they fail.

    Texts are read once and reduced to a digest and four bits. A copy is told by a join on (digest, smallest
    id), which has one row a document on either side: a text that a third of the rows share is no hot key.
    """
    facts = staged(docs.select(
        "doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        failures(F.col("text")).alias("bits"),
        F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest")), "audit-facts")
    firsts = (facts.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
              .where("doc_id IS NOT NULL").withColumn("first", F.lit(True)))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return (facts.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
            .groupBy("part", (F.col("bits") + F.when(copy, 16).otherwise(0)).alias("mask"))
            .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


class Diagram:
    """A decision diagram over failure masks whose leaves are counts.

    ``order`` names the filter of each level. A node is a pair (passing child, failing child) of node numbers;
    equal pairs of one level are one node. ``total`` adds the leaves below a node.
    """

    def __init__(self, cells: dict[int, tuple[int, ...]], n_filters: int, n_counts: int = 3):
        self.nodes: list[tuple] = []
        self.totals: list[tuple[int, ...]] = []
        self.known: dict = {}
        self.order = list(range(n_filters))
        self.zero = (0,) * n_counts
        self.root = self._build(cells, 0, 0)

    def _build(self, cells, level, mask) -> int:
        if level == len(self.order):
            return self._leaf(cells.get(mask, self.zero))
        return self._node(self._build(cells, level + 1, mask),
                          self._build(cells, level + 1, mask | 1 << self.order[level]))

    def _leaf(self, counts) -> int:
        return self._add(("leaf", counts), counts)

    def _node(self, passing: int, failing: int) -> int:
        return self._add((passing, failing),
                         tuple(a + b for a, b in zip(self.totals[passing], self.totals[failing], strict=True)))

    def _add(self, key, total) -> int:
        if key not in self.known:
            self.known[key] = len(self.nodes)
            self.nodes.append(key)
            self.totals.append(total)
        return self.known[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and ``level + 1``; the levels below keep their nodes."""
        done: dict[int, int] = {}

        def rebuilt(node: int, depth: int) -> int:
            if node not in done:
                passing, failing = self.nodes[node]
                if depth < level:
                    done[node] = self._node(rebuilt(passing, depth + 1), rebuilt(failing, depth + 1))
                else:
                    (pp, pf), (fp, ff) = self.nodes[passing], self.nodes[failing]
                    done[node] = self._node(self._node(pp, fp), self._node(pf, ff))
            return done[node]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """For each level along the passing edges: its filter, counts kept and counts removed."""
        node = self.root
        for f in self.order:
            passing, failing = self.nodes[node]
            yield f, self.totals[passing], self.totals[failing]
            node = passing


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap with the next one so that every order of ``n`` is visited once, the first one included."""
    if n < 2:
        return
    down = True
    for inner in [*adjacent_swaps(n - 1), None]:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if inner is None:
            return
        yield inner + 1 if down else inner      # the largest element rests at the left end, or at the right end
        down = not down


def audit_part(cells: dict[int, tuple[int, int, int]], filters: str = FILTERS) -> list[dict]:
    """Steps of all orders of one part; counts are (documents, good, toxic) for each mask."""
    diagram = Diagram(cells, len(filters))
    rows = []

    def visit():
        name = "".join(filters[f] for f in diagram.order)
        for step, (f, kept, removed) in enumerate(diagram.steps(), 1):
            rows.append({"filter_order": name, "step": step, "f": f, "kept": kept[0], "removed": removed[0],
                         "good_lost": removed[1], "toxic_lost": removed[2]})

    visit()
    for level in adjacent_swaps(len(filters)):
        diagram.swap(level)
        visit()
    failing, alone, shapley = {}, {}, dict.fromkeys(range(len(filters)), 0)
    for r in rows:
        shapley[r["f"]] += r["removed"]
        if r["step"] == 1:
            failing[r["f"]] = r["removed"]
        if r["step"] == len(filters):
            alone[r["f"]] = r["removed"]
    for r in rows:
        f = r.pop("f")
        r.update(redundant=failing[f] - r["removed"], unique_fails=alone[f], shapley=shapley[f])
    return rows


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row for each part, order of the filters A to E and step, with what the step removes.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fails its filter, removed earlier), ``unique_fails``
    (fails its filter only), ``good_lost`` and ``toxic_lost`` among the removed, and ``shapley``: what its filter
    removes, summed over all orders. Counts are of documents of the part.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cells = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(pdf["mask"], pdf["n"], pdf["good"], pdf["toxic"],
                                                                       strict=True)}
        out = pd.DataFrame(audit_part(cells))
        out.insert(0, "part", pdf["part"].iloc[0])
        return out[["part", "filter_order", "step", *COLUMNS]]

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COLUMNS)
    return mask_counts(docs, labels, part).groupBy("part").applyInPandas(run, schema)


def audit_sql() -> str:
    """The same result of tables ``documents`` and ``labels`` in DuckDB SQL: every order counted by itself."""
    words = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPLIT}'), lambda w: w <> '')"
    return f"""
WITH facts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body, {words} AS words FROM documents),
firsts AS (SELECT body, min(doc_id) AS least FROM facts GROUP BY body),
marks AS (SELECT doc_id, max((coalesce(quality, 0) = 1)::int) AS good, max((coalesce(toxic, 0) = 1)::int) AS toxic
          FROM labels GROUP BY doc_id),
masked AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(words) < {MIN_WORDS})::int + 2 * (100 * len(list_distinct(words)) < {DISTINCT_PCT} * len(words))::int
    + 4 * (100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > {CAPITAL_PCT} * length(body))::int
    + 8 * regexp_matches(body, '{MARKS}')::int + 16 * coalesce(doc_id > least, false)::int AS mask
  FROM facts JOIN firsts USING (body) LEFT JOIN marks USING (doc_id)),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
   AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[:step - 1]), 0)::int AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN (mask & (earlier | bit)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (mask & earlier) > 0 AND (mask & bit) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (mask & earlier) = 0 AND (mask & bit) > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::int AS step, kept::bigint AS kept, removed::bigint AS removed,
  redundant::bigint AS redundant, unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost,
  toxic_lost::bigint AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::bigint AS shapley
FROM counted
"""

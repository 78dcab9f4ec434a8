"""Connected components of a link table, by alternating star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import staged


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(src, dst))")).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, root)``: the smallest node that each linked node reaches.

    Links may repeat, point either way or to themselves; a null end links with
    nothing. Nodes without a link to another node aren't in the result. Every
    round moves each link towards the smallest known neighbour and writes the
    links as a table, so no round depends on the lineage of the one before; the
    minima come from partial aggregates and are tables of their own, so that a
    hub's links can be split by the skew join. Ends when a round changes nothing.
    """
    edges = staged(links.where("a != b")
                   .select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst"))
                   .distinct(), "links")
    before = _mark(edges)
    while before[0]:
        least = staged(edges.groupBy("src").agg(F.min("dst").alias("least")), "least")
        # large star: a link to u becomes a link to u's smallest neighbour
        jumped = staged(edges.join(least.withColumnRenamed("src", "dst"), "dst", "left")
                        .select("src", F.coalesce("least", "dst").alias("dst")), "jumped")
        # small star: a node's other, smaller neighbours link to its smallest one
        least = staged(jumped.groupBy("src").agg(F.min("dst").alias("least")), "least")
        rest = (jumped.join(least, "src").where("dst != least")
                .select(F.col("dst").alias("src"), F.col("least").alias("dst")))
        edges = staged(least.select("src", F.col("least").alias("dst")).unionByName(rest).distinct(), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(
        edges.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct())

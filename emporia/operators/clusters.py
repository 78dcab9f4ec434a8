"""Customer segments by clustering: k-means|| seeds and Lloyd steps over scaled measures.

Measures become whole numbers from 0 to ``UNITS``, so sums are exact and a run gives the same clusters whatever the
partitioning. Seeds are drawn by a hash of the id (k-means||: in each round a row is a candidate with a chance in
proportion to its squared distance); every step is one aggregate of a few rows. The driver holds candidates and
centres only: ``ROUNDS`` x 2k candidates are expected, whatever the number of rows.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.session import scratch_path

UNITS, ROUNDS = 10_000, 5
Point = tuple[int, ...]


def scaled(df: DataFrame, id_col: str, cols: list[str], logs: tuple[str, ...] = ()) -> DataFrame:
    """``(id, p)``: each measure from its least (0) to its greatest value (``UNITS``), those of ``logs`` by logarithm.

    Rows with a null or NaN measure are left out; a measure with one value becomes 0; negative values of ``logs`` count as 0.
    """
    values = {c: F.col(c).cast("double") for c in cols}
    values = {c: F.log1p(F.greatest(v, F.lit(0.0))) if c in logs else v for c, v in values.items()}
    rows = df.select(F.col(id_col).alias("id"), *[v.alias(f"x{i}") for i, v in enumerate(values.values())])
    for i in range(len(cols)):
        rows = rows.where(F.col(f"x{i}").isNotNull() & ~F.isnan(f"x{i}"))
    ends = rows.agg(*[f(f"x{i}").alias(f"{n}{i}") for i in range(len(cols)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    parts = []
    for i in range(len(cols)):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        parts.append(F.lit(0).cast("long") if lo is None or hi <= lo
                     else F.round((F.col(f"x{i}") - F.lit(lo)) / F.lit(hi - lo) * UNITS).cast("long"))
    return rows.select("id", F.array(*parts).alias("p"))


def nearest(p: str, centres: list[Point]) -> Column:
    """Struct ``(d, c)``: squared distance to the nearest centre and its number (ties: the smaller)."""
    known = F.array(*[F.struct(F.array(*[F.lit(x).cast("long") for x in c]).alias("at"), F.lit(k).alias("c"))
                      for k, c in enumerate(centres)])
    squares = lambda at: F.aggregate(F.zip_with(p, at, lambda a, b: (a - b) * (a - b)), F.lit(0).cast("long"),
                                     lambda s, x: s + x)
    return F.array_min(F.transform(known, lambda k: F.struct(squares(k["at"]).alias("d"), k["c"].alias("c"))))


def _inertia(rows: DataFrame, centres: list[Point]) -> int:
    return int(rows.agg(F.sum(nearest("p", centres)["d"].cast("decimal(38,0)"))).first()[0] or 0)


def seeds(rows: DataFrame, k: int, seed: int = 0) -> list[Point]:
    """At most ``k`` starting centres by k-means||; fewer if the rows have fewer distinct points."""
    first = rows.agg(F.min_by("p", F.struct(F.xxhash64("id", F.lit(seed)), "p"))).first()[0]
    if first is None:
        return []
    found = [tuple(first)]
    for turn in range(1, ROUNDS + 1):
        total = _inertia(rows, found)
        if total == 0:
            break
        chance = F.shiftrightunsigned(F.xxhash64("id", F.lit(seed), F.lit(turn)), 11) / F.lit(float(1 << 53))
        picked = rows.where(chance < nearest("p", found)["d"] * F.lit(2.0 * k / total)).select("p").distinct()
        found += sorted(tuple(r.p) for r in picked.collect())
    weights = dict(rows.groupBy(nearest("p", found)["c"]).agg(F.count(F.lit(1))).collect())
    # k of the candidates, each with a chance in proportion to its rows times its squared distance
    draw, chosen = random.Random(seed), []
    far = [1] * len(found)
    while len(chosen) < k:
        mass = [weights.get(i, 0) * d for i, d in enumerate(far)]
        if not any(mass):
            break
        chosen.append(draw.choices(found, mass)[0])
        far = [min(sum((a - b) ** 2 for a, b in zip(p, c, strict=True)) for c in chosen) for p in found]
    return sorted(chosen)


def lloyd(rows: DataFrame, centres: list[Point], steps: int = 100, tolerance: int = 0) -> list[Point]:
    """Move centres to the (rounded) means of their rows until none would move by more than ``tolerance``; an empty one stays."""
    for _ in range(steps):
        if not centres:
            return centres
        sums = {r.c: r for r in rows.select(nearest("p", centres)["c"].alias("c"), "p").groupBy("c").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(len(centres[0]))]).collect()}
        moved = [tuple((2 * sums[k][f"s{i}"] + sums[k].n) // (2 * sums[k].n) for i in range(len(c))) if k in sums else c
                 for k, c in enumerate(centres)]
        step = max(abs(a - b) for c, m in zip(centres, moved, strict=True) for a, b in zip(c, m, strict=True))
        if step <= tolerance:
            break
        centres = moved
    return centres


@dataclass
class Clusters:
    """``rows``: ``(id, p)``; ``start``: the seeds; ``centres``: final ones, in the order of their numbers from 1."""

    rows: DataFrame
    start: list[Point]
    centres: list[Point]

    def members(self) -> DataFrame:
        """``(id, cluster, distance)``, the squared distance in units."""
        if not self.centres:
            return self.rows.select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
        best = nearest("p", self.centres)
        return self.rows.select("id", (best["c"] + 1).alias("cluster"), best["d"].alias("distance"))

    def inertia(self, centres: list[Point] | None = None) -> int:
        centres = self.centres if centres is None else centres
        return _inertia(self.rows, centres) if centres else 0


def cluster(df: DataFrame, id_col: str, cols: list[str], k: int, logs: tuple[str, ...] = (), seed: int = 0,
            steps: int = 100, tolerance: int = 0) -> Clusters:
    """Cluster the rows of ``df`` by ``cols``; the scaled rows are written once to the shared scratch folder.

    Clusters are numbered by their centres, greatest last measure first. Defined cases: an empty table has no
    cluster; repeated points share one; with fewer distinct points than ``k`` there are fewer clusters.
    """
    path = scratch_path(df.sparkSession, "clusters")
    scaled(df, id_col, cols, logs).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    start = seeds(rows, k, seed)
    centres = lloyd(rows, start, steps, tolerance)
    return Clusters(rows, start, sorted(set(centres), key=lambda c: (c[::-1], c), reverse=True))


def rfm_clusters(rfm: DataFrame, k: int = 6, seed: int = 0, tolerance: int = 0) -> tuple[DataFrame, Clusters]:
    """Customers of ``rfm_scores`` by recency, frequency and spend: ``(customer_id, cluster, distance)`` and the model."""
    found = cluster(rfm, "customer_id", ["recency_days", "frequency", "monetary"], k, ("frequency", "monetary"),
                    seed, tolerance=tolerance)
    return found.members().withColumnRenamed("id", "customer_id"), found


def rfm_clusters_checked(rfm: DataFrame, k: int = 6, tolerance: int = UNITS // 1000) -> DataFrame:
    """The customers with their measures, and ``within_bound``: each is nearest to its own centre, every centre is within
    ``tolerance`` of its members' mean, the inertia isn't above that of the seeds, and no customer is left out."""
    members, model = rfm_clusters(rfm, k, tolerance=tolerance)
    own = members.select(F.col("customer_id").alias("id"), "cluster", "distance").join(model.rows, "id")
    means = own.groupBy("cluster").agg(*[F.avg(F.col("p")[i]).alias(f"m{i}") for i in range(3)]).collect()
    kept = model.inertia() <= model.inertia(model.start) and all(
        abs(r[f"m{i}"] - model.centres[r.cluster - 1][i]) <= tolerance + 1 for r in means for i in range(3))
    least = F.least(*[sum((F.col("p")[i] - c[i]) * (F.col("p")[i] - c[i]) for i in range(3)) for c in model.centres]
                    ) if len(model.centres) > 1 else F.col("distance")
    checked = own.select(F.col("id").alias("customer_id"), (F.lit(kept) & (F.col("distance") == least)).alias("ok"))
    return (rfm.select("customer_id", "recency_days", "frequency", "monetary").join(checked, "customer_id", "left")
            .select("customer_id", "recency_days", "frequency", "monetary", F.coalesce("ok", F.lit(False)).alias("within_bound")))

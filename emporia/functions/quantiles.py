"""Quantiles without gathering a column into one task.

``exact_quantiles`` returns the same value as SQL ``percentile_cont`` (linear
interpolation between the order statistics at ``floor`` and ``ceil`` of
``p * (n - 1)``), computed by distributed selection:

1. ``n`` = non-null count (one global aggregate with map-side partials).
2. For each needed rank ``k`` keep an open value window ``(lo, hi)`` that holds
   it, with ``below`` = number of values up to ``lo``. A window starts as the
   whole column.
3. ``percentile_approx`` (a bounded-size sketch per task) gives two values of
   the window near the rank; four exact counts (below and up to each of them)
   say whether one of them *is* the value at the rank, or which side of them it
   lies on. Either way both leave the window, so every round answers or shrinks
   it: by about ``accuracy / 4``, or past a value that many rows hold.

The same steps run at every size, and end for every column.

Only scalars reach the driver. Interpolation is done in exact decimal
arithmetic on the shortest repr of the selected values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _in_window(x: Column, lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (x > F.lit(lo))
    if hi is not None:
        cond = cond & (x < F.lit(hi))
    return cond


def _around(p: float, eps: float) -> list[float]:
    return [max(0.0, p - eps), min(1.0, p + eps)]


def select_ranks(values: DataFrame, counts: dict[str, int], wanted: dict[str, list[int]],
                 accuracy: int = 10_000, hints: dict | None = None) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks of the sorted non-null values of each column.

    All columns and ranks share the same jobs: one ``percentile_approx``
    aggregate and one counting aggregate per round. ``hints`` gives two values
    of the column near each rank for the first round, which then needs no
    sketch of its own.
    """
    # (column, rank) -> lower bound, upper bound, values up to the lower bound, values between
    state = {(c, k): (None, None, 0, counts[c]) for c, ks in wanted.items() for k in set(ks)}
    answer: dict[tuple[str, int], float] = {}
    eps = 2.0 / accuracy
    while pending := [key for key in state if key not in answer]:
        if hints:
            near = {f"a{i}": hints[key] for i, key in enumerate(pending)}
            hints = None
        else:
            sketches = []
            for i, (c, k) in enumerate(pending):
                lo, hi, below, size = state[(c, k)]
                local = (k - below) / max(size - 1, 1)
                sketches.append(F.percentile_approx(F.when(_in_window(F.col(c), lo, hi), F.col(c)),
                                                    _around(local, eps), accuracy).alias(f"a{i}"))
            near = values.agg(*sketches).first()
        exact = []
        for i, (c, _) in enumerate(pending):
            x = F.col(c)
            for j, v in enumerate(near[f"a{i}"]):
                exact += [F.count_if(x < F.lit(v)).alias(f"lt{j}_{i}"), F.count_if(x <= F.lit(v)).alias(f"le{j}_{i}")]
        n = values.agg(*exact).first()
        for i, (c, k) in enumerate(pending):
            lo, hi, below, size = state[(c, k)]
            end = below + size
            for j, v in enumerate(near[f"a{i}"]):
                lt, le = n[f"lt{j}_{i}"], n[f"le{j}_{i}"]
                if lt <= k < le:
                    answer[(c, k)] = v
                    break
                if le <= k:
                    lo, below = v, le
                else:
                    hi, end = v, lt
                    break
            state[(c, k)] = (lo, hi, below, end - below)
    return answer


def _dec(v) -> Decimal:
    return Decimal(repr(v)) if isinstance(v, float) else Decimal(v)


def exact_quantiles_many(df: DataFrame, spec: dict[str, list[float]],
                         accuracy: int = 10_000) -> dict[str, list[Decimal | None]]:
    """``percentile_cont(p)`` for several columns at once, as exact decimals."""
    cols = list(spec)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    # the counts and, as the probabilities are known before the ranks are, the first sketch: one job
    eps = 2.0 / accuracy
    near = [F.percentile_approx(c, [x for p in spec[c] for x in _around(float(p), eps)], accuracy).alias(f"near_{i}")
            for i, c in enumerate(cols)]
    crow = values.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)], *near).first()
    counts = {c: crow[f"n_{i}"] for i, c in enumerate(cols)}
    plans, wanted, hints = {}, {}, {}
    for c in cols:
        n = counts[c]
        plans[c] = []
        if n == 0:
            continue
        for p in spec[c]:
            pos = Decimal(repr(float(p))) * (n - 1)
            lo = int(pos)
            frac = pos - lo
            plans[c].append((lo, lo + 1 if frac > 0 else lo, frac))
        for j, (lo, hi, _) in enumerate(plans[c]):
            pair = crow[f"near_{cols.index(c)}"][2 * j:2 * j + 2]
            hints[(c, lo)], hints[(c, hi)] = pair, pair
        wanted[c] = sorted({r for lo, hi, _ in plans[c] for r in (lo, hi)})
    got = select_ranks(values, counts, wanted, accuracy, hints) if wanted else {}
    out = {}
    for c in cols:
        if counts[c] == 0:
            out[c] = [None for _ in spec[c]]
            continue
        res = []
        for lo, hi, frac in plans[c]:
            vlo, vhi = _dec(got[(c, lo)]), _dec(got[(c, hi)])
            res.append(vlo + (vhi - vlo) * frac)
        out[c] = res
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float],
                    accuracy: int = 10_000) -> list[Decimal | None]:
    """``percentile_cont(p)`` of ``df[col]`` for each ``p``, as exact decimals."""
    return exact_quantiles_many(df, {col: list(probs)}, accuracy=accuracy)[col]


def approx_quantiles_row(df: DataFrame, col: str, probs: list[float], names: list[str],
                         accuracy: int = 10_000) -> DataFrame:
    """One-row DataFrame of ``percentile_approx`` values (lazy; a bounded sketch per task)."""
    q = F.percentile_approx(F.col(col).cast("double"), list(probs), accuracy)
    return df.agg(q.alias("_q")).select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])

"""Exact money arithmetic against Python's Decimal and Fraction."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.functions.money import cents, cents_to_double, net_amount, net_cents, ratio_half_up


def _half_up(fr: Fraction, scale: int) -> float:
    q = Decimal(fr.numerator) / Decimal(fr.denominator)
    return float(q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**6), st.integers(0, 3)),
                min_size=1, max_size=200))
def test_ratio_half_up_matches_exact_rounding(spark, rows):
    df = spark.createDataFrame(rows, "a long, b long, s int")
    exprs = [ratio_half_up("a", "b", s).alias(f"r{s}") for s in range(4)]
    got = df.select("a", "b", "s", *exprs).collect()
    for r in got:
        want = _half_up(Fraction(r.a, r.b), r.s)
        assert r[f"r{r.s}"] == want, (r, want)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(0, 100)),
                min_size=1, max_size=200))
def test_net_cents_matches_decimal(spark, rows):
    data = [(Decimal(c).scaleb(-2), d) for c, d in rows]
    df = spark.createDataFrame(data, "amt decimal(18,2), d long")
    got = df.select("amt", "d", net_cents("amt", "d").alias("nc"),
                    net_amount("amt", "d").alias("na"), cents("amt").alias("c"),
                    cents_to_double(cents("amt")).alias("back")).collect()
    for r in got:
        exact = (r.amt * (Decimal(100) - r.d) / Decimal(100)).quantize(
            Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert r.na == exact and r.nc == int(exact * 100), (r, exact)
        assert r.c == int(r.amt * 100) and r.back == float(r.amt)

"""Distributed exact quantiles against numpy's linear interpolation."""

from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emporia.functions.quantiles import exact_quantiles, exact_quantiles_many

PROBS = [0.0, 0.2, 0.25, 0.5, 0.6, 0.75, 0.8, 1.0]


def _check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, "x", PROBS, accuracy=100)
    want = np.percentile(np.array(values, dtype=float), [p * 100 for p in PROBS], method="linear")
    for g, w in zip(got, want):
        assert abs(float(g) - w) <= 1e-9 * max(1.0, abs(w)), (got, want)


def test_matches_numpy_with_refinement_rounds(spark):
    rng = np.random.default_rng(7)
    values = np.round(rng.lognormal(5, 2, 3000), 2).tolist()
    _check(spark, values)


def test_hot_value_holding_a_third_of_rows(spark):
    rng = np.random.default_rng(3)
    values = [0.0] * 1000 + np.round(rng.uniform(1, 1000, 2000), 2).tolist()
    _check(spark, values)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=60))
def test_property_small_lists(spark, ints):
    _check(spark, ints)


def test_exact_decimal_interpolation(spark):
    df = spark.createDataFrame([(1.01,), (2.02,), (3.03,), (4.04,), (5.05,)], "x double")
    # position 0.3 * 4 = 1.2: 2.02 + 0.2 * (3.03 - 2.02)
    assert exact_quantiles(df, "x", [0.3]) == [Decimal("2.222")]


def test_many_columns_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = exact_quantiles_many(df, {"a": [0.5], "b": [0.5]})
    assert got["a"] == [Decimal("2.0")] and got["b"] == [None]


@pytest.mark.parametrize("n", [200_000, 2_000_000])
def test_rank_between_two_frequent_values(spark, n):
    df = spark.range(n).selectExpr("double(if(id % 2 = 0, 0, 5)) as x")
    assert exact_quantiles(df, "x", [0.25, 0.5, 0.75]) == [Decimal(0), Decimal("2.5"), Decimal(5)]


def test_ranks_at_the_borders_of_an_integer_column(spark):
    df = spark.range(500_000).selectExpr("id % 5 as x")
    got = [float(v) for v in exact_quantiles(df, "x", [0.2, 0.4, 0.6, 0.8])]
    assert got == pytest.approx(np.percentile(np.repeat(np.arange(5), 100_000), [20, 40, 60, 80]).tolist())

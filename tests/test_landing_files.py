"""Slices of a replay are landed by as many tasks as their rows ask for."""

from emporia.session import scratch_path
from emporia.streaming.sources import land_in_time_order


def test_slices_are_written_in_parallel(spark):
    df = spark.range(1_100_000).selectExpr("timestamp_seconds(id) AS t")
    path = scratch_path(spark, "landing-test")
    assert land_in_time_order(df, path, "t", 4) == 2        # before: one task wrote a slice of up to 5 million rows
    assert spark.read.parquet(path).count() == 1_100_000
    assert len(spark.read.parquet(path).inputFiles()) == 8

"""Replays merged before they meet the state.

``operators.dedup_by_id`` sends every row to the state partition of its id. Where a record is replayed many times over,
two queries do it instead: the first takes each micro-batch to one row an id by a partial aggregate (a task sends one
row of an id, however often it met it) and writes a staged folder; the second reads those folders as a stream into
``dedup_by_id``, which then meets an id once a batch.

A micro-batch that runs again after a failure leaves a finished folder alone; of an unfinished one it writes the rest
again, and the second query drops what it has met. Rows without an id count as one id, as in ``dedup_by_id``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.streaming.customer360 import _finished as finished


def one_an_id(rows: DataFrame, time_col: str, key: str) -> DataFrame:
    """The first row of every id by time (ties: any of them; rows without a time come first)."""
    kept = (rows.groupBy(F.col(key).alias("__id"))
            .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(time_col)).alias("__row")))
    return kept.select("__row.*")


def staged_sink(staging: str, time_col: str, key: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the batch without its replays, as the folder ``staging/<batch>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{staging}/{batch_id}"
        if not finished(batch.sparkSession, path):
            one_an_id(batch, time_col, key).write.mode("append").parquet(path)

    return write


def staged_rows(spark: SparkSession, staging: str, schema: T.StructType, clean: bool = True) -> DataFrame:
    """The staged folders as a stream; files are deleted once read and committed, unless ``clean`` is false."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    return (reader.option("cleanSource", "delete") if clean else reader).parquet(staging)

"""Helpers shared by the operators: Arrow batches, staged tables, row samples."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from emporia.session import scratch_path

#: Bytes of text that one Python step works on; a longer single text is a step of its own.
STEP_BYTES = 2 << 20
#: Rows in an Arrow batch: documents are long, so the default of 10,000 would be hundreds of MB.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the session's Arrow batches and ship this package to the workers.

    Called by every query and stage.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if not any(f.endswith("/emporia.zip") for f in sc.listFiles):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="run-", dir=tempfile.gettempdir())) / "emporia.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))
    return spark


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage; a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket(column: Column | str, modulus: int) -> Column:
    """crc32 of a value's text modulo ``modulus``; null for a null value."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(c.cast("string").cast("binary")) % modulus


def fit_passage(text: str, most: int, seed: str) -> Column:
    """For a fit alone: a text of at most ``most`` characters, or so many of a longer one, from a place that the hash of
    its ``doc_id`` tells. So no class drops out of a bounded sample because its texts are long."""
    n = F.length(text)
    start = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.greatest(n - most + 1, F.lit(1))).cast("int") + 1
    return F.when(n > most, F.substring(F.col(text), start, F.lit(most))).otherwise(F.col(text))


def utf8_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end, and where each begins (one more at the end)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def text_steps(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has at most STEP_BYTES of text, or one row."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + STEP_BYTES, "right")))
        yield batch.slice(start, end - start)
        start = end


def strings(column: pa.Array) -> list[str]:
    """The texts of a column, null as the empty text."""
    return pc.fill_null(column, "").to_pylist()


def with_columns(df: DataFrame, fields: Iterable[StructField], make: Callable[[], Callable],
                 text: str = "text") -> DataFrame:
    """Append columns that Python computes from the text column, batch by batch.

    ``make()`` runs once per task and returns ``f(column) -> [arrays]``, one per
    field. An input column with the name of a new one is replaced.
    """
    fields = list(fields)
    names = {f.name for f in fields}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names or c == text])
    schema = StructType([f for f in kept.schema.fields if f.name not in names] + fields)

    def run(batches):
        apply = make()
        for whole in batches:
            for part in text_steps(whole, text):
                new = dict(zip([f.name for f in fields], apply(part.column(text)), strict=True))
                arrays = [new[n] if n in new else part.column(n) for n in schema.names]
                yield pa.RecordBatch.from_arrays([pa.array(a) if not isinstance(a, pa.Array) else a
                                                  for a in arrays], schema.names)

    return kept.mapInArrow(run, schema)

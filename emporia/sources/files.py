"""File scans and sinks with explicit schemas, JSON decode and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
FORMATS = ("parquet", "csv", "json")

# Text formats keep full microsecond precision (Spark's default pattern for
# writing stops at milliseconds).
TEXT_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# Quoted texts may hold line ends, quotes and backslashes.
CSV_OPTIONS = {"multiLine": "true", "escape": '"', "quote": '"', "lineSep": "\n",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])


def scan_json(spark: SparkSession, path: str, schema: T.StructType, mode: str = "PERMISSIVE") -> DataFrame:
    """Newline-delimited JSON with a declared schema (no inference pass).

    ``PERMISSIVE`` (default): lines are read as text and decoded with
    ``from_json``; malformed lines keep their raw text in ``_corrupt_record``
    (see ``split_quarantine``) and blank lines are skipped. Decoding as an
    expression (rather than in the JSON reader) lets the quarantine be
    queried on its own. ``FAILFAST`` uses the JSON reader and fails on the
    first bad line.
    """
    if mode == "PERMISSIVE":
        lines = spark.read.text(path).filter(F.trim(F.col("value")) != "")
        return decode_json_column(lines, "value", schema)
    return (spark.read.schema(schema).options(**TEXT_TIME_OPTIONS).option("mode", mode)
            .json(path))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header and a declared schema; texts may hold line ends within quotes.

    Rows with a malformed field keep their text in ``_corrupt_record`` (see ``split_quarantine``).
    """
    rows = (spark.read.schema(with_corrupt_column(schema)).options(**TEXT_TIME_OPTIONS, **CSV_OPTIONS)
            .option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    # Spark refuses a query of the corrupt column alone; nothing of a second column makes it one of two
    nothing = F.substring(F.coalesce(F.col(schema.fieldNames()[0]).cast("string"), F.lit("")), 1, 0)
    return rows.withColumn(CORRUPT, F.concat(CORRUPT, nothing))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows with only the raw text)."""
    if CORRUPT not in df.columns:
        return df, df.limit(0)
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad


def decode_json_column(df: DataFrame, value_col: str, schema: T.StructType,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse a JSON text column (stream values, raw lines) into typed columns.

    The result has the schema's columns, ``keep`` columns, and
    ``_corrupt_record`` holding the raw text of lines that do not parse.
    Each line is parsed once: filters on the columns stay above ``inline``,
    where Spark would otherwise parse again for them.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), with_corrupt_column(schema),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
                          **TEXT_TIME_OPTIONS})
    return df.select(*keep, F.inline(F.array(parsed)))


def encode_json_column(df: DataFrame, cols: list[str] | None = None, name: str = "value") -> Column:
    """``to_json`` of the given columns as one JSON object text."""
    cols = cols or df.columns
    return F.to_json(F.struct(*cols), TEXT_TIME_OPTIONS).alias(name)


def save_results(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: list[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` as Parquet, CSV (with header) or JSON lines.

    Unknown formats raise instead of silently falling back to JSON.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    if partition_by:
        # One writer per partition value where it is small, several where it
        # is large: AQE splits and coalesces rebalance partitions by size.
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt != "parquet":
        w = w.options(**TEXT_TIME_OPTIONS)
    if fmt == "csv":
        w = w.options(**CSV_OPTIONS).option("header", True)
    getattr(w, fmt)(path)

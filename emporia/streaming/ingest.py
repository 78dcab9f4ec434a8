"""Stream landing: records -> decoded rows in the raw zone, bad records in quarantine.

Both outputs use Spark's file sink in append mode: it commits each micro-batch
in its ``_spark_metadata`` log, so a batch replayed after a failure is written
once (readers of the folder only see committed files). They write to the lake's
stream folders, beside the batch folders; ``Lake.read`` unites them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from emporia.sources.files import CORRUPT, TEXT_TIME_OPTIONS
from emporia.sources.lake import PART, Lake
from emporia.streaming.sources import decode_records


def split_records(records: DataFrame, schema: T.StructType,
                  date_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(decoded rows with ``ingest_date``, raw bad records with ``ingest_date``).

    ``ingest_date`` is the day of ``date_col`` when given (replays stay
    deterministic), otherwise the processing day of the micro-batch.
    """
    decoded = decode_records(records, schema)
    good = decoded.filter(F.col(CORRUPT).isNull()).select(*schema.fieldNames())
    good = good.withColumn(PART, F.to_date(date_col) if date_col else F.current_date())
    bad = (decoded.filter(F.col(CORRUPT).isNotNull())
                  .select("key", F.col(CORRUPT).alias("raw_value"),
                          F.lit("unreadable record").alias("reject_reason"))
                  .withColumn(PART, F.current_date()))
    return good, bad


def start_landing(records: DataFrame, schema: T.StructType, lake: Lake, source: str,
                  checkpoint_root: str, date_col: str | None = None,
                  available_now: bool = False) -> list[StreamingQuery]:
    """Start the two landing queries (raw zone, quarantine zone) of one source."""
    good, bad = split_records(records, schema, date_col)
    root = checkpoint_root.rstrip("/")
    queries = []
    for df, zone, fmt, opts in ((good, "raw", lake.raw_format, TEXT_TIME_OPTIONS),
                                (bad, "quarantine", "parquet", {})):
        w = (df.writeStream.format(fmt).outputMode("append").options(**opts)
               .partitionBy(PART)
               .option("path", lake.stream_path(zone, source))
               .option("checkpointLocation", f"{root}/{zone}-{source}"))
        if available_now:
            w = w.trigger(availableNow=True)
        queries.append(w.start())
    return queries

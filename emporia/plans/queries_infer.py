"""Inferred schemas of landed text, registered with oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.plans.registry import register
from emporia.schemas import WEBLOGS
from emporia.session import scratch_path
from emporia.sources import infer
from emporia.sources.fixtures import weblogs, with_sources

_W = with_sources("weblogs")


def _land_mixed(spark: SparkSession, w: DataFrame) -> DataFrame:
    """The web events as JSON lines: every seventh has its duration as text, every eleventh is cut short."""
    number = F.col("event_id").try_cast("bigint")
    w = w.select("event_id", "page", "duration_sec", (number % 3).alias("campaign"))
    whole = F.to_json(F.struct("event_id", "page", "duration_sec", "campaign"))
    as_text = F.to_json(F.struct("event_id", "page", F.concat(F.col("duration_sec").cast("string"), F.lit(" s")).alias("duration_sec")))
    line = (F.when(number % 11 == 0, F.substring(whole, 1, 12))
            .when(number % 7 == 0, as_text).otherwise(whole))
    path = scratch_path(spark, "mixed-lines")
    w.select(line.alias("value")).write.text(path)
    return spark.read.text(path)


_MIXED = _W + """,
l AS (SELECT event_id, page, duration_sec, event_id % 7 = 0 AS as_text FROM weblogs WHERE event_id % 11 <> 0)"""


@register("infer_schema_report", _MIXED + """,
r AS (SELECT 'event_id' AS field, count(event_id) AS present, 'BIGINT' AS types, 'BIGINT' AS inferred,
             'string' AS declared, 0 AS unreadable, 'ok' AS drift FROM l
      UNION ALL SELECT 'page', count(page), 'STRING', 'STRING', 'string', 0, 'ok' FROM l
      UNION ALL SELECT 'duration_sec', count(duration_sec), 'BIGINT,STRING', 'VARIANT', 'bigint',
                       count(duration_sec) FILTER (as_text), 'unreadable' FROM l
      UNION ALL SELECT 'campaign', count(*) FILTER (NOT as_text), 'BIGINT', 'BIGINT', NULL, 0, 'unexpected' FROM l
      UNION ALL SELECT 'country', 0, NULL, NULL, 'string', 0, 'missing'
      UNION ALL SELECT NULL, count(*), NULL, NULL, NULL, 0, 'malformed' FROM weblogs WHERE event_id % 11 = 0)
SELECT field, CAST(present AS BIGINT) AS present, CAST(0 AS BIGINT) AS nulls, types, inferred, declared,
       CAST(unreadable AS BIGINT) AS unreadable, drift FROM r""")
def q_infer_schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_report(spark, weblogs(spark, sf_dir))


def schema_report(spark: SparkSession, w: DataFrame) -> DataFrame:
    """Types inferred from landed lines of mixed types, against the declared schema of the web events."""
    kept = type(WEBLOGS)([f for f in WEBLOGS.fields if f.name in ("event_id", "page", "duration_sec", "country")])
    return infer.json_report(_land_mixed(spark, w), kept)


@register("scan_json_widened", _MIXED + """
SELECT event_id, page, CAST(duration_sec AS VARCHAR) || CASE WHEN as_text THEN ' s' ELSE '' END AS duration_sec,
       CASE WHEN NOT as_text THEN event_id % 3 END AS campaign FROM l""")
def q_scan_json_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines read with the types that were inferred from them: the mixed column as text, nothing lost."""
    lines = _land_mixed(spark, weblogs(spark, sf_dir))
    return infer.read_widened(lines, infer.inferred_fields(infer.json_report(lines, type(WEBLOGS)([]))))


@register("infer_csv_report", _W + """,
n AS (SELECT count(*) AS n, count(page) AS pages, count(duration_sec) AS durations,
             count(duration_sec) FILTER (event_id % 7 = 0) AS texts, count("timestamp") AS times FROM weblogs),
r AS (SELECT 'event_id' AS field, n, 0 AS nulls, 'bigint' AS inferred, 'string' AS declared, 0 AS unreadable, 'ok' AS drift FROM n
      UNION ALL SELECT 'page', n, n - pages, 'string', 'string', 0, 'ok' FROM n
      UNION ALL SELECT 'timestamp', n, n - times, 'timestamp_ntz', 'timestamp', 0, 'ok' FROM n
      UNION ALL SELECT 'duration_sec', n, n - durations, 'string', 'bigint', texts, 'unreadable' FROM n
      UNION ALL SELECT 'bot', n, 0, 'boolean', NULL, 0, 'unexpected' FROM n
      UNION ALL SELECT 'country', 0, 0, NULL, 'string', 0, 'missing')
SELECT field, CAST(n AS BIGINT) AS present, CAST(nulls AS BIGINT) AS nulls, inferred, declared,
       CAST(unreadable AS BIGINT) AS unreadable, drift FROM r""")
def q_infer_csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_report(spark, weblogs(spark, sf_dir))


def csv_report(spark: SparkSession, w: DataFrame) -> DataFrame:
    """Column types of a CSV export whose every seventh duration is text, against the declared schema."""
    seconds = F.col("duration_sec").cast("string")
    number = F.col("event_id").try_cast("bigint")
    out = w.select(
        "event_id", "page", "timestamp",
        F.when(number % 7 == 0, F.concat(seconds, F.lit(" s"))).otherwise(seconds).alias("duration_sec"),
        (number % 2 == 0).alias("bot"))
    path = scratch_path(spark, "csv-export")
    out.write.options(**infer.CSV_OPTIONS).option("header", True).csv(path)
    kept = type(WEBLOGS)([f for f in WEBLOGS.fields
                          if f.name in ("event_id", "page", "timestamp", "duration_sec", "country")])
    return infer.csv_report(spark, path, kept)

"""What landed text holds: field types inferred in one pass, and drift against a declared schema.

JSON lines are parsed once to variants; every task merges the types it meets field by field, so what
crosses the shuffle is one row a field and task. CSV columns are tried against a few types in one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.sources.files import CSV_OPTIONS

#: Fields that a schema may have; more are a map written as an object, which no schema should spell out.
MOST_FIELDS = 10_000
# Types that CSV columns are tried against, narrowest first.
CSV_TYPES = ("bigint", "double", "boolean", "timestamp_ntz")


def _drift(declared: Column, present: Column, mixed: Column, unreadable: Column) -> Column:
    return (F.when(F.coalesce(present, F.lit(0)) == 0, "missing").when(declared.isNull(), "unexpected")
            .when(unreadable > 0, "unreadable").when(mixed, "mixed").otherwise("ok"))


def _declared(spark: SparkSession, declared: T.StructType) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in declared.fields],
                                 "field string, declared string")


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``lines`` with ``__v``, the line as a variant: null unless it is a JSON object (one key twice is none)."""
    v = F.try_parse_json(F.col(value_col))
    return lines.withColumn("__v", F.when(F.schema_of_variant(v).startswith("OBJECT"), v))


def json_report(lines: DataFrame, declared: T.StructType, value_col: str = "value") -> DataFrame:
    """One row a field of the JSON lines or of ``declared``: how it is filled, its types and its drift.

    ``present`` lines hold the field, ``nulls`` of them as null; ``types`` are the kinds of value met, sorted;
    ``inferred`` is the type that holds them all (``VARIANT`` where none does, objects merged field by field);
    ``unreadable`` values are lost when read as declared. ``drift``: ``missing`` (declared, nowhere present),
    ``unexpected`` (not declared), ``unreadable``, ``mixed`` (no common type, yet readable as declared) or ``ok``.
    Lines that are no JSON object are counted in one row without a field name, ``malformed``. Null and blank
    lines aren't lines.
    """
    spark = lines.sparkSession
    rows = parse_lines(lines.where(F.trim(F.col(value_col)) != "").select(F.col(value_col).alias("__line")), "__line")
    pairs = (rows.select("__v", F.col("__v").isNull().alias("bad"))
             .lateralJoin(spark.tvf.variant_explode_outer(F.col("__v").outer()))
             .select("bad", F.col("key").alias("field"), F.col("value").alias("x")))
    null, kind = F.is_variant_null("x"), F.regexp_extract(F.schema_of_variant("x"), "^[A-Z]+", 0)
    lost = F.lit(False)
    for f in declared.fields:
        read = F.try_variant_get("x", "$", f.dataType.simpleString())
        lost = lost | ((F.col("field") == f.name) & ~null & read.isNull())
    met = (pairs.where("bad OR field IS NOT NULL").groupBy("field")
           .agg(F.count(F.lit(1)).alias("present"), F.count_if(null).alias("nulls"),
                F.concat_ws(",", F.array_sort(F.array_remove(F.collect_set(kind), "VOID"))).alias("types"),
                F.schema_of_variant_agg("x").alias("inferred"), F.count_if(lost).alias("unreadable")))
    out = met.join(_declared(spark, declared), "field", "full")
    known = F.col("present").isNotNull() & F.col("field").isNotNull()
    return out.select(
        "field", F.coalesce("present", F.lit(0)).alias("present"),
        F.when(F.col("field").isNotNull(), F.coalesce("nulls", F.lit(0))).otherwise(0).alias("nulls"),
        F.when(known, F.col("types")).alias("types"), F.when(known, F.col("inferred")).alias("inferred"), "declared",
        F.when(F.col("field").isNotNull(), F.coalesce("unreadable", F.lit(0))).otherwise(0).alias("unreadable"),
        F.when(F.col("field").isNull(), "malformed").otherwise(
            _drift(F.col("declared"), F.col("present"), F.col("inferred") == "VARIANT", F.col("unreadable"))).alias("drift"))


def read_type(inferred: str) -> str:
    """The column type that reads an inferred one: mixed or always null fields as text."""
    return "string" if inferred in ("VARIANT", "VOID") else inferred.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")


def inferred_fields(report: DataFrame) -> dict[str, str]:
    """``{field: type}`` of what was met, by name; raises beyond ``MOST_FIELDS``."""
    rows = report.where("field IS NOT NULL AND inferred IS NOT NULL").select("field", "inferred").limit(MOST_FIELDS + 1).collect()
    if len(rows) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} fields: read this as a map")
    return {r.field: read_type(r.inferred) for r in sorted(rows)}


def read_widened(lines: DataFrame, fields: dict[str, str], value_col: str = "value") -> DataFrame:
    """The JSON objects of ``lines`` with each field read as its inferred type; no value is lost.

    Values of mixed fields are their JSON text (strings without quotes). Lines that are no object aren't returned.
    """
    def path(name: str) -> str:
        quote = "'" if '"' in name else '"'
        return f"$[{quote}{name}{quote}]"

    return (parse_lines(lines, value_col).where("__v IS NOT NULL")
            .select(*[F.try_variant_get("__v", path(n), t).alias(n) for n, t in fields.items()]))


def csv_report(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    """One row a column of the CSV files (with header) or of ``declared``, as ``json_report`` has one a field.

    ``inferred`` is the first of ``CSV_TYPES`` that reads every value, else ``string``; ``mixed`` says that some values,
    not all, are numbers, truths or times. Empty fields are nulls.
    """
    rows = spark.read.options(**CSV_OPTIONS).option("header", True).csv(path)
    types = {f.name: f.dataType.simpleString() for f in declared.fields}
    if not rows.columns:
        met = spark.createDataFrame([], "field string, present long, nulls long, inferred string, mixed boolean, unreadable long")
    else:
        counts, parts = [F.count(F.lit(1)).alias("n")], []
        for i, name in enumerate(rows.columns):
            x = F.col("`" + name.replace("`", "``") + "`")
            counts.append(F.count(x).alias(f"c{i}"))
            counts += [F.count(x.try_cast(t)).alias(f"c{i}_{k}") for k, t in enumerate(CSV_TYPES)]
            counts.append(F.count(x.try_cast(types[name])).alias(f"d{i}") if name in types else F.count(x).alias(f"d{i}"))
            n, inferred, some = F.col(f"c{i}"), F.lit("string"), F.lit(False)
            for k, t in reversed(list(enumerate(CSV_TYPES))):
                inferred = F.when(F.col(f"c{i}_{k}") == n, t).otherwise(inferred)
                some = some | (F.col(f"c{i}_{k}") > 0)
            inferred = F.when(n == 0, "string").otherwise(inferred)
            parts.append(F.struct(F.lit(name).alias("field"), F.col("n").alias("present"), (F.col("n") - n).alias("nulls"),
                                  inferred.alias("inferred"), (some & (inferred == "string")).alias("mixed"),
                                  (n - F.col(f"d{i}")).alias("unreadable")))
        met = rows.agg(*counts).select(F.inline(F.array(*parts)))
    return met.join(_declared(spark, declared), "field", "full").select(
        "field", F.coalesce("present", F.lit(0)).alias("present"), F.coalesce("nulls", F.lit(0)).alias("nulls"), "inferred",
        "declared", F.coalesce("unreadable", F.lit(0)).alias("unreadable"),
        F.when(F.col("inferred").isNull(), "missing").otherwise(
            _drift(F.col("declared"), F.lit(1), F.col("mixed"), F.col("unreadable"))).alias("drift"))

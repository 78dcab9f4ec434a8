"""Date-partitioned data lake.

Layout: ``<root>/<zone>/<source>/ingest_date=YYYY-MM-DD/part-*``. Hive-style
folders let Spark discover the ``ingest_date`` column and prune partitions
when a day is read. Re-ingesting a day replaces that day and nothing else.

* raw zone: records as landed, JSON lines (the wire format), gzipped;
* processed zone: cleaned records (trimmed, validated, one version per record
  id: the one that landed last), Parquet;
* quarantine zone: rejected records, Parquet, with one schema for batch and
  stream: ``key``, ``raw_value`` (the text as landed), ``reject_reason``.

The processed and quarantine zones of a source are one snapshot table
(``emporia.sources.snapshots``) under ``<root>/snapshots/<source>``: a promotion is
one commit of both, readers see it whole or not at all, and earlier versions stay
readable. Only the raw zone has the folders above.

Streams land in ``<root>/stream/<zone>/<source>``: the streaming file sink keeps
a log of its own there, which batch writers must not touch and readers of a
shared folder would take for the whole truth. ``read`` unites both folders.

``root`` is any Hadoop-compatible URI (``hdfs://``, ``s3a://``, ``file:``).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emporia.schemas import RECORD_KEY, SOURCES, check_source
from emporia.session import scratch_path, shuffles_freed
from emporia.sources.files import CORRUPT, TEXT_TIME_OPTIONS, encode_json_column, with_corrupt_column
from emporia.sources.snapshots import FILE_ROWS, Change, Snapshots

ZONES = ("raw", "processed", "quarantine")
PART = "ingest_date"
QUARANTINE = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "raw_value", "reject_reason")]
                          + [T.StructField(PART, T.DateType())])
#: What the folder of rows without a day is called.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: The reason of lines that don't parse and of fields that don't fit the schema.
UNREADABLE = "unreadable record"
#: Parts that the ids of several days are compared in.
ID_PARTS = 4
#: Id columns that the files of the snapshot tables are described by.
CUSTOMER = "customer_id"


def _as_date_col(date) -> Column:
    if date is None:
        return F.current_date()
    if isinstance(date, Column):
        return F.to_date(date)
    if isinstance(date, (_dt.date, _dt.datetime)):
        return F.lit(date.strftime("%Y-%m-%d")).cast("date")
    return F.lit(str(date)).cast("date")


def _validity(source: str, cols: list[str]) -> list[tuple[str, Column]]:
    """(reason, failing condition) pairs; only rules whose columns exist apply."""
    c = F.col
    rules = {
        "weblogs": [("missing event_id", c("event_id").isNull()),
                    ("negative duration", c("duration_sec") < 0)],
        "transactions": [("missing order_id", c("order_id").isNull()),
                         ("missing amount", c("total_amount").isNull()),
                         ("negative amount", c("total_amount") < 0),
                         ("bad quantity", c("quantity").isNull() | (c("quantity") <= 0)),
                         ("bad discount", c("discount_pct").isNull() | ~c("discount_pct").between(0, 100))],
        "reviews": [("missing review_id", c("review_id").isNull()),
                    ("bad rating", ~c("rating").between(1, 5))],
        "social": [("missing post_id", c("post_id").isNull()),
                   ("negative likes", c("likes") < 0),
                   ("negative shares", c("shares") < 0)],
    }[source]
    needed = {
        "missing event_id": "event_id", "negative duration": "duration_sec",
        "missing order_id": "order_id", "missing amount": "total_amount",
        "negative amount": "total_amount", "bad quantity": "quantity",
        "bad discount": "discount_pct", "missing review_id": "review_id",
        "bad rating": "rating", "missing post_id": "post_id",
        "negative likes": "likes", "negative shares": "shares",
    }
    return [(r, cond) for r, cond in rules if needed[r] in cols]


def clean(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trim every string column but those in ``keep``; empty strings become null."""
    out = []
    for f in df.schema.fields:
        if f.name not in keep and isinstance(f.dataType, T.StringType):
            t = F.trim(F.col(f.name))
            out.append(F.when(t != "", t).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def dedup_latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the greatest by (``order``..., all other columns).

    A grouped ``max`` over a struct: partial aggregation runs before the
    shuffle, so a key repeated millions of times is collapsed on the map side
    instead of landing in one task. The full-row tie-break makes the choice
    deterministic.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order + rest])
    return (df.groupBy(key).agg(F.max(packed).alias("_r"))
              .select(key, *[F.col("_r")[c].alias(c) for c in order + rest])
              .select(*df.columns))


def reject_reason(source: str, cols: list[str]) -> Column:
    """The first rule that a row breaks, null for a valid row."""
    rules = _validity(source, cols)
    if not rules:
        return F.lit(None).cast("string")
    return reduce(lambda acc, rc: acc.when(rc[1], F.lit(rc[0])), rules[1:], F.when(rules[0][1], F.lit(rules[0][0])))


def validate(source: str, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with ``reject_reason``)."""
    tagged = df.withColumn("reject_reason", reject_reason(source, df.columns))
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))


class Lake:
    """Zones and partitions under one root folder."""

    def __init__(self, spark: SparkSession, root: str, raw_format: str = "json"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.raw_format = raw_format

    def path(self, zone: str, source: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}")
        return f"{self.root}/{zone}/{check_source(source)}"

    def stream_path(self, zone: str, source: str) -> str:
        """Where the landing streams of a source write."""
        return f"{self.root}/stream/{self.path(zone, source)[len(self.root) + 1:]}"

    def _fmt(self, zone: str) -> str:
        return self.raw_format if zone == "raw" else "parquet"

    def snapshots(self, source: str) -> Snapshots:
        """The versions of a source's processed and quarantine zones."""
        source = check_source(source)
        ids = tuple(c for c in (RECORD_KEY[source], CUSTOMER) if c)
        return Snapshots(self.spark, f"{self.root}/snapshots/{source}", PART, ids)

    def _write(self, df: DataFrame, zone: str, source: str, one_day: bool = False) -> None:
        """Replace the days of ``df``."""
        # ``rebalance`` on the day: small days get one file, a hot day is split
        # across tasks by AQE (no single task writes a 2 TB day). Rows of one day
        # are written by the tasks that hold them.
        w = ((df if one_day else df.hint("rebalance", PART)).write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic")
               .option("maxRecordsPerFile", FILE_ROWS)
               .partitionBy(PART)
               .format(self._fmt(zone)))
        if self._fmt(zone) != "parquet":
            w = w.options(**TEXT_TIME_OPTIONS).option("compression", "gzip")
        w.save(self.path(zone, source))

    def ingest_raw(self, source: str, df: DataFrame, date=None) -> None:
        """Land records of one source. ``date``: a day (str/date), a column
        giving each record's day (e.g. ``F.col("timestamp")``), or None for today."""
        check_source(source)
        self._write(df.withColumn(PART, _as_date_col(date)), "raw", source, one_day=not isinstance(date, Column))

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _present(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def exists(self, zone: str, source: str) -> bool:
        if zone != "raw" and self.snapshots(source).files(zone) is not None:
            return True
        return self._present(self.path(zone, source)) or self._present(self.stream_path(zone, source))

    def dates(self, zone: str, source: str) -> list[str]:
        """Days present, from the folders' names and the manifests (no row is read)."""
        found = set() if zone == "raw" else set(self.snapshots(source).days(zone))
        for path in (self.path(zone, source), self.stream_path(zone, source)):
            fs, p = self._fs(path)
            if fs.exists(p):
                found |= {s.getPath().getName().partition("=")[2] for s in fs.listStatus(p)
                          if s.isDirectory() and s.getPath().getName().startswith(f"{PART}=")}
        return sorted(found)

    def read(self, zone: str, source: str, schema: T.StructType | None = None,
             date=None, version: int | None = None) -> DataFrame:
        """A zone of one source, batch and stream landings together, optionally
        one day (only that day's folders or files are read). A missing zone gives
        an empty DataFrame with the schema. ``version`` reads the processed or
        quarantine zone as of an earlier commit (what streams landed isn't versioned)."""
        fmt = self._fmt(zone)
        full = None
        if schema is not None:
            full = T.StructType([f for f in schema.fields if f.name != PART]
                                + [T.StructField(PART, T.DateType())])
        parts = []
        if zone != "raw":
            if zone not in ZONES:
                raise ValueError(f"unknown zone {zone!r}")
            done = self.snapshots(source).read(zone, version, None if date is None else _as_date_col(date))
            if done is not None:
                parts.append(done if full is None else done.select(*[
                    (F.col(f.name) if f.name in done.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                    for f in full.fields]))
        elif version is not None:
            raise ValueError("the raw zone has no versions")
        paths = [p for p in (self.path(zone, source), self.stream_path(zone, source)) if self._present(p)]
        if not paths and not parts:
            if full is None:
                raise FileNotFoundError(self.path(zone, source))
            return self.spark.createDataFrame([], full)
        if full is None and zone == "quarantine":
            full = QUARANTINE
        elif full is None and paths and not self.dates(zone, source):
            full = T.StructType(SOURCES[check_source(source)].fields + [T.StructField(PART, T.DateType())])
        for path in paths:
            reader = self.spark.read.format(fmt)
            if fmt == "parquet" and full is not None:
                reader = reader.schema(full)
            if fmt != "parquet":
                reader = reader.options(**TEXT_TIME_OPTIONS)
                if full is not None:
                    reader = reader.schema(full).option("columnNameOfCorruptRecord", CORRUPT)
            landed = reader.load(path)
            parts.append(landed if date is None else landed.filter(F.col(PART) == _as_date_col(date)))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def as_of(self, source: str, version: int, zone: str = "processed") -> DataFrame:
        """A zone as the commit of that number left it."""
        found = self.snapshots(source).read(zone, version)
        if found is None:
            raise ValueError(f"version {version} of {source!r} has no zone {zone!r}")
        return found

    def lookup(self, source: str, values: list, column: str = CUSTOMER, zone: str = "processed") -> DataFrame:
        """Rows of some customers (or record ids): reads only the files that can hold them."""
        return self.snapshots(source).lookup(zone, column, values)

    def cluster(self, source: str, n_files: int, column: str = CUSTOMER, zone: str = "processed") -> int:
        """Write a zone's rows again in ``n_files`` ranges of (day, column), as one commit; the rows stay the same.

        Lookups by the column then read about one file a day. Returns the new version.
        """
        snapshots = self.snapshots(source)
        base = snapshots.version()
        rows = snapshots.read(zone, base)
        adds = snapshots.write_files(zone, rows, cluster_by=column, n_files=n_files)
        return snapshots.commit("cluster", {zone: Change(adds, snapshots.files(zone, base))}, base)

    def partitions(self, zone: str, source: str, schema: T.StructType | None = None) -> DataFrame:
        """Days present with their row counts (reads the rows; ``dates`` doesn't)."""
        return (self.read(zone, source, schema).groupBy(PART)
                .agg(F.count(F.lit(1)).alias("rows")).orderBy(PART))

    def promote(self, source: str, schema: T.StructType | None = None, date=None,
                order: list[str] | None = None) -> int:
        """Raw -> processed: trim, validate and keep one version of each record.

        Rejects go to quarantine with the text as landed: lines that don't
        parse, lines with a field that doesn't fit the schema, and rows that
        break a rule. Of several versions of a record the one that landed on the
        last day stays, of one day's the last by ``order`` and then by all
        columns. Transactions have no line id: a row that landed on several
        days is a replay and counts for the last of them, equal rows of one day
        are separate lines.

        Without ``date`` the whole zone is replaced; with it that day, and the
        earlier days' records that it supersedes are taken out: the files that
        hold one are written again without them, in one job for all days. Either
        way a day that has become empty is emptied. Both zones change in one commit,
        so readers meet the state before or after it, and a job that dies
        changes nothing. The raw text is parsed once, into a work table in the
        shared scratch folder. Returns the version.
        """
        with shuffles_freed(self.spark):
            return self._promote(source, schema, date, order)

    def _promote(self, source: str, schema: T.StructType | None, date, order: list[str] | None) -> int:
        snapshots = self.snapshots(source)
        base = snapshots.version()
        raw = self.read("raw", source, None if schema is None else with_corrupt_column(schema), date)
        bad_line = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
        cols = [c for c in raw.columns if c != CORRUPT]
        data = [c for c in cols if c != PART]
        landed = raw.withColumn("__line", bad_line).withColumn("__landed", F.struct(*data))
        checked = clean(landed, keep=("__line",)).select(*cols, "__line", "__landed", F.when(
            F.col("__line").isNotNull(), F.lit(UNREADABLE)).otherwise(reject_reason(source, cols)).alias("reject_reason"))
        path = scratch_path(self.spark, f"promote-{source}")
        # only rejects carry their text
        text = F.coalesce("__line", F.to_json("__landed", TEXT_TIME_OPTIONS))
        (checked.select(*cols, "reject_reason", F.when(F.col("reject_reason").isNotNull(), text).alias("__raw"))
         .write.option("compression", "zstd").parquet(path))
        rows = self.spark.read.parquet(path)
        key = RECORD_KEY[source] if RECORD_KEY[source] in rows.columns else None
        key_text = F.when(F.col("reject_reason") != UNREADABLE, F.col(key).cast("string")) if key else F.lit(None).cast("string")
        bad = rows.where("reject_reason IS NOT NULL").select(
            key_text.alias("key"), F.col("__raw").alias("raw_value"), "reject_reason", PART)
        good = rows.where("reject_reason IS NULL").select(*cols)
        good_schema = T.StructType([good.schema[c] for c in cols])

        def with_id(df: DataFrame) -> DataFrame:
            # half of the 256 bits tells rows apart; every row sends its id to disk
            return df.withColumn("__id", F.col(key) if key else F.unhex(F.substring(
                F.sha2(encode_json_column(df, data), 256), 1, 32)))

        days: list[str] = []
        if date is not None:
            day = self.spark.range(1).select(_as_date_col(date).alias("d")).first().d
            one_day = F.lit(day)
        else:
            good = good.where(F.col(PART).isNotNull())
            days = self.dates("raw", source)
            one_day = F.lit(days[0]).cast("date") if len(days) == 1 and days[0] != NO_DAY else None
            days = [d for d in days if d != NO_DAY]
        if key:
            good = self._one_version(good, key, [PART] + (order or [c for c in ("timestamp",) if c in good.columns]))
        gone, gone_bad = snapshots.files("processed", base), snapshots.files("quarantine", base)
        kept = None
        if date is not None and gone is not None:
            others, gone, gone_bad = gone.where(F.col("day") != day), gone.where(F.col("day") == day), gone_bad.where(
                F.col("day") == day)

            def known(files: DataFrame) -> DataFrame:
                return with_id(snapshots.read_files(files, good_schema))

            earlier, later = others.where(F.col("day") < day), others.where(F.col("day") > day)
            if not later.isEmpty():
                good = with_id(good).join(known(later).select("__id"), "__id", "left_anti").select(*cols)
            if not earlier.isEmpty():
                ids = with_id(good).select("__id").distinct()
                hit = (known(earlier).select("__id", F.col("_metadata.file_path").alias("path"))
                       .join(ids, "__id", "left_semi").select("path").distinct())
                path = scratch_path(self.spark, f"superseded-{source}")
                hit.write.parquet(path)
                hit = earlier.join(self.spark.read.schema(hit.schema).parquet(path), "path", "left_semi")
                kept = known(hit).join(ids, "__id", "left_anti").select(*cols)
                gone = gone.unionByName(hit)
        if kept is None and not key and len(days) > 1:
            # nothing supersedes the last day's rows, which are written as they lie; those of earlier days stay if none
            # of a later day is the same
            newest = F.lit(days[-1]).cast("date")
            early = self._not_replayed(good, with_id, newest)
            adds = snapshots.write_files("processed", good.where(F.col(PART) == newest), one_day=newest)
            if early is not None:
                adds = adds.unionByName(snapshots.write_files("processed", early))
        elif kept is None:
            adds = snapshots.write_files("processed", good, one_day=one_day)
        else:
            adds = snapshots.write_files("processed", good.unionByName(kept))
        return snapshots.commit("promote", {
            "processed": Change(adds, gone, good_schema),
            "quarantine": Change(snapshots.write_files("quarantine", bad, one_day=one_day), gone_bad, QUARANTINE)}, base)

    def _not_replayed(self, rows: DataFrame, with_id: Callable[[DataFrame], DataFrame], newest: Column) -> DataFrame | None:
        """Rows of the days before ``newest`` that are on no later day, None if there are none.

        Ids are grouped and counted first, a part of them after the other, so that the ids of one part are on disk at a
        time: rows are joined only where some days' rows stay and others go, and then meet the fewer of both.
        """
        def grouped(some: DataFrame) -> DataFrame:
            return (with_id(some).select("__id", PART).groupBy("__id")
                    .agg(F.min(PART).alias("__first"), F.max(PART).alias("__last")))

        ids = grouped(rows)
        stay, gone = F.col("__last") < newest, F.col("__first") < F.col("__last")
        # equal rows are in one part, whatever columns tell it
        plain = [f.name for f in rows.schema if f.name != PART and not isinstance(
            f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
        part = F.pmod(F.xxhash64(F.lit(0), *plain), F.lit(ID_PARTS))
        counts = [grouped(rows.where(part == k)).agg(F.count_if(stay), F.count_if(gone)).first() for k in range(ID_PARTS)]
        n_stay, n_gone = map(sum, zip(*counts))
        early = rows.where(F.col(PART) < newest)
        if not n_stay:
            return None
        if not n_gone:
            return early
        if n_stay <= n_gone:
            found = with_id(early).join(ids.where(stay).select("__id", F.col("__last").alias(PART)), ["__id", PART], "left_semi")
        else:
            later = ids.where(gone).select(F.col("__id").alias("__gone"), "__last")
            found = with_id(early).join(later, (F.col("__id") == F.col("__gone")) & (F.col(PART) < F.col("__last")), "left_anti")
        return found.select(*rows.columns)

    def _one_version(self, rows: DataFrame, key: str, order: list[str]) -> DataFrame:
        """``dedup_latest``, but records that come once are passed on as they are: only the ids are grouped for them.

        The ids that come more than once are kept in a work table; where they are most of the rows, all rows are
        grouped at once.
        """
        path = scratch_path(self.spark, "repeated")
        rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").write.parquet(path)
        repeated = self.spark.read.schema(f"`{key}` {rows.schema[key].dataType.simpleString()}, __n long").parquet(path)
        n = repeated.agg(F.sum("__n")).first()[0]
        if not n:
            return rows
        if 4 * n > rows.count():
            return dedup_latest(rows, key, order)
        again = rows.join(repeated.select(key), key, "left_semi").select(*rows.columns)
        return rows.join(repeated.select(key), key, "left_anti").select(*rows.columns).unionByName(
            dedup_latest(again, key, order))

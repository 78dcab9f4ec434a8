"""Snapshot tables: Parquet files that a log of commits adds to a table and takes out of it.

Layout under a root: ``data/<id>/...`` holds the files of one write, ``log/<id>/<zone>/files`` the Parquet manifest of
one commit (which files it adds and removes, with rows, bytes, day and the range of each id column),
``log/<id>/<zone>/blooms`` Bloom filters of the id columns, and ``log/<version>.json`` the commit itself: a small
marker that is written under another name and then renamed. The rename is the only step that readers see; it fails
if the version exists, and the writer then looks at what came between. A job that dies before it leaves files that no
version names. Files are never changed, so each version can be read for as long as its files are kept.

One log serves several zones: a commit changes all of them or none. Every ``FULL_EVERY`` versions a manifest lists
all live files, so reading a version meets at most that many manifests. What the driver holds is names of files and
days, as Spark's own file listing does; rows, statistics and filters are computed by jobs.

The Bloom filters are blocked: an id has one block of 32,768 bits and ``BITS`` bits in it; a lookup reads one block a
file. A task sets the bits of the file it reads in one array and sends on whole blocks, so neither its memory nor what
is shuffled follows the number of ids times the bits of each.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import uuid
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FULL_EVERY = 10
#: Bits of a block, bits set for an id, bits planned for an id.
BLOCK, BITS, BITS_AN_ID = 32768, 4, 12
#: Rows of a file at most, which bounds the array that its filter is made in.
FILE_ROWS = 1_000_000


class CommitConflict(RuntimeError):
    """Another commit changed the same days since this one read them."""


@dataclass
class Change:
    """What a commit does to one zone: files to add (from ``write_files``) and the paths to remove."""

    adds: DataFrame | None = None
    removes: DataFrame | None = None
    schema: T.StructType | None = None


class Snapshots:
    """Versions of the zones under one root. ``day`` is the column that files are cut by (a date, or a bucket number),
    ``ids`` the id columns that files are described by (those that a zone has)."""

    def __init__(self, spark: SparkSession, root: str, day: str, ids: tuple[str, ...] = ()):
        self.spark, self.root, self.day, self.ids = spark, root.rstrip("/"), day, ids

    # ---------------------------------------------------------------- log

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """All versions, from the log's file names; an empty list before the first commit."""
        fs, log = self._fs(), self._path("log")
        if not fs.exists(log):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(log)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        """The latest version, 0 before the first commit."""
        return max(self.versions(), default=0)

    def marker(self, version: int) -> dict:
        """A commit: ``version``, ``operation``, ``committed`` and for each zone its manifest, schema and days."""
        stream = self._fs().open(self._path("log", f"{version:020d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, marker: dict) -> bool:
        """Rename the marker into place; False if the version exists."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        temporary = self._path("log", f".{uuid.uuid4().hex}")
        out = self._fs().create(temporary, True)
        out.write(bytearray(json.dumps(marker).encode()))
        out.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(rename, 1)
        none[0] = rename.NONE
        target = self._path("log", f"{marker['version']:020d}.json")
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(temporary, target, none)
            return True
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception.getClass().getName()):
                raise
            return False

    def _zone_markers(self, zone: str, version: int | None) -> list[dict]:
        """The zone's part of the commits up to a version, latest first, back to one with all live files."""
        versions = self.versions()
        if version is not None and version not in versions and version != 0:
            raise ValueError(f"no version {version} of {self.root}")
        found = []
        for v in reversed([v for v in versions if version is None or v <= version]):
            part = self.marker(v)["zones"].get(zone)
            if part:
                found.append(part)
                if part["full"]:
                    break
        return found

    def files(self, zone: str, version: int | None = None) -> DataFrame | None:
        """Live files of a version: ``path, day, rows, bytes, blooms, n_blocks`` and ``lo_<id>``, ``hi_<id>``; None
        if the zone was never written."""
        parts = self._zone_markers(zone, version)
        if not parts:
            return None
        kinds: dict[str, list[str]] = {}
        for p in parts:
            kinds.setdefault(p["columns"], []).append(p["manifest"])
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                      [self.spark.read.schema(T.StructType.fromJson(json.loads(c))).parquet(*paths)
                       for c, paths in kinds.items()])
        gone = rows.where("action = 'remove'").select("path").distinct()
        return rows.where("action = 'add'").drop("action").join(gone, "path", "left_anti")

    def schema(self, zone: str, version: int | None = None) -> T.StructType | None:
        """The zone's columns in a version."""
        for v in reversed([v for v in self.versions() if version is None or v <= version]):
            part = self.marker(v)["zones"].get(zone)
            if part and part["schema"]:
                return T.StructType.fromJson(json.loads(part["schema"]))
        return None

    # ---------------------------------------------------------------- rows

    def read_files(self, files: DataFrame, schema: T.StructType) -> DataFrame:
        """Rows of files named by ``path``."""
        paths = [unquote(r.path) for r in files.select("path").collect()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def read(self, zone: str, version: int | None = None, date: Column | None = None) -> DataFrame | None:
        """A zone as of a version (the latest by default), optionally one day, whose files alone are read."""
        files = self.files(zone, version)
        if files is None:
            return None
        if date is None:
            return self.read_files(files, self.schema(zone, version))
        return self.read_files(files.where(F.col("day") == date), self.schema(zone, version)).where(F.col(self.day) == date)

    def days(self, zone: str, version: int | None = None) -> list[str]:
        """Days that have files, from the manifests."""
        files = self.files(zone, version)
        return [] if files is None else sorted(
            str(r.day) for r in files.where("day IS NOT NULL").select("day").distinct().collect())

    def write_files(self, zone: str, df: DataFrame, cluster_by: str | None = None, n_files: int | None = None,
                    one_day: Column | None = None) -> DataFrame:
        """Write rows as files of one day each, not yet part of any version -> what ``commit`` adds.

        By default tasks hold the days that AQE makes of them; with ``cluster_by`` rows are dealt to ``n_files``
        ranges of (day, column), which makes the ranges of that column in the files narrow. Rows that are known to be
        of ``one_day`` (a literal) are written by the tasks that hold them, without a shuffle.
        """
        ident = uuid.uuid4().hex
        path = f"{self.root}/data/{ident}"
        if cluster_by:
            rows = df.repartitionByRange(n_files or 1, self.day, cluster_by).sortWithinPartitions(self.day, cluster_by)
        else:
            rows = df.hint("rebalance", self.day) if one_day is None else df
        (rows.withColumn("_day", F.col(self.day) if one_day is None else one_day)
         .write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("_day").parquet(path))
        ids = [c for c in self.ids if c in df.columns]
        log = f"{self.root}/log/{ident}/{zone}"
        written = self.spark.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(path)
        written = written.select("*", F.col("_metadata.file_path").alias("__path"),
                                 F.col("_metadata.file_size").alias("__size"))
        stats = (written.groupBy(F.col("__path").alias("path"))
                 .agg(F.min(self.day).alias("day"), F.count(F.lit(1)).alias("rows"), F.first("__size").alias("bytes"),
                      *[f(c).alias(f"{n}_{c}") for c in ids for n, f in (("lo", F.min), ("hi", F.max))]))
        stats.write.parquet(f"{log}/written")
        stats = self.spark.read.schema(stats.schema).parquet(f"{log}/written")
        most = stats.agg(F.max("rows")).first()[0] or 0
        n_blocks = 1 << max(0, math.ceil(math.log2(max(1, most) * BITS_AN_ID / BLOCK)))
        if ids and most:
            places = written.select(F.xxhash64("__path").alias("file"), *[
                F.when(text.isNotNull(), _block(text, n_blocks).cast("long") * BLOCK + bit).alias(f"{c}_{i}")
                for c in ids for text in [F.col(c).cast("string")] for i, bit in enumerate(_bits(text, as_list=True))])
            blocks = places.mapInArrow(_filter_blocks(ids, n_blocks), _BLOCKS)
            # a file that several tasks read has blocks from each
            (blocks.join(stats.select("path", F.xxhash64("path").alias("file")), "file")
             .groupBy("path", "id_column", "block").agg(F.bitmap_or_agg("bits").alias("bits"))
             .write.parquet(f"{log}/blooms"))
        return stats.withColumn("blooms", F.lit(f"{log}/blooms" if ids and most else None).cast("string")).withColumn(
            "n_blocks", F.lit(n_blocks))

    # ---------------------------------------------------------------- commit

    def commit(self, operation: str, changes: dict[str, Change], read_version: int, note: dict | None = None) -> int:
        """Publish changes that were made from ``read_version`` as one new version, and return it.

        If others committed meanwhile the version moves on, unless they touched a day of this change. ``note`` is
        kept in the marker (see ``note``): how far a reader of another table has got, say.
        """
        ident = uuid.uuid4().hex
        zones, days, manifests = {}, {}, {}
        for zone, c in changes.items():
            live = self.files(zone, read_version)
            parts = []
            if c.adds is not None:
                parts.append(c.adds.withColumn("action", F.lit("add")))
            if c.removes is not None and live is not None:
                parts.append(live.join(c.removes.select("path").distinct(), "path", "left_semi")
                             .withColumn("action", F.lit("remove")))
            if not parts:
                continue
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
            path = f"{self.root}/log/{ident}/{zone}/files"
            rows.write.parquet(path)
            manifests[zone] = self.spark.read.schema(rows.schema).parquet(path)
            days[zone] = sorted(str(r.day) for r in manifests[zone].select("day").distinct().collect())
            schema = c.schema or self.schema(zone, read_version)
            zones[zone] = {"manifest": path, "full": live is None, "schema": schema.json() if schema else None,
                           "columns": rows.schema.json(), "days": days[zone]}
        seen = read_version
        while True:
            for v in range(seen + 1, self.version() + 1):
                for zone, part in self.marker(v)["zones"].items():
                    if set(part["days"]) & set(days.get(zone, ())):
                        raise CommitConflict(f"version {v} changed {zone} on {sorted(set(part['days']) & set(days[zone]))}")
                seen = v
            version = seen + 1
            if version % FULL_EVERY == 0:
                for zone in manifests:
                    self._write_full(zone, zones[zone], manifests[zone], seen, f"{self.root}/log/{ident}/{zone}/all-{version}")
            if self._publish({"version": version, "operation": operation, "zones": zones, "note": note or {},
                              "committed": _dt.datetime.now(_dt.timezone.utc).isoformat()}):
                return version

    def _write_full(self, zone: str, part: dict, change: DataFrame, seen: int, path: str) -> None:
        """Replace a commit's manifest by one of all live files (and what the commit removes)."""
        live = self.files(zone, seen)
        if live is not None:
            gone = change.where("action = 'remove'").select("path")
            change = change.unionByName(live.join(gone, "path", "left_anti").withColumn("action", F.lit("add")),
                                        allowMissingColumns=True)
        change.write.parquet(path)
        part.update(manifest=path, full=True, columns=change.schema.json())

    def note(self, key: str, default=None):
        """The latest commit's note of this name."""
        for v in reversed(self.versions()):
            found = self.marker(v).get("note", {})
            if key in found:
                return found[key]
        return default

    def changed_days(self, zone: str, after: int, upto: int | None = None) -> list[str]:
        """Days of a zone that commits after one version (up to another) wrote, replaced or emptied."""
        found = set()
        for v in self.versions():
            if v > after and (upto is None or v <= upto):
                found |= set(self.marker(v)["zones"].get(zone, {"days": ()})["days"])
        return sorted(found - {"None"})

    # ---------------------------------------------------------------- data skipping

    def files_with(self, zone: str, column: str, values: list, version: int | None = None) -> DataFrame:
        """Live files that can hold one of some values of an id column: those whose range and Bloom filter admit it."""
        if column not in self.ids:
            raise ValueError(f"{column!r} is not one of the id columns {self.ids}")
        files = self.files(zone, version)
        if files is None or f"lo_{column}" not in files.columns:
            raise ValueError(f"zone {zone!r} has no {column!r}")
        blooms = [r.blooms for r in files.select("blooms").distinct().collect() if r.blooms]
        kind = files.schema[f"lo_{column}"].dataType
        wanted = self.spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("value", kind)]))
        near = files.join(F.broadcast(wanted), (F.col("value") >= F.col(f"lo_{column}"))
                          & (F.col("value") <= F.col(f"hi_{column}")))
        if not blooms:
            return near.drop("value").distinct()
        text = F.col("value").cast("string")
        near = near.withColumn("block", _block(text, F.col("n_blocks")))
        filters = self.spark.read.parquet(*blooms).where(F.col("id_column") == column).select("path", "block", "bits")
        admits = reduce(lambda a, b: a & b, [_bit_set(F.col("bits"), _bits(text)[i]) for i in range(BITS)])
        return near.join(filters, ["path", "block"]).where(admits).drop("value", "block", "bits").dropDuplicates(["path"])

    def lookup(self, zone: str, column: str, values: list, version: int | None = None) -> DataFrame:
        """Rows whose id column has one of some values; only files that can hold them are read."""
        return self.read_files(self.files_with(zone, column, values, version), self.schema(zone, version)).where(
            F.col(column).isin(values))


def _block(ident: Column, n_blocks) -> Column:
    return F.pmod(F.xxhash64(ident), n_blocks if isinstance(n_blocks, Column) else F.lit(n_blocks)).cast("int")


def _bits(ident: Column, as_list: bool = False):
    bits = [F.pmod(F.xxhash64(ident, F.lit(i)), F.lit(BLOCK)) for i in range(BITS)]
    return bits if as_list else F.array(*bits)


_BLOCKS = "file long, id_column string, block int, bits binary"


def _filter_blocks(ids: list[str], n_blocks: int):
    """Blocks of Bloom filters from the places of bits (``<id>_<i>``, null without an id), a file's rows after each other."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        kinds = pa.schema([("file", pa.int64()), ("id_column", pa.string()), ("block", pa.int32()), ("bits", pa.binary())])

        def blocks(file, held):
            for c, places in held.items():
                packed = np.packbits(places, bitorder="little").reshape(n_blocks, -1)
                found = np.flatnonzero(packed.any(axis=1))
                for at in range(0, len(found), 256):
                    part = found[at:at + 256]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([file] * len(part), pa.int64()), pa.array([c] * len(part), pa.string()),
                        pa.array(part, pa.int32()), pa.array([packed[k].tobytes() for k in part], pa.binary())], schema=kinds)

        current, held = None, {}
        for batch in batches:
            files = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1), len(files)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if current is None or files[lo] != current:
                    yield from blocks(current, held)
                    current, held = int(files[lo]), {c: np.zeros(n_blocks * BLOCK, bool) for c in ids}
                rows = batch.slice(lo, hi - lo)
                for k, c in enumerate(ids):
                    for i in range(BITS):
                        held[c][rows.column(1 + k * BITS + i).drop_null().to_numpy()] = True
        yield from blocks(current, held)
    return run


def _bit_set(bits: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.expr("1") == F.floor(byte / F.pow(F.lit(2), at % 8)).cast("int") % 2

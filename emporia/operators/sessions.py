"""Sessions by inactivity gap, over all rows at once or run after run.

A session ends with the last event that no other follows within ``gap``. Events of one customer and one stretch of
``gap`` seconds belong together whatever else there is, so they become one interval first, by a partial aggregate:
a customer of a third of all events is as many intervals as their time has stretches, not as many rows as events.

Day-by-day runs carry the sessions that the next events could still join as a table of open sessions; closed ones are
appended. Each run is one commit of both tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emporia.sources.snapshots import Change, Snapshots

GAP = 30 * 60
KEY, TIME = "customer_id", "timestamp"
_SUMS = ("clicks", "total_time_sec")


def intervals(events: DataFrame, gap: int = GAP) -> DataFrame:
    """Events as ``customer_id, session_start, session_end, clicks, total_time_sec``, one row for each stretch of
    ``gap`` seconds. Events without a customer or a time belong to no session."""
    kind = events.schema[TIME].dataType
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(kind), F.col(TIME))
    return (events.where(F.col(KEY).isNotNull() & F.col(TIME).isNotNull())
            .groupBy(KEY, F.floor(micros / F.lit(gap * 1_000_000)).alias("_stretch"))
            .agg(F.min(TIME).alias("session_start"), F.max(TIME).alias("session_end"),
                 F.count("event_id").alias("clicks"), F.sum("duration_sec").alias("total_time_sec")).drop("_stretch"))


def merge_intervals(parts: DataFrame, gap: int = GAP) -> DataFrame:
    """Intervals that lie less than ``gap`` seconds apart become one session."""
    by_start = Window.partitionBy(KEY).orderBy("session_start", "session_end")
    before = F.max("session_end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opens = before.isNull() | (F.col("session_start") >= before + F.expr(f"INTERVAL {gap} SECOND"))
    numbered = parts.withColumn("_opens", opens.cast("long")).withColumn("_session", F.sum("_opens").over(by_start))
    return (numbered.groupBy(KEY, "_session")
            .agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
                 *[F.sum(c).alias(c) for c in _SUMS]).drop("_session"))


def gap_sessions(events: DataFrame, gap: int = GAP) -> DataFrame:
    """One row for each session of ``events(event_id, customer_id, timestamp, duration_sec)``."""
    return merge_intervals(intervals(events, gap), gap)


class SessionRuns:
    """Sessions of a growing table, computed run after run under one folder."""

    def __init__(self, spark: SparkSession, root: str, gap: int = GAP):
        self.gap = gap
        self.table = Snapshots(spark, root, "session_date", (KEY,))

    def upto(self) -> _dt.datetime | None:
        """End of the time that runs have covered."""
        done = self.table.note("upto")
        return _dt.datetime.fromisoformat(done) if done else None

    def run(self, events: DataFrame, upto: _dt.datetime) -> int:
        """Add the events from the last run's end to ``upto`` (not included) -> version.

        Rows outside that time are not read; a run again for time that is covered raises. Open sessions are read from
        the state, never earlier events.
        """
        last = self.upto()
        if last is not None and upto <= last:
            raise ValueError(f"time before {last} is covered")
        end = F.lit(upto.isoformat(sep=" ")).cast(events.schema[TIME].dataType)
        rows = events.where(F.col(TIME) < end)
        if last is not None:
            rows = rows.where(F.col(TIME) >= F.lit(last.isoformat(sep=" ")).cast(events.schema[TIME].dataType))
        base = self.table.version()
        parts = intervals(rows, self.gap)
        old = self.table.read("open", base)
        if old is not None:
            parts = parts.unionByName(old.select(*parts.columns))
        found = merge_intervals(parts, self.gap).withColumn("session_date", F.to_date("session_start"))
        found = found.withColumn("is_open", F.col("session_end") + F.expr(f"INTERVAL {self.gap} SECOND") > end)
        # merged once into files of this run, which are then dealt to the two tables
        written = self.table.read_files(self.table.write_files("merged", found), found.schema)
        schema = found.drop("is_open").schema
        return self.table.commit("sessions", {
            "closed": Change(self.table.write_files("closed", written.where("NOT is_open").drop("is_open")), None, schema),
            "open": Change(self.table.write_files("open", written.where("is_open").drop("is_open")),
                           self.table.files("open", base), schema)},
            base, note={"upto": upto.isoformat()})

    def sessions(self, version: int | None = None) -> DataFrame:
        """All sessions so far, open ones as they stand."""
        closed, still = self.table.read("closed", version), self.table.read("open", version)
        return closed.unionByName(still).drop("session_date")

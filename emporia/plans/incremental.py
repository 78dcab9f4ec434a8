"""Views that are refreshed by what changed in the lake.

A view keeps one table of partial aggregates, cut by lake day (``ingest_date``), and the number of the lake version it
has seen. A refresh asks the lake's log which days later commits touched, aggregates those days' files alone, and
replaces the partials of those days in one commit: what a replaced day no longer holds is thereby retracted, whatever
the aggregate. The published result merges the partials of all days, which are far fewer than the rows.

Sums, counts, minima and maxima merge as they are; a distinct count keeps its value as a further key of the partials.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.functions.money import cents_to_double, net_cents
from emporia.functions.rules import is_not_cancelled
from emporia.plans.publish import publish_table
from emporia.sources.lake import PART, Lake
from emporia.sources.snapshots import Change, Snapshots


@dataclass(frozen=True)
class DayView:
    """``partial`` turns rows into aggregates by ``ingest_date`` and keys, ``finish`` those of all days into the result."""

    name: str
    source: str
    partial: Callable[[DataFrame], DataFrame]
    finish: Callable[[DataFrame], DataFrame]


def _pages(w: DataFrame) -> DataFrame:
    return w.groupBy(PART, "page", "session_id").agg(
        F.count("event_id").alias("views"), F.sum("duration_sec").alias("duration"),
        F.count("duration_sec").alias("timed"))


def _pages_all(p: DataFrame) -> DataFrame:
    return p.groupBy("page").agg(
        F.sum("views").alias("total_views"), F.count_distinct("session_id").alias("unique_sessions"),
        F.try_divide(F.sum("duration").cast("double"), F.sum("timed")).alias("avg_duration_sec"))


def _countries(w: DataFrame) -> DataFrame:
    return w.groupBy(PART, "country", "customer_id").agg(F.count("event_id").alias("events"))


def _countries_all(p: DataFrame) -> DataFrame:
    return p.groupBy("country").agg(F.sum("events").alias("events"),
                                    F.count_distinct("customer_id").alias("unique_customers"))


def _categories(t: DataFrame) -> DataFrame:
    net = net_cents("total_amount", "discount_pct")
    return t.where(is_not_cancelled("status")).groupBy(PART, "category").agg(
        F.sum(net).alias("net"), F.count(net).alias("priced"), F.count("order_id").alias("orders"))


def _categories_all(p: DataFrame) -> DataFrame:
    net = cents_to_double(F.sum("net"))
    return p.groupBy("category").agg(net.alias("total_revenue"), F.sum("orders").alias("orders"),
                                     F.try_divide(net, F.sum("priced")).alias("avg_order_value"))


VIEWS = {v.name: v for v in (
    DayView("page_popularity", "weblogs", _pages, _pages_all),
    DayView("country_traffic", "weblogs", _countries, _countries_all),
    DayView("revenue_by_category", "transactions", _categories, _categories_all))}


class IncrementalViews:
    """Views of a lake, with their partials under ``root``."""

    def __init__(self, lake: Lake, root: str):
        self.lake = lake
        self.root = root.rstrip("/")
        self.state = Snapshots(lake.spark, f"{self.root}/partials", PART)

    def refresh(self, view: DayView) -> dict:
        """Bring a view up to the lake's latest version -> ``version``, the ``days`` and the number of ``files`` read.

        Nothing is read if no commit touched the view's source. A refresh that dies leaves the view as it was.
        """
        source = self.lake.snapshots(view.source)
        upto, seen = source.version(), self.state.note(view.name, 0)
        days = source.changed_days("processed", seen, upto)
        if not days:
            return {"version": seen, "days": [], "files": 0}
        base = self.state.version()
        wanted = F.col("day").isin([F.lit(d).cast("date") for d in days])
        files = source.files("processed", upto).where(wanted)
        rows = source.read_files(files, source.schema("processed", upto))
        old = self.state.files(view.name, base)
        partials = view.partial(rows)
        self.state.commit("refresh", {view.name: Change(
            self.state.write_files(view.name, partials), None if old is None else old.where(wanted), partials.schema)},
            base, note={view.name: upto})
        return {"version": upto, "days": days, "files": files.count()}

    def result(self, view: DayView) -> DataFrame:
        """The view as of its last refresh."""
        return view.finish(self.state.read(view.name))

    def publish(self, view: DayView, database: str | None = "emporia", table: str | None = None) -> str:
        """Refresh and publish; the table's location only moves if a commit touched the view."""
        done = self.refresh(view)
        name = table or view.name
        qualified = f"{database}.{name}" if database else name
        if not done["days"] and self.lake.spark.catalog.tableExists(qualified):
            return qualified
        return publish_table(self.lake.spark, self.result(view), name, self.root, database)

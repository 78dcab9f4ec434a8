"""Registry: query name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the driver's whole tables through the source adapters.
The oracle SQL is an independent statement of the same result for DuckDB
(tables pre-registered as views); keys without SQL are checked on rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emporia.sources.fixtures import ADAPTERS, with_sources

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def on_source(name: str, source: str, op, sql: str | None = None, **kw):
    """Register ``op(adapter(source))``; ``sql`` is the body after the source CTE."""
    adapter = ADAPTERS[source]

    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return op(adapter(spark, sf_dir), **kw)

    fn.__name__ = name
    register(name, None if sql is None else with_sources(source) + sql)(fn)
    return fn


def _load_all():
    # Importing the modules fills the registry.
    from emporia.plans import queries_batch  # noqa: F401
    from emporia.plans import queries_c360  # noqa: F401
    from emporia.plans import queries_growing  # noqa: F401
    from emporia.plans import queries_infer  # noqa: F401
    from emporia.plans import queries_io  # noqa: F401
    from emporia.plans import queries_stream  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)

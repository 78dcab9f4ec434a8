"""Compare a Spark result with DuckDB SQL over the same Parquet tables.

Mirrors the driver's gate: same column names, same row count and the same
multiset of rows (order-insensitive). Values are compared exactly; doubles
are compared by their repr, timestamps and dates as Python objects.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
from collections import Counter

from emporia.sources.tables import TABLES, table_path


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def spark_rows(df):
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    return cols, rows


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = rel.columns
    rows = rel.fetchall()
    return cols, rows


def compare(df, con, sql, show: int = 5) -> dict:
    scols, srows = spark_rows(df)
    dcols, drows = duck_rows(con, sql)
    out = {"spark_rows": len(srows), "oracle_rows": len(drows),
           "spark_cols": scols, "oracle_cols": dcols}
    if sorted(scols) != sorted(dcols):
        out["ok"] = False
        out["why"] = "columns differ"
        return out
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    sc = Counter(tuple(_norm(r[i]) for i in order) for r in srows)
    dc = Counter(tuple(_norm(r[i]) for i in dorder) for r in drows)
    out["ok"] = sc == dc
    if not out["ok"]:
        out["why"] = "values differ"
        out["only_spark"] = list((sc - dc).elements())[:show]
        out["only_oracle"] = list((dc - sc).elements())[:show]
        out["columns_sorted"] = [scols[i] for i in order]
    return out

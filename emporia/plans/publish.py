"""Publishing results as Parquet folders and session-catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from emporia.sources.files import save_results


def publish_table(spark: SparkSession, df: DataFrame, name: str, root: str,
                  database: str | None = "emporia", partition_by: str | None = None,
                  snapshots: bool = False) -> str:
    """Write ``df`` as Parquet and register it as an external table
    ``database.name`` (or ``name`` in the current database when ``database`` is
    None) in the session catalog (Hive metastore when the session has one).
    Returns the table name.

    Every publication is a new folder ``root/name/version=<id>``, written whole
    before the table's location is switched to it, so readers never meet a
    table that is half written or missing.

    With ``partition_by`` the table is partitioned on that column; ``rebalance``
    on it lets AQE give small partitions one file and split a hot one. With
    ``snapshots`` the folder stays ``root/name`` and only the partitions in
    ``df`` are replaced: older ones are kept.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    qualified = f"{database}.{name}" if database else name
    path = f"{root.rstrip('/')}/{name}"
    if not snapshots:
        path = f"{path}/version={uuid.uuid4().hex[:12]}"
    if partition_by:
        df = df.hint("rebalance", partition_by)
    w = df.write.mode("overwrite").format("parquet").option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)
    if spark.catalog.tableExists(qualified):
        old = spark.table(qualified)
        if snapshots or (not partition_by and old.schema.simpleString() == df.schema.simpleString()):
            spark.sql(f"ALTER TABLE {qualified} SET LOCATION '{path}'")
        else:  # the columns or the partitions' places change: the definition is replaced, the files stay
            spark.sql(f"DROP TABLE {qualified}")
    if not spark.catalog.tableExists(qualified):
        columns = [f for f in df.schema.fields if f.name != partition_by]
        columns += [f for f in df.schema.fields if f.name == partition_by]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
        by = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
        spark.sql(f"CREATE TABLE {qualified} ({ddl}) USING parquet {by} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
    spark.catalog.refreshTable(qualified)
    return qualified


def publish_views(spark: SparkSession, results: dict[str, DataFrame], root: str,
                  fmt: str = "parquet", database: str | None = "emporia",
                  partitions: dict[str, str] | None = None,
                  snapshots: tuple[str, ...] = ()) -> dict[str, str]:
    """Write every result (Parquet by default); with ``database`` also register tables.

    ``partitions`` maps a result name to the column its table is partitioned on;
    results in ``snapshots`` keep the partitions of earlier publications.
    """
    out = {}
    for name, df in results.items():
        if database and fmt == "parquet":
            out[name] = publish_table(spark, df, name, root, database,
                                      (partitions or {}).get(name), name in snapshots)
        else:
            path = f"{root.rstrip('/')}/{name}"
            save_results(df, path, fmt)
            out[name] = path
    return out

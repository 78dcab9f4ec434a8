"""Session helpers.

Library code never sets ``master``: it takes the session from the caller.
``local_session`` exists for tests, the bench and the command line only.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE coalesces small shuffle partitions,
# splits skewed join partitions and turns joins into broadcast joins only when
# the runtime size of a side is below the threshold (a checked size).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even when an aggregate above reuses the
    # join's partitioning (facts joined and grouped on the same customer key);
    # AQE then adds one shuffle, fed by the partial aggregate of the pieces
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def local_session(app: str = "emporia", cores: str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    if "spark.sql.warehouse.dir" not in (extra or {}):
        builder = builder.config("spark.sql.warehouse.dir",
                                 tempfile.mkdtemp(prefix="run-warehouse-", dir="/tmp"))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3A,
    ...), and it is used as is. Only in local mode, where all tasks share one
    machine, a missing setting is replaced by a fresh local folder; elsewhere
    it is an error, since executors would each write to a disk of their own.
    """
    jsc = spark.sparkContext._jsc.sc()
    current = jsc.getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for written intermediate tables (lineage cuts, round trips through a
    file format, stream checkpoints). Each call gets a new folder, so reruns
    never clear anything.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/emporia/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Jobs run inside lose their shuffle files as each of them ends, not when the driver next collects garbage.

    For chains of jobs that hand on written tables; a DataFrame that is run again shuffles again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a work table that this session wrote under ``scratch_path`` and that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

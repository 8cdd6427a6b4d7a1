"""Session defaults and shared-storage helpers.

Every operator in this package is a ``DataFrame -> DataFrame`` function and does
not need anything from here; this module only exists so that tests, the bench and
the driver entry point build sessions the same way.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults we want on any session we create ourselves. They are only applied when
# the key is not already set, so a cluster's own configuration always wins.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "featurelake", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Pin UTC even when the session already existed: all feature timestamps are UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset on a local master (tests) do we create a scratch folder; on a
    cluster a machine-local folder could not be read back, so that raises.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="featurelake-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


#: Spark's setting that deletes a write's shuffle files when it is done (Spark 4.1; older ones ignore it).
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, free: bool = False) -> tuple[DataFrame, str]:
    """The frame as a table written to the shared folder and read back, and that table's path.

    Lineage ends there as with a checkpoint, but the plan's size estimate is the files' size. A checkpoint keeps the
    estimate of the plan it cuts, which multiplies with every self-join of an iteration. ``free`` also deletes the shuffle
    files made for the table; else they stay on the executors' disks until the driver happens to collect garbage.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, name)
    before = spark.conf.get(FREE, None)
    if free:
        spark.conf.set(FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        if free and before is not None:
            spark.conf.set(FREE, before)
        elif free:
            spark.conf.unset(FREE)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written`` made."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

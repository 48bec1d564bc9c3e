"""Spark session construction and cluster-safe scratch locations.

The library never builds its own session inside an operator: every operator takes DataFrames
and returns a DataFrame. This module only serves entry points (tests, bench, command wrappers).
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults for a session we create ourselves. On a cluster the submitter's configuration wins,
# because ``getOrCreate`` returns the existing session and we only fill in unset keys.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Broadcast only what the planner has measured to be small; 32 MiB is a fixed bound that
    # does not grow with the data.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Parquet scans split at 128 MiB so tasks stay well inside executor memory at any scale.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "citeweave") -> SparkSession:
    """A local session for tests and benchmarks; configuration mirrors the cluster defaults."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("CITEWEAVE_DRIVER_MEMORY", "8g")))
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here (the SparkContext's
    checkpoint folder is used when only that is set). A folder of our own is created only when
    neither is set and the master is local, as in tests; on a cluster that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
        if configured:
            return configured
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="citeweave-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001 - some sessions reject core settings at run time
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables that cut lineage."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables written inside the block are deleted at its end: a job writes its outputs
    inside and leaves the scratch folder as it found it. Scopes nest."""
    _SCOPES.append([])
    try:
        yield
    finally:
        release_scratch(spark, *_SCOPES.pop())


def write_scratch(df, name: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as Parquet under the shared checkpoint folder; return the path."""
    import uuid

    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.mode("overwrite").partitionBy(*partition_by or []).parquet(path)
    return path


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Used where several later steps read the same intermediate: it is computed once (an eager
    ``checkpoint()`` would compute it twice, once for the job and once for the write), and the
    lineage is cut, so a lost executor only recomputes from the written table. The frame stays
    readable until its folder is released (``scratch_scope``, ``release_scratch``).
    """
    return df.sparkSession.read.parquet(write_scratch(df, name))


def release_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables once nothing reads them any more (a job's last step)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(conf).delete(hpath, True)

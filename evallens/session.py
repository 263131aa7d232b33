"""Session helpers for tests, the bench and local runs.

Library functions never create sessions; callers on a cluster bring their own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Listing many small folders: a few listing tasks, not one task per folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "evallens") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("EVALLENS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict):
    """Settings for what is planned or started meanwhile, set back afterwards."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for materialised intermediates.

    Read from `spark.checkpoint.dir` (or the context's checkpoint dir).  Only a
    local-mode session without one gets a fresh folder under the system temp
    directory; a cluster session without a shared folder is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        d = tempfile.mkdtemp(prefix="evallens-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/evallens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path for this application under the shared folder."""
    return f"{_own_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables.

    Results that still read them become unreadable, so write those first.
    """
    from evallens.sources.paths import delete_path

    delete_path(spark, _own_scratch(spark))

"""Spark session and shared-storage helpers.

The library never invents storage locations on a cluster: intermediate tables and checkpoints go
below ``spark.checkpoint.dir`` as configured by the cluster. Only local sessions (tests, bench)
get a fresh scratch folder when the setting is missing.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "*", app: str = "goldmart", extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark: local mode, UI off, small shuffle width."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**_LOCAL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint root, creating a scratch one only for local sessions."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; on a cluster it must name a shared folder"
            )
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")


# Spark deletes the shuffle files of an execution when it ends.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Writes within leave no shuffle files. What is written is read back from its files, so no one reads the shuffles again; without this
    they stay on the executors' disks until the driver happens to collect garbage, and a job of many writes holds those of all of them. Only for
    writes, which are planned anew each time: a frame collected twice would make its shuffles again."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage so that lost executors recompute from the written table, not from the scan,
    and lets many downstream tables reuse one computed result.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_released(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

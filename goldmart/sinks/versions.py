"""Outputs that are replaced all at once.

Overwriting a folder deletes before it writes, so a reader, or a run that breaks, meets a half-written output. Here every write goes to a fresh
folder below the output's path, and only when it is complete is its name added to the output's list of published versions, by one small
file that Spark commits as a whole. Readers ask for the last name published; older versions stay until the storage's own retention takes
them, so a frame that reads one goes on.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PUBLISHED, PREFIX = "published", "version-"


def publish(df: DataFrame, path: str, write: Callable[[DataFrame, str], str]) -> str:
    """Write ``df`` by ``write(df, folder)`` into a new version of the output at ``path`` and publish it; returns the version's folder."""
    root, name = path.rstrip("/"), f"{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write(df, f"{root}/{name}")
    df.sparkSession.range(1).select(F.lit(name).alias("value")).coalesce(1).write.mode("append").text(f"{root}/{PUBLISHED}")
    return f"{root}/{name}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the published versions, oldest first."""
    root = path.rstrip("/")
    try:
        names = spark.read.text(f"{root}/{PUBLISHED}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [f"{root}/{r['value']}" for r in sorted(names)]


def current(spark: SparkSession, path: str) -> str:
    """Folder of the version that was published last."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    return found[-1]

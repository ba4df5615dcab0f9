"""Helpers shared by the corpus operators: table access, fold rules, shipping of worker code."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ship(module: str) -> None:
    """Send a module's functions to the workers by value: they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (a null key counts as the empty text)."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def columns_of(df: DataFrame, *names: str) -> list[Column]:
    """Columns by exact name, safe when other columns differ only in case."""
    return [df[f"`{n}`"] for n in names]


def appended(df: DataFrame, added: list[T.StructField]) -> tuple[list[int], T.StructType]:
    """Places of the columns to keep and the schema after adding columns; a column whose name clashes with an
    added one (in any case) is replaced by it."""
    names = {f.name.lower() for f in added}
    kept = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in names]
    return kept, T.StructType([df.schema.fields[i] for i in kept] + added)


def slices(batch, at: int, most: int = 4 << 20):
    """Consecutive slices of an Arrow batch with at most about ``most`` bytes in the string column ``at``
    (one row at least): keeps what is built from a batch small when texts are long."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


ship(__name__)

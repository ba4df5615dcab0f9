"""Sinks: gold as Parquet and CSV, analytic tables as CSV, and the output manifest. A write's shuffle files are deleted when it ends."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldmart.session import shuffles_released
from goldmart.sinks.versions import PREFIX

# Tables with a fixed row bound, written as one part file each.
BOUNDED_TABLES = ("correlacoes_sucesso", "top_filmes_receita", "top_filmes_roi")


def csv_ready(df: DataFrame) -> DataFrame:
    """CSV cannot hold lists or structs: those columns are written as JSON text."""
    return df.select(*[
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def write_parquet(df: DataFrame, path: str) -> str:
    """Replace the directory on every run; Spark leaves a ``_SUCCESS`` marker."""
    with shuffles_released(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return path


def write_keyed(df: DataFrame, path: str, key: str = "id", row_group_bytes: int | None = None) -> str:
    """Parquet in which one key is found without reading the table: the rows of a file are sorted by ``key``, so the row groups have narrow
    bounds, and a bloom filter per row group tells which files lack the key. The sort is within partitions (none is added where rows come
    sorted, as from joins on bucketed tables); rows are not shuffled."""
    options = {f"parquet.bloom.filter.enabled#{key}": "true"}
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    with shuffles_released(df.sparkSession):
        df.sortWithinPartitions(key).write.mode("overwrite").options(**options).parquet(path)
    return path


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in ``buckets`` files by the hash of ``key``, sorted by it, and read it back: tables
    bucketed alike are joined and grouped on the key without a shuffle. The default is the session's number of shuffle partitions, so a frame that a
    window or an aggregate has just dealt out by the key is written as it lies, a file for each bucket.

    Spark keeps the bucketing in its catalogue only, so the table is entered under a name of its own and taken out once the returned
    frame is resolved; its files stay."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"goldmart_bucketed_{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.format("parquet").mode("overwrite").bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Header, no index. Sorted frames keep their order across part files (range partitions).
    ``single_file`` only for tables whose size is bounded by construction."""
    out = csv_ready(df)
    if single_file:
        out = out.coalesce(1)
    # RFC 4180 quoting: a quote inside a value is doubled, values with newlines are quoted
    # and blanks at either end of a value are kept
    options = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    with shuffles_released(df.sparkSession):
        out.write.mode("overwrite").options(**options).csv(path)
    return path


def write_tables(tables: Mapping[str, DataFrame], out_dir: str, bounded: Iterable[str] = BOUNDED_TABLES) -> dict[str, str]:
    bounded = set(bounded)
    return {
        name: write_csv(df, f"{out_dir.rstrip('/')}/{name}.csv", single_file=name in bounded)
        for name, df in tables.items()
    }


def manifest(spark: SparkSession, outputs: Iterable[str]) -> DataFrame:
    """(arquivo, bytes): one line per written output (a folder of part files, or a version of one) with its name and total size,
    largest first. File contents are never read (the content column is pruned)."""
    files = spark.read.format("binaryFile").load(list(outputs)).select("path", F.col("length").alias("bytes"))
    name = F.regexp_extract("path", rf"([^/]+)/(?:{PREFIX}[^/]+/)?[^/]+\z", 1)
    return files.groupBy(name.alias("arquivo")).agg(F.sum("bytes").alias("bytes")).orderBy(F.desc("bytes"), F.asc("arquivo"))

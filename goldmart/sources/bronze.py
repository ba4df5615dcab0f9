"""Bronze ingest: raw CSV exports -> typed-as-text Parquet with a stable input position.

Multi-line CSV (quoted fields with newlines) is read in byte ranges with their quote states, so one large file
takes many tasks; landing it once as Parquet lets a lost executor recompute
from Parquet instead of re-reading the CSV. ``_pos`` (file, block, row) is fixed at the scan,
before any shuffle, and stored, so keep-first means input order on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldmart.constants import BRONZE_COLUMNS, REQUIRED_RAW_FILES
from goldmart.functions.text import normalize_na_tokens
from goldmart.operators.profile import shapes
from goldmart.sources.csv_ranges import read_records
from goldmart.sources.contracts import ContractError, missing_columns, require_files

CORRUPT = "_corrupt"
_CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
# a quoted part; possessive, so a record of any length is read once and without recursion
_QUOTED = r'"[^"]*+"'


class RaggedRowError(ValueError):
    """Rows with more fields than the header."""


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line only (reads the first record, no inference)."""
    return spark.read.options(**_CSV_OPTIONS).csv(path).columns


def read_raw_csv(spark: SparkSession, path: str, dataset_name: str | None = None, required=None) -> DataFrame:
    """All columns as text in header order, plus ``_corrupt`` (raw text of ragged rows) and
    ``_pos``; NA tokens become null. The contract is checked on the header before any scan.

    A file is read by as many tasks as it has byte ranges (``goldmart.sources.csv_ranges``); every file must begin with the
    same header."""
    header = csv_header(spark, path)
    clash = sorted(set(header) & set(BRONZE_COLUMNS))
    if clash:
        raise ContractError(f"columns reserved for the landing: {', '.join(clash)}")
    if dataset_name is not None or required is not None:
        missing = missing_columns(header, dataset_name, required)
        if missing:
            raise ContractError(f"dataset '{dataset_name}' lacks required columns: {', '.join(missing)}")
    fields = ["`" + c.replace("`", "``") + "` string" for c in [*header, CORRUPT]]
    options = {k: v for k, v in _CSV_OPTIONS.items() if k != "header"}
    parsed = F.from_csv("_record", ", ".join(fields), {**options, "columnNameOfCorruptRecord": CORRUPT})
    df = read_records(spark, path).select(parsed.alias("_r"), "_pos").select("_r.*", "_pos")
    return normalize_na_tokens(df, columns=header)


def field_count(raw_record: str = CORRUPT) -> F.Column:
    """Fields of a raw record: its commas outside double quotes, plus one."""
    bare = F.regexp_replace(F.col(raw_record), _QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + F.lit(1)


def land_bronze(
    spark: SparkSession,
    path: str,
    out_path: str,
    dataset_name: str | None = None,
    on_long_row: str = "fail",
) -> DataFrame:
    """Read one raw CSV source, land it as Parquet at ``out_path`` and return the landed rows.

    Short rows are kept with nulls. Rows longer than the header raise ``RaggedRowError``
    (``on_long_row='fail'``) or stay in the landed Parquet flagged ``_long`` and are left out of
    the returned frame (``'quarantine'``). The check is one aggregate over the landed table."""
    df = read_raw_csv(spark, path, dataset_name)
    width = len(df.columns) - 2  # without the raw record and the position
    flagged = df.withColumn("_long", F.coalesce(F.col(CORRUPT).isNotNull() & (field_count() > F.lit(width)), F.lit(False)))
    flagged.hint("rebalance").write.mode("overwrite").parquet(out_path)
    landed = spark.read.parquet(out_path)
    n_long = landed.agg(F.count_if("_long").alias("n")).first()["n"]
    if n_long and on_long_row == "fail":
        raise RaggedRowError(f"{path}: {n_long} rows have more fields than the header")
    return landed.where(~F.col("_long")).drop("_long")


def load_raw_datasets(
    spark: SparkSession, raw_dir: str, bronze_dir: str, files: dict[str, str] | None = None, on_long_row: str = "fail"
) -> dict[str, DataFrame]:
    """Check that every required file exists (one error naming all missing ones), then land
    each as bronze Parquet. Returns {dataset: landed DataFrame}."""
    files = REQUIRED_RAW_FILES if files is None else files
    paths = require_files(spark, raw_dir, files)
    return {
        name: land_bronze(spark, paths[name], f"{bronze_dir.rstrip('/')}/{name}", name, on_long_row)
        for name in files
    }


def source_summary(tables: dict[str, DataFrame], files: dict[str, str] | None = None) -> DataFrame:
    """(dataset, arquivo, linhas, colunas) per raw source."""
    files = REQUIRED_RAW_FILES if files is None else files
    return shapes(tables, files)

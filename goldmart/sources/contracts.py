"""Source contracts: required files and required columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from goldmart.constants import REQUIRED_COLUMNS, REQUIRED_RAW_FILES


class ContractError(ValueError):
    """A dataset lacks required columns."""


def missing_columns(columns: Iterable[str], dataset_name: str, required=None) -> list[str]:
    need = REQUIRED_COLUMNS[dataset_name] if required is None else set(required)
    return sorted(need - set(columns))


def validate_columns(df: DataFrame, dataset_name: str, required=None) -> DataFrame:
    """Raise naming every missing column (sorted); schema only, no job. Extra columns are fine."""
    missing = missing_columns(df.columns, dataset_name, required)
    if missing:
        raise ContractError(
            f"dataset '{dataset_name}' lacks required columns: {', '.join(missing)}"
        )
    return df


def _path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path).columns
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def require_files(spark: SparkSession, raw_dir: str, files: dict[str, str] | None = None) -> dict[str, str]:
    """Paths of the required raw files; one error naming all missing files (sorted)."""
    files = REQUIRED_RAW_FILES if files is None else files
    paths = {name: f"{raw_dir.rstrip('/')}/{fname}" for name, fname in files.items()}
    missing = sorted(fname for name, fname in files.items() if not _path_exists(spark, paths[name]))
    if missing:
        raise FileNotFoundError("required raw files are missing: " + ", ".join(missing))
    return paths

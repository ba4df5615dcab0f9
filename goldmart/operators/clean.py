"""Cleaning of the movie table: id rules, keep-first dedup, coercions and row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldmart.constants import NUMERIC_MOVIE_COLUMNS
from goldmart.functions.numeric import digits_only_id, once, to_double
from goldmart.functions.text import blank_to_null, py_strip
from goldmart.operators.dedup import keep_first
from goldmart.sources.contracts import validate_columns

POSITION = "_pos"


def _order(df: DataFrame, order_by: Sequence[str] | None) -> list[str]:
    order = list(order_by) if order_by else [POSITION]
    absent = [c for c in order if c not in df.columns]
    if absent:
        raise ValueError(f"keep-first needs an input order; columns not found: {absent}")
    return order


def adult_flag(c: str = "adult"):
    """Text to boolean: stripped, lower-cased, equal to 'true'. Null and junk are false."""
    return F.coalesce(F.lower(py_strip(c)) == F.lit("true"), F.lit(False))


def clean_movies(
    movies: DataFrame,
    order_by: Sequence[str] | None = None,
    null_title: str = "drop",
    numeric_columns: Sequence[str] = NUMERIC_MOVIE_COLUMNS,
) -> DataFrame:
    """Valid digit-only ids, first row per id (by ``order_by``, default ``_pos``), numbers
    coerced, adult/title/zero rules, then the row filters. Dedup comes before the filters, so
    an id whose first row is bad disappears.

    ``null_title='keep'`` reproduces a text conversion that turns a missing title into 'nan'.
    """
    validate_columns(movies, "movies")
    order = _order(movies, order_by)
    with_id = movies.withColumn("id", once(digits_only_id("id"), "bigint")).where(F.col("id").isNotNull())
    first = keep_first(with_id, ["id"], order)
    typed = first.withColumns({c: to_double(first, c) for c in numeric_columns})
    title = F.col("title") if null_title == "drop" else F.coalesce(F.col("title"), F.lit("nan"))
    typed = typed.withColumns(
        {
            "adult": adult_flag("adult"),
            "title": blank_to_null(title),
            "budget": F.nullif(F.col("budget"), F.lit(0.0)),
            "revenue": F.nullif(F.col("revenue"), F.lit(0.0)),
        }
    )
    return typed.where(
        ~F.col("adult")
        & F.col("title").isNotNull()
        & F.col("runtime").isNotNull()
        & (F.col("runtime") > F.lit(0.0))
    )


def clean_counters(movies: DataFrame) -> DataFrame:
    """One row: raw rows, rows with an invalid id, and duplicate ids among the valid rows
    (valid rows minus distinct valid ids). The distinct count is planned as a two-level
    aggregate keyed by id, so only distinct ids per map task are shuffled."""
    ids = movies.select(digits_only_id("id").alias("_id"))
    return ids.agg(
        F.count(F.lit(1)).alias("linhas_brutas"),
        F.count_if(F.col("_id").isNull()).alias("ids_invalidos"),
        (F.count("_id") - F.count_distinct("_id")).alias("ids_duplicados"),
    )

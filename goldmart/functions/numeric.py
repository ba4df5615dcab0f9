"""Numeric column expressions: rounding, lenient number parsing, NaN handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text accepted as a number: optional blanks and sign, digits with an optional fraction (or a bare
# fraction), optional exponent. Anything else ('12d', 'nan', 'inf', '0x10', '1_000') is missing.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rint_round(c: str | Column, digits: int = 2) -> Column:
    """Round half to even on the binary value, as ``numpy.round`` does (0.125 -> 0.12)."""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0


def once(c: Column, dtype: str) -> Column:
    """The same value, computed once a row: a filter on what follows is not moved below it, where it would compute the value a second
    time. What stands behind the value never applies (no partition has a number below 0), but its number keeps the column in its place."""
    return F.coalesce(c, F.when(F.spark_partition_id() < F.lit(0), F.lit(0)).cast(dtype))


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes null, so that averages skip it and sorts put it last."""
    col = _col(c)
    return F.when(~F.isnan(col), col)


def to_double(df: DataFrame, name: str) -> Column:
    """Lenient number parsing of one column of ``df`` (missing when not a number).

    Numeric columns pass through as double; text must match ``NUMBER_PATTERN`` first, because a
    plain cast also accepts '12d', '12f' and 'nan'.
    """
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, T.NumericType):
        return nan_to_null(col.cast("double"))
    text = col.cast("string")
    return F.when(text.rlike(NUMBER_PATTERN), nan_to_null(F.trim(text).try_cast("double")))


def _same_text(text: Column) -> Column:
    """The text is what its whole number is written as: no blanks, plus sign or leading zeros."""
    return text.try_cast("bigint").cast("string") == text


def to_long_truncated(df: DataFrame, name: str) -> Column:
    """Lenient number, then truncated to a whole number ('12.7' -> 12, '1e3' -> 1000). A text that its whole number is written as again is
    read as one, without a pattern, below 10^15: there it is a whole number in double precision too."""
    found = to_double(df, name).try_cast("bigint")
    if isinstance(df.schema[name].dataType, T.NumericType):
        return found
    text = F.col(name).cast("string")
    return F.when(_same_text(text) & text.try_cast("bigint").between(1 - 10**15, 10**15 - 1), text.try_cast("bigint")).otherwise(found)


def digits_only_id(c: str | Column) -> Column:
    """Id text made of ASCII digits only, as a bigint; anything else is null.

    No trimming: ' 12' is not an id. ``\\z`` so that a trailing newline does not match.
    """
    text = _col(c).cast("string")
    plain = _same_text(text) & (text.try_cast("bigint") >= F.lit(0))
    return F.when(plain | text.rlike(r"^[0-9]+\z"), text.try_cast("bigint"))


def scaled(c: str | Column, divisor: float) -> Column:
    """Scale to billions / millions."""
    return _col(c) / F.lit(float(divisor))

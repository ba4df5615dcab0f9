"""Text column expressions: Python-style strip, blank handling, NA tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text tokens a pandas CSV read treats as missing by default (exact match).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Characters Python's str.strip() removes: Unicode White_Space plus the four separators
# U+001C..U+001F. Spark's trim only removes the ASCII space.
_WS = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
_STRIP_PATTERN = rf"^{_WS}+|{_WS}+\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: str | Column) -> Column:
    """Remove leading and trailing whitespace the way Python's ``str.strip`` does."""
    return F.regexp_replace(_col(c), _STRIP_PATTERN, "")


def blank_to_null(c: str | Column) -> Column:
    """Strip, then turn the empty string into null."""
    return F.nullif(py_strip(c), F.lit(""))


def present_text(c: str | Column) -> Column:
    """1 when the value is present and not blank, else 0."""
    return F.coalesce(py_strip(c) != F.lit(""), F.lit(False)).cast("int")


def na_token_to_null(c: str | Column, tokens=NA_TOKENS) -> Column:
    col = _col(c)
    return F.when(~col.isin(*tokens), col)


def normalize_na_tokens(df: DataFrame, tokens=NA_TOKENS, columns=None) -> DataFrame:
    """Null every exact NA token in the string columns of ``df`` (all of them by default)."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: na_token_to_null(n, tokens) for n in names}) if names else df

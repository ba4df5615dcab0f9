"""Date expressions that follow a pandas ISO date parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The calendar days a nanosecond pandas timestamp can hold at midnight.
MIN_DATE = "1677-09-22"
MAX_DATE = "2262-04-11"
ISO_DAY_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_date(c: str | Column) -> Column:
    """ISO day text ('1995-10-30', '1995-1-5') to a date; anything else, impossible days
    ('1995-02-30') and days outside the pandas range become null."""
    col = _col(c)
    if_iso = F.when(col.cast("string").rlike(ISO_DAY_PATTERN), col.cast("string").try_cast("date"))
    return F.when(if_iso.between(F.lit(MIN_DATE).cast("date"), F.lit(MAX_DATE).cast("date")), if_iso)


def decade(year: str | Column) -> Column:
    """(year // 10) * 10 as int, null stays null."""
    y = _col(year)
    return (F.floor(y / F.lit(10)) * F.lit(10)).cast("int")


def iso_day_text(d: str | Column) -> Column:
    return F.date_format(_col(d), "yyyy-MM-dd")

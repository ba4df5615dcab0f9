"""Scalar expressions: rounding, lenient numbers, ids, strip, NA tokens, dates."""

import pytest
from pyspark.sql import functions as F

from goldmart.functions.dates import decade, lenient_date
from goldmart.functions.numeric import digits_only_id, rint_round, to_double, to_long_truncated
from goldmart.functions.text import NA_TOKENS, blank_to_null, normalize_na_tokens, present_text, py_strip


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")


def collect(df, col):
    return [r[col] for r in df.orderBy("i").collect()]


def test_rint_round_half_even_on_binary_value(spark):
    df = one_col(spark, [0.125, 0.135, 2.675, 1.005, -0.001, None], "double")
    assert collect(df.select("i", rint_round("x", 2).alias("r")), "r") == [0.12, 0.14, 2.68, 1.0, 0.0, None]


@pytest.mark.parametrize("text,expected", [
    ("1e3", 1000.0), (" 12 ", 12.0), ("12d", None), ("nan", None), ("12f", None), ("+5", 5.0),
    (".5", 0.5), ("1.", 1.0), ("inf", None), ("", None), ("0x10", None), ("1_000", None), ("-3.25", -3.25),
])
def test_to_double_lenient(spark, text, expected):
    df = one_col(spark, [text])
    assert collect(df.select("i", to_double(df, "x").alias("d")), "d") == [expected]


def test_to_double_numeric_passthrough_and_nan(spark):
    df = one_col(spark, [1.5, float("nan"), None], "double")
    assert collect(df.select("i", to_double(df, "x").alias("d")), "d") == [1.5, None, None]


def test_to_long_truncates(spark):
    df = one_col(spark, ["12.7", "-3.9", "1e3", " 12 ", "abc"])
    assert collect(df.select("i", to_long_truncated(df, "x").alias("d")), "d") == [12, -3, 1000, 12, None]


@pytest.mark.parametrize("text,expected", [
    ("007", 7), ("12", 12), (" 12", None), ("12.0", None), ("1997-08-20", None), ("", None), ("12\n", None),
    ("-5", None), (None, None), ("١٢", None),
])
def test_digits_only_id(spark, text, expected):
    df = one_col(spark, [text])
    assert collect(df.select("i", digits_only_id("x").alias("d")), "d") == [expected]


def test_py_strip_matches_python(spark):
    samples = ["  x\t\n", " y　", "\x1cz\x1f", "\xa0a b\xa0", "keep", "", "   ", "​z"]
    df = one_col(spark, samples)
    got = collect(df.select("i", py_strip("x").alias("s")), "s")
    assert got == [s.strip() for s in samples]


def test_blank_to_null_and_presence(spark):
    df = one_col(spark, ["  ", "", None, " a "])
    out = df.select("i", blank_to_null("x").alias("b"), present_text("x").alias("p")).orderBy("i").collect()
    assert [r.b for r in out] == [None, None, None, "a"]
    assert [r.p for r in out] == [0, 0, 0, 1]


def test_na_tokens_exact_match(spark):
    values = list(NA_TOKENS) + [" NA", "na", "Null", "none", "value"]
    df = one_col(spark, values)
    got = collect(normalize_na_tokens(df), "x")
    assert got == [None] * len(NA_TOKENS) + [" NA", "na", "Null", "none", "value"]


@pytest.mark.parametrize("text,expected", [
    ("1995-10-30", "1995-10-30"), ("1995-1-5", "1995-01-05"), ("1995", None), ("1995-02-30", None),
    ("1600-01-01", None), ("2262-04-11", "2262-04-11"), ("2262-04-12", None), ("1677-09-22", "1677-09-22"),
    ("10/30/1995", None), ("1995-10-30 00:00:00", None), (None, None),
])
def test_lenient_date(spark, text, expected):
    df = one_col(spark, [text])
    got = collect(df.select("i", F.date_format(lenient_date("x"), "yyyy-MM-dd").alias("d")), "d")
    assert got == [expected]


def test_decade(spark):
    df = one_col(spark, [1999, 2000, 1990, None], "int")
    assert collect(df.select("i", decade("x").alias("d")), "d") == [1990, 2000, 1990, None]

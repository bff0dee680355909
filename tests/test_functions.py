"""Scalar functions on edge values."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthline.functions import dates, labels, numbers, text


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row.r for row in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]


def test_number_text(spark):
    good = ["1,234.50", " 12 ", "1e5", "nan", "Infinity", "-3.", ".5", "+7", "-inf", "1E-3"]
    bad = ["1_000", "12d", ".", "", "abc", None, "1 2", "--1", "1e", "0x10"]
    assert apply(spark, text.is_number_text, good) == [True] * len(good)
    assert apply(spark, text.is_number_text, bad) == [False] * len(bad)


def test_amount(spark):
    values = ["1,234.567", "1e3", "99999999999999.99", "9,999,999,999,999.99", " 5 ", "n/a", "", None, "-1.005"]
    assert apply(spark, numbers.to_amount, values) == [
        Decimal("1234.57"),
        Decimal("1000.00"),
        None,
        Decimal("9999999999999.99"),
        Decimal("5.00"),
        None,
        None,
        None,
        Decimal("-1.01"),
    ]


def test_month_and_fiscal_year_text(spark):
    months = ["jan-24", "JAN-24", "Dec-99", "JANUARY-24", "Jan-2024", "2024/05", "", None, " Jan-24"]
    assert apply(spark, text.is_month_text, months) == [True, True, True] + [False] * 6
    years = ["23-24", "2023-24", "23/24", "", None]
    assert apply(spark, text.is_fiscal_year_text, years) == [True] + [False] * 4


@pytest.mark.parametrize("index", [1, 2, 3])
def test_part_equals_split_part(spark, index):
    values = ["a-b", "a-b-c", "a", "", "-", "--", "-b", "a-", None, "a--c", "-a-b-", "ä-ß"]
    ours = apply(spark, lambda c: text.part(c, index), values)
    assert ours == apply(spark, lambda c: F.split_part(c, F.lit("-"), F.lit(index)), values)


def test_month_number(spark):
    values = ["JAN", "jan", "Dec", "MAY", "", "JANUARY", "JAN,FEB", None, "2024/05"]
    assert apply(spark, dates.month_number, values) == [1, 1, 12, 5, None, None, None, None, None]


def test_fiscal_period(spark):
    rows = [(4, "23-24"), (12, "23-24"), (1, "23-24"), (3, "23-24"), (None, "23-24"), (5, "2023-24"), (2, "24"), (5, None)]
    df = spark.createDataFrame([(i, m, f) for i, (m, f) in enumerate(rows)], "i int, m int, f string")
    got = [
        r.p
        for r in df.select("i", dates.fiscal_period(F.col("m"), F.col("f")).alias("p")).orderBy("i").collect()
    ]
    assert got == ["2023-04", "2023-12", "2024-01", "2024-03", None, "202023-05", "20-02", None]


def test_month_start(spark):
    values = ["2024-01", "2024-12", "2024-13", "202023-04", "20-02", "", None]
    assert apply(spark, dates.month_start, values) == [date(2024, 1, 1), date(2024, 12, 1)] + [None] * 5


def test_quarter(spark):
    assert apply(spark, dates.quarter_of, [1, 3, 4, 6, 7, 9, 10, 12, None], "int") == [1, 1, 2, 2, 3, 3, 4, 4, None]


def test_to_whole(spark):
    assert apply(spark, numbers.to_whole, ["2024", "20", "20x", "", None, "99999999999"]) == [2024, 20, None, None, None, None]


def test_months_after(spark):
    df = spark.createDataFrame([(date(2023, 11, 1), 3), (date(2024, 1, 1), 0)], "d date, n int")
    got = [r.m for r in df.select(dates.months_after(F.col("d"), F.col("n")).alias("m")).collect()]
    assert got == [[date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1)], []]


def test_age_counts_calendar_days(spark):
    df = spark.range(1).select(
        dates.age_days(dates.moment(datetime(2024, 1, 2, 0, 1)), dates.moment(datetime(2024, 1, 1, 23, 59))).alias("d")
    )
    assert df.first().d == 1


def test_version_tag(spark):
    tag = spark.range(1).select(dates.version_tag(dates.moment(datetime(2024, 3, 5, 7, 8, 9))).alias("t")).first().t
    assert tag == "v20240305_070809"


def test_null_tokens(spark):
    assert apply(spark, text.null_if_token, ["", "NULL", "null", "Null", "x", None]) == [None, None, None, "Null", "x", None]


def test_number_texts(spark):
    assert apply(spark, text.fixed2_text, [12345678.905, 0.5, None], "double") == ["12345678.91", "0.50", None]
    assert apply(spark, text.grouped_text, [1234567.4], "double") == ["1,234,567"]


def test_percentages(spark):
    df = spark.createDataFrame([(200.0, 150.0), (0.0, 1.0), (None, 1.0)], "a double, b double")
    got = [r.p for r in df.select(numbers.percent_below(F.col("a"), F.col("b")).alias("p")).collect()]
    assert got == [25.0, None, None]


def test_labels(spark):
    below = [(10.0, "NORMAL"), (25.0, "WARNING")]
    values = [0.0, 9.99, 10.0, 24.99, 25.0, None]
    assert apply(spark, lambda c: labels.label_below(c, below, "CRITICAL"), values, "double") == [
        "NORMAL", "NORMAL", "WARNING", "WARNING", "CRITICAL", "CRITICAL",
    ]
    above = [(90, "STALE"), (30, "AGING")]
    assert apply(spark, lambda c: labels.label_above(c, above, "HEALTHY"), [30, 31, 90, 91], "int") == [
        "HEALTHY", "AGING", "AGING", "STALE",
    ]


def test_two_decimals_of_any_number(spark):
    df = spark.createDataFrame([(1.005,), (1e19,), (1e300,), (float("nan"),), (float("inf"),), (None,)], "x double")
    got = [r.t for r in df.select(text.fixed2_text(F.col("x")).alias("t")).collect()]
    assert got[1:] == ["10000000000000000000.00", "1.0E300", "NaN", "Infinity", None]

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lotbook.functions import casts, dates, text
from lotbook.operators import quality
from tests.conftest import rows

UNKNOWN = dt.date(1900, 1, 1)


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expression(F.col("c"))).first()[0]


@pytest.mark.parametrize(("raw", "expected"), [
    ("  toledo ", "TOLEDO"), ("Québec", "QUÉBEC"), ("\ttab", "\tTAB"), ("", ""), (None, None),
])
def test_clean(spark, raw, expected):
    assert one(spark, raw, text.clean) == expected


@pytest.mark.parametrize(("raw", "first", "last"), [
    ("CHER", "CHER", "n. a."), ("ANN  LEE", "ANN", "n. a."), ("ANN MAY LEE", "ANN", "MAY"),
    ("ANN LEE", "ANN", "LEE"), ("", "n. a.", "n. a."),
])
def test_person_name(spark, raw, first, last):
    assert one(spark, raw, lambda c: text.person_name(c)[0]) == first
    assert one(spark, raw, lambda c: text.person_name(c)[1]) == last


def test_joined_skips_null_parts_and_keeps_separators(spark):
    row = spark.createDataFrame([(None, 3, "X")], "a string, b bigint, c string").select(
        text.joined("a", "b").alias("x"), text.joined("c", "b", "a").alias("y"),
        text.prefixed("P_", F.col("a")).alias("z"),
    ).first()
    assert tuple(row) == ("_3", "X_3_", None)


def test_missing_text_in_key_and_attribute(spark):
    assert one(spark, None, text.key_part) == "N. A."
    assert one(spark, None, text.attribute) == "n. a."


def test_cut_and_filled(spark):
    assert one(spark, "abcdef", lambda c: text.cut(c, 3)) == "abc"
    frame = spark.createDataFrame([("a",), (" ",), ("",), (None,)], "c string")
    assert [r.c for r in frame.filter(text.is_filled(F.col("c"))).collect()] == ["a"]


@pytest.mark.parametrize(("raw", "expected"), [
    ("12.5", Decimal("12.50")), ("7", Decimal("7.00")), ("0.005", Decimal("0.01")), ("N/A", None), ("-5", None),
    ("1e3", None), ("1,000", None), ("5\n", None), ("99999999999999", None), ("", None), (None, None), (".5", None),
])
def test_safe_number(spark, raw, expected):
    assert one(spark, raw, lambda c: casts.safe_number(c, "decimal(12,2)")) == expected


def test_long_rate_keeps_its_digits(spark):
    assert one(spark, "0.0653346892247331", lambda c: casts.safe_number(c, "decimal(20,18)")) == Decimal(
        "0.065334689224733100")
    assert one(spark, "0.0705", lambda c: casts.safe_number(c, "decimal(5,2)")) == Decimal("0.07")


@pytest.mark.parametrize(("raw", "expected"), [
    ("2015", 2015), ("1900", 1900), ("2100", 2100), ("1899", -1), ("2101", -1), ("99", -1), ("20155", -1),
    ("2015\n", -1), ("", -1), (None, -1),
])
def test_safe_year(spark, raw, expected):
    assert one(spark, raw, casts.safe_year) == expected


@pytest.mark.parametrize(("raw", "expected"), [
    ("2022-01-31", dt.date(2022, 1, 31)), ("01/31/2022", dt.date(2022, 1, 31)), (" 2022-01-01", UNKNOWN),
    ("2022-13-45", UNKNOWN), ("2022-02-30", UNKNOWN), ("31/01/2022", UNKNOWN), ("2022-1-1", UNKNOWN),
    ("2022-01-01\n", UNKNOWN), ("", UNKNOWN), (None, UNKNOWN),
])
def test_safe_date(spark, raw, expected):
    assert one(spark, raw, casts.safe_date) == expected


def test_slash_dates_day_first(spark):
    assert one(spark, "31/01/2022", lambda c: casts.safe_date(c, "dd/MM/yyyy")) == dt.date(2022, 1, 31)


def test_rejects_are_well_shaped_only(spark):
    frame = spark.createDataFrame([("2022-13-45",), ("x",), ("2022-01-01",), ("1900-01-01",), (None,)], "c string")
    assert [r.c for r in frame.filter(casts.is_date_reject(F.col("c"))).collect()] == ["2022-13-45"]
    numbers = spark.createDataFrame([("99999999999999",), ("x",), ("1",)], "c string")
    found = numbers.filter(casts.is_number_reject(F.col("c"), "decimal(12,2)")).collect()
    assert [r.c for r in found] == ["99999999999999"]


def test_calendar_attributes(spark):
    day = dt.date(2022, 5, 1)
    assert one(spark, day, dates.month_name, "date") == "May      "
    assert one(spark, day, dates.weekday_name, "date") == "Sunday   "
    assert one(spark, day, dates.is_weekend, "date") == "Y"
    assert one(spark, dt.date(2022, 5, 2), dates.is_weekend, "date") == "N"
    assert one(spark, dt.date(2022, 9, 7), dates.weekday_name, "date") == "Wednesday"


def test_cut_keys_are_counted_by_their_stored_form(spark):
    keys = spark.createDataFrame([("abcdef",), ("abcdef",), ("abcxyz",), ("abc",), ("xy",), (None,)], "k string")
    assert rows(quality.cut_keys(keys, F.col("k"), 3)) == [("abc", 3, 2)]

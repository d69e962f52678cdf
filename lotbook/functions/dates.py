"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_WIDTH = 9  # fixed value: month and weekday names are blank-padded to this width


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "day": F.dayofmonth(day),
        "month": F.month(day),
        "year": F.year(day),
        "quarter": F.quarter(day),
    }


def is_weekend(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), F.lit("Y")).otherwise(F.lit("N"))


def month_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "MMMM"), NAME_WIDTH, " ")


def weekday_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), NAME_WIDTH, " ")

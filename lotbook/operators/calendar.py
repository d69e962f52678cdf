"""The calendar of the entity layer and its dimension attributes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotbook.functions.dates import date_parts, is_weekend, month_name, weekday_name

# The default calendar.
FIRST_DAY, LAST_DAY = dt.date(2010, 1, 1), dt.date(2030, 12, 31)


def build_calendar(
    spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY, anchor: dt.date | None = None
) -> DataFrame:
    """One row per day with ``date_id``, the number of the day counted from ``anchor`` (day 1)."""
    anchor = anchor or first
    if first < anchor:
        raise ValueError(f"the calendar starts at {anchor}, {first} would get a number below 1")
    days = spark.range((last - first).days + 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")
    )
    return days.select(
        (F.datediff("date", F.lit(anchor)) + 1).cast("bigint").alias("date_id"),
        "date",
        *[value.alias(name) for name, value in date_parts(F.col("date")).items()],
        F.lit("MANUAL").alias("source_system"),
        F.lit("CALENDAR_GENERATION").alias("source_entity"),
    )


def calendar_attributes(dates: DataFrame) -> DataFrame:
    """Entity dates without the default member, with the weekday attributes of the dimension."""
    return dates.filter(F.col("date_id") > 0).select(
        "date_id", "date", "day", "month", "year", "quarter",
        is_weekend(F.col("date")).alias("is_weekend"),
        month_name(F.col("date")).alias("month_name"),
        weekday_name(F.col("date")).alias("day_of_week"),
        F.lit("BL_3NF").alias("source_system"),
        F.lit("CE_DATES").alias("source_entity"),
    )

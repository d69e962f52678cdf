"""Guarded casts from feed text. None of them raises, whatever the text holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shapes and their defaults. ``\z`` and not ``$``: the latter lets a line end pass.
NUMBER_SHAPE = r"^\d+(\.\d+)?\z"
YEAR_SHAPE = r"^\d{4}\z"
ISO_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}\z"
SLASH_DATE_SHAPE = r"^\d{2}/\d{2}/\d{4}\z"
UNKNOWN_YEAR = -1
FIRST_YEAR, LAST_YEAR = 1900, 2100
UNKNOWN_DATE = "1900-01-01"


def safe_number(cleaned: Column, data_type: str) -> Column:
    """Plain unsigned decimals only; other text, and numbers too large for the type, give NULL."""
    return F.when(cleaned.rlike(NUMBER_SHAPE), cleaned.try_cast(data_type))


def safe_year(cleaned: Column) -> Column:
    year = F.when(cleaned.rlike(YEAR_SHAPE), cleaned.try_cast("int"))
    return F.when(year.between(FIRST_YEAR, LAST_YEAR), year).otherwise(F.lit(UNKNOWN_YEAR))


def safe_date(text: Column, slash_format: str = "MM/dd/yyyy") -> Column:
    """ISO or slash-separated dates of untrimmed text; everything else is the default date."""
    parsed = F.when(text.rlike(ISO_DATE_SHAPE), text.try_cast("date")).when(
        text.rlike(SLASH_DATE_SHAPE), F.try_to_date(text, slash_format)
    )
    return F.coalesce(parsed, F.lit(UNKNOWN_DATE).cast("date"))


def is_date_reject(text: Column, slash_format: str = "MM/dd/yyyy") -> Column:
    """Text of an accepted shape that is no real date, e.g. month 13."""
    shaped = text.rlike(ISO_DATE_SHAPE) | text.rlike(SLASH_DATE_SHAPE)
    return shaped & (safe_date(text, slash_format) == F.lit(UNKNOWN_DATE).cast("date")) & ~text.isin(
        UNKNOWN_DATE, "01/01/1900"
    )


def is_number_reject(cleaned: Column, data_type: str) -> Column:
    """Text of an accepted number shape that does not fit the type."""
    return cleaned.rlike(NUMBER_SHAPE) & cleaned.try_cast(data_type).isNull()

"""Text expressions with the warehouse's NULL, blank and default rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a missing text shows up in attributes, and (upper-cased) inside natural keys.
NOT_AVAILABLE = "n. a."
NOT_AVAILABLE_IN_KEY = "N. A."


CLEAN_SQL = "upper(trim({}))"


def clean(text: Column) -> Column:
    """Upper-case without surrounding spaces (spaces only, other white space stays)."""
    return F.upper(F.trim(text))


def is_filled(text: Column) -> Column:
    """True for text that is neither NULL nor blank; NULL in a filter drops the row too."""
    return F.trim(text) != ""


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def key_part(cleaned: Column) -> Column:
    """A cleaned text as part of a natural key."""
    return F.coalesce(cleaned, F.lit(NOT_AVAILABLE_IN_KEY))


def attribute(cleaned: Column) -> Column:
    """A cleaned text as a stored attribute."""
    return F.coalesce(cleaned, F.lit(NOT_AVAILABLE))


def joined(*parts: Column | str) -> Column:
    """Concatenate with ``_`` between parts; a NULL part is skipped, its separator is kept."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("_"))
        pieces.append((F.col(part) if isinstance(part, str) else part).cast("string"))
    return F.concat_ws("", *pieces)


def prefixed(prefix: str, text: Column) -> Column:
    """Concatenate so that a NULL text gives NULL."""
    return F.concat(F.lit(prefix), text)


def cut(text: Column, length: int) -> Column:
    """Silently shorten to a declared column length."""
    return F.substring(text, 1, length)


def name_word(cleaned_name: Column, position: int) -> Column:
    """One space-separated word of a cleaned name; blank or absent words give the default.

    A double space makes an empty second word, a third word is not looked at.
    """
    word = F.split_part(key_part(cleaned_name), F.lit(" "), F.lit(position))
    return attribute(blank_to_null(F.trim(word)))


def person_name(cleaned_name: Column) -> tuple[Column, Column]:
    return name_word(cleaned_name, 1), name_word(cleaned_name, 2)

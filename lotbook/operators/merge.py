"""Merging the two feeds with source priority."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lotbook.operators.lookup import HotKeys, anti_join, lookup_join
from lotbook.sources.feeds import is_offline


def prefer_primary(
    primary: DataFrame, secondary: DataFrame, taken: DataFrame, key: str, *, keys_from: DataFrame | None = None,
    known_rows: int | None = None, hot: tuple[HotKeys, str] | None = None, keys_first: bool = False,
) -> DataFrame:
    """All primary rows plus the secondary rows whose key is not among ``taken``.

    ``taken`` are the keys of the unfiltered primary feed: a primary row that is itself filtered out still
    keeps the secondary row of the same key away. With ``keys_first`` the keys are compared alone, which is for wide
    secondary rows that hold few of the primary keys and whose keys are cheap to read.
    """
    if keys_first:
        return primary.unionByName(anti_join(secondary, taken, [key], shared_are_few=True, hot=hot))
    keys = taken.select(key).distinct()
    left = lookup_join(secondary, keys, [key], "left_anti", keys_from=keys_from, known_rows=known_rows, hot=hot)
    return primary.unionByName(left)


def union_with_priority(
    candidates: DataFrame, feed: DataFrame, key: str, *, known_rows: int | None = None
) -> DataFrame:
    """Distinct offline candidates, and distinct online ones whose key the offline feed does not have.

    Both frames carry ``source_system`` and the natural key; ``feed`` is unfiltered and ``known_rows`` an upper
    bound of its distinct keys.
    """
    return prefer_primary(
        candidates.filter(is_offline()), candidates.filter(~is_offline()), feed.filter(is_offline()), key,
        known_rows=known_rows,
    ).distinct()

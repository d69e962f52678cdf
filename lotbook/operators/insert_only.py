"""Insert-only loads: the default member once, then natural keys the table does not have yet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lotbook.operators.lookup import BROADCAST_ROWS, anti_join, beyond_broadcast, lookup_join, touched_rows
from lotbook.operators.surrogate import assign_surrogate, is_small, number_small
from lotbook.schemas import DEFAULT_ID, TABLES
from lotbook.sources.scratch import save_counted
from lotbook.sources.store import Store, one_row


def default_member(store: Store, table: str, load_dt: dt.date) -> DataFrame:
    """The one-row frame with id -1. Dates the definition leaves open are the load date."""
    dates = dict.fromkeys(("insert_dt", "update_dt", "start_dt"), load_dt)
    return one_row(store.spark, store.read(table).schema, dates | (TABLES[table].default or {}))


def lacks_default_member(store: Store, table: str) -> bool:
    id_col = TABLES[table].id_col
    return not store.rows(table) or store.read(table).filter(F.col(id_col) == DEFAULT_ID).isEmpty()


def with_stamps(rows: DataFrame, load_dt: dt.date) -> DataFrame:
    """Insert and update date of new rows."""
    day = F.lit(load_dt).cast("date")
    return rows.withColumn("insert_dt", day).withColumn("update_dt", day)


def next_id(store: Store, table: str) -> int:
    id_col = TABLES[table].id_col
    if not store.rows(table):
        return 1
    largest = store.read(table).agg(F.max(id_col)).first()[0]
    return max(largest or 0, 0) + 1


def not_in_table(rows: DataFrame, store: Store, table: str, keys: Sequence[str], *,
                 candidate_rows: int | None = None, keys_first: bool = False, **options) -> DataFrame:
    """Rows whose natural key is new to the table.

    With few candidates, of which ``candidate_rows`` is an upper bound, a large table is first reduced to their keys. With
    ``keys_first``, for wide rows whose keys are cheap to read, the new keys are found first; few ones are broadcast.
    """
    count = store.rows(table)
    if not count:
        return rows
    loaded = store.read(table).select(*keys)
    if keys_first and beyond_broadcast(count):
        return anti_join(rows, loaded, keys, shared_are_few=False, **options)
    if count > BROADCAST_ROWS and candidate_rows is not None and candidate_rows <= BROADCAST_ROWS:
        loaded, count = touched_rows(loaded, rows, keys, candidate_rows), candidate_rows
    return lookup_join(rows, loaded, keys, "left_anti", known_rows=count, **options)


def append_new(
    store: Store, table: str, rows: DataFrame, load_dt: dt.date, *, with_default: bool = True,
    known_rows: int | None = None,
) -> tuple[int, int]:
    """Append rows that already have their ids, together with the default member if the table lacks it.

    Returns the rows and the default rows added, counted by the writing job itself. A table that has its
    default member is not touched when there is nothing to add. ``known_rows`` is an upper bound of the rows.
    """
    seen = Observation()
    add_default = with_default and lacks_default_member(store, table)
    before = store.rows(table)
    if not add_default and before:
        rows, found = save_counted(rows, "new", lean=True)  # the rows are worked out once, also if there are none
        if not found:
            return 0, 0
    out = with_stamps(rows, load_dt).select(*TABLES[table].columns).observe(seen, F.count(F.lit(1)).alias("n"))
    if add_default:
        out = out.unionByName(default_member(store, table, load_dt))
    store.append(table, out, known_rows)
    added, default_rows = seen.get["n"], int(add_default)
    store.set_rows(table, before + added + default_rows)
    return added, default_rows


def load_insert_only(
    store: Store, table: str, candidates: DataFrame, load_dt: dt.date, known_rows: int | None = None
) -> dict[str, int]:
    """Add distinct candidates with a new natural key; rows already there never change.

    New rows are numbered by ascending natural key. ``known_rows`` is an upper bound of the candidates.
    """
    spec = TABLES[table]
    fresh = not_in_table(candidates, store, table, [spec.src_col], candidate_rows=known_rows)
    order = [spec.src_col, *[c for c in fresh.columns if c != spec.src_col]]
    start = next_id(store, table)
    if is_small(known_rows):
        numbered = number_small(fresh, spec.id_col, order, start)
    else:
        numbered = assign_surrogate(fresh, spec.id_col, order, start, once=True, lean=True).rows
    added, default_rows = append_new(store, table, numbered, load_dt)
    return {"New rows": added, "Default rows": default_rows}

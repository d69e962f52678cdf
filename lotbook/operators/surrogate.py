"""Dense surrogate numbers without putting all rows into one partition."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.sources.scratch import discard, save, save_counted

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above, the row position below this bit
ONE_TASK_ROWS = 100_000  # up to this many new rows, known beforehand, are shuffled to one task and sorted there


@dataclass(frozen=True)
class Numbered:
    rows: DataFrame
    counts: dict[tuple, int]  # rows per group of ``within``; a single () without groups

    @property
    def total(self) -> int:
        return sum(self.counts.values())


def is_small(known_rows: int | None) -> bool:
    return known_rows is not None and known_rows <= ONE_TASK_ROWS


def number_small(rows: DataFrame, id_col: str, order_by: Sequence[str], start: int = 1) -> DataFrame:
    """Number a frame whose row count is known to be small; nothing is written or counted.

    Only the rows themselves are shuffled to one task. What makes them, such as a join with the target, keeps its
    own partitions: a narrow coalesce would pull it into that task.
    """
    keys = [F.col(k).asc() for k in order_by]
    placed = rows.repartition(1).sortWithinPartitions(*keys)
    return placed.withColumn(id_col, F.monotonically_increasing_id() + F.lit(start).cast("bigint"))


def assign_surrogate(
    rows: DataFrame, id_col: str, order_by: Sequence[str], start: int = 1, within: Sequence[str] = (),
    known_rows: int | None = None, once: bool = False, distinct: bool = False, lean: bool = False,
) -> Numbered:
    """Number rows ``start, start + 1, ...`` ascending by ``order_by``, separately for each ``within`` group.

    The rows are range-partitioned and sorted by (within, order_by) and written once with their position. The
    number of a row is then its position in its partition plus the rows of its group in earlier partitions.
    Only one count per partition and group reaches the driver, and a group may span any number of partitions.
    ``order_by`` should tell rows apart, or the order among equal rows is arbitrary. Groups are few and
    never NULL, such as kinds of change or periods. ``known_rows`` is an upper bound of the rows, if known. With
    ``once``, rows whose making is costly are written and counted first: the engine samples the written rows for the
    ranges instead of working them out a second time, and a small number of them goes to one task. With ``distinct``,
    equal rows are numbered as one: they meet in the shuffle for the ranges. ``lean`` is that of :func:`save`: the numbered
    rows are to be stored at once.
    """
    first = None
    if once and not is_small(known_rows):
        first, known_rows = save_counted(rows, "unnumbered", lean)
        rows = first
    keys = [F.col(k).asc() for k in [*within, *order_by]]
    parts = rows.repartition(1) if is_small(known_rows) else rows.repartitionByRange(*keys)
    if distinct:
        parts = parts.distinct()
    placed = parts.sortWithinPartitions(*keys).withColumn("_position", F.monotonically_increasing_id())
    saved = save(placed, "numbered", lean).withColumn("_slot", F.shiftright("_position", _POSITION_BITS))
    if first is not None:
        discard(first)
    runs = (
        saved.groupBy("_slot", *within)
        .agg(F.count("*").alias("_rows"), F.min("_position").alias("_first"))
        .collect()
    )

    def group(run):
        return tuple(run[c] for c in within)

    runs.sort(key=lambda run: (repr(group(run)), run["_slot"]))
    counts: dict[tuple, int] = {}
    shifts = []
    for value, members in groupby(runs, key=group):
        done = 0
        for run in members:
            shifts.append((run["_slot"], *value, start + done - run["_first"]))
            done += run["_rows"]
        counts[value] = done

    if len(shifts) <= 1:
        shift = shifts[0][-1] if shifts else start
        numbered = saved.withColumn(id_col, F.col("_position") + F.lit(shift).cast("bigint"))
    else:
        schema = saved.select("_slot", *within).schema.add("_shift", T.LongType())
        table = rows.sparkSession.createDataFrame(shifts, schema)
        numbered = saved.join(F.broadcast(table), ["_slot", *within]).withColumn(
            id_col, F.col("_position") + F.col("_shift")
        )
    return Numbered(numbered.drop("_slot", "_position", "_shift"), counts)

"""Equi joins against lookup tables that stay balanced whatever the keys look like.

A lookup side of a measured, bounded size is broadcast: no shuffle, so skew cannot matter. A larger one is shuffled,
and the keys holding a large share of the left rows are spread over many slices, with their lookup rows repeated once
per slice and their equal rows counted instead of moved.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.schemas import DEFAULT_ID
from lotbook.sources.scratch import dropped_shuffles, save_counted

# A side is broadcast up to this many rows and this many bytes of text in them; both are measured.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.0005  # a key with more than this share of the rows is split; at most 2,000 such keys can exist
SKETCH_ITEMS = 20_000  # keys that a sketch keeps; a sketch of 20,000 keys of 50 bytes takes 1 MB
SKETCH_SLOTS = 256
SLICES = 64  # least number of slices of a split key
SLICE_ROWS = 250_000  # rows a slice should hold at most


def fits_broadcast(rows: DataFrame, limit: int = BROADCAST_ROWS, known_rows: int | None = None,
                   free_text: bool = False) -> bool:
    """Whether a frame has at most ``limit`` rows and ``BROADCAST_BYTES`` of text.

    Rows of the store's tables hold a few ids and texts of declared length, so their known number says enough. Rows
    with ``free_text``, as a feed brings it, and rows of unknown number are measured.
    """
    if known_rows is not None and (known_rows > limit or not free_text):
        return known_rows <= limit
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) for f in rows.schema
             if f.dataType.typeName() in ("string", "binary")]
    size = reduce(add, texts, F.lit(0)).cast("bigint")
    count, total = rows.limit(limit + 1).agg(F.count("*"), F.sum(size)).first()
    return count <= limit and (total or 0) <= BROADCAST_BYTES


def beyond_broadcast(known_rows: int) -> bool:
    """Whether a side of that many rows is shuffled whatever it holds."""
    return known_rows > BROADCAST_ROWS


class HotKeys:
    """The frequent keys of several lookups over the same rows, found together in one pass when first asked for.

    ``keysets`` names the key columns of each lookup. Each task keeps a sketch of frequent items per lookup, and sketches
    are merged in two steps, so neither the keys nor their counts are shuffled. A key that holds a little more than
    ``share`` of the rows may be missed, by at most ``3.5 / SKETCH_ITEMS`` of them; none is listed that holds less.
    """

    def __init__(self, rows: DataFrame, keysets: dict[str, Sequence[str]], share: float = HOT_SHARE):
        self.rows, self.keysets, self.share = rows, dict(keysets), share
        self._found: dict[str, tuple[DataFrame, int]] | None = None

    def skip(self, name: str) -> None:
        """Leave out a lookup that needs no frequent keys after all."""
        if self._found is None:
            self.keysets.pop(name, None)

    def get(self, name: str) -> tuple[DataFrame, int]:
        """The frequent keys of a lookup, and the rows of the most frequent of them (0 without any)."""
        if self._found is None:
            self._found = self._sketched()
        return self._found[name]

    def _sketched(self) -> dict[str, tuple[DataFrame, int]]:
        names, k = list(self.keysets), math.ceil(1 / self.share)
        texts = [F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{j}") for j, c in enumerate(self.keysets[n])]))
                 .alias(f"k{i}") for i, n in enumerate(names)]
        slot = F.pmod(F.spark_partition_id(), F.lit(SKETCH_SLOTS)).alias("slot")
        parts = self.rows.select(slot, *texts).groupBy("slot").agg(
            F.count("*").alias("n"),
            *[F.expr(f"approx_top_k_accumulate(k{i}, {SKETCH_ITEMS})").alias(f"s{i}") for i in range(len(names))])
        # Grouped by a constant, as a merge of no sketch at all, in an empty partition, is an error in the engine.
        with dropped_shuffles(self.rows.sparkSession):
            found = parts.groupBy(F.lit("all")).agg(F.sum("n").alias("n"), *[
                F.expr(f"approx_top_k_estimate(approx_top_k_combine(s{i}, {SKETCH_ITEMS}), {k})").alias(f"t{i}")
                for i in range(len(names))]).collect()
        out = {}
        for i, name in enumerate(names):
            hot = [r for row in found for r in row[f"t{i}"] if r["count"] > max(row["n"] * self.share, 1)]
            own = self.rows.select(*[F.col(f"`{c}`") for c in self.keysets[name]]).schema
            plain = T.StructType([T.StructField(f"c{j}", field.dataType) for j, field in enumerate(own)])
            listed = self.rows.sparkSession.createDataFrame([(r["item"],) for r in hot], "item string")
            keys = listed.select(F.from_json("item", plain).alias("key")).select("key.*").toDF(*own.names)
            out[name] = keys, max((r["count"] for r in hot), default=0)
        return out


def hot_keys(rows: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys with more than ``share`` of all rows: fewer than ``1 / share`` by construction."""
    return HotKeys(rows, {"keys": keys}, share).get("keys")[0]


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False) -> DataFrame:
    """Equi join keeping the left key columns once."""
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{key}" for key in keys])


def _has_text_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    return all(frame.schema[key].dataType == T.StringType() for frame in (left, right) for key in keys)


def merge_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False) -> DataFrame:
    """Shuffled equi join. Texts are sorted by a hash of them first: a number decides nearly all comparisons, where
    long texts, or several that begin alike, would be compared whole."""
    if not _has_text_keys(left, right, keys):
        return keyed_join(left, right.hint("merge"), keys, how, null_safe)
    hashed = F.xxhash64(*[F.col(f"`{key}`") for key in keys]).alias("_hash")
    return keyed_join(left.select(hashed, "*"), right.select(hashed, "*").hint("merge"), ["_hash", *keys], how,
                      null_safe).drop("_hash")


def sliced_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot: DataFrame,
    null_safe: bool = False, slices: int = SLICES, distinct: bool = False,
) -> DataFrame:
    """Shuffled join in which the rows of ``hot`` keys are spread over slices.

    Equal rows of a hot key are counted first, so that a key of a billion copies is a handful of rows in the join.
    Each counted row is dealt over the slices, with its share of the copies, and gives its copies back behind the join.
    Slices depend on the row alone, so a task that runs again sends the same rows to the same places. Their number
    follows from the measured count of the most frequent key. With ``distinct`` the caller needs equal rows but once, so
    a hot key's copies are not given back.
    """
    flagged = F.broadcast(hot.select(*keys, F.lit(True).alias("_hot")))
    marked = keyed_join(left, flagged, keys, "left", null_safe=True)
    cold = merge_join(marked.filter("_hot IS NULL").drop("_hot"), right, keys, how, null_safe)

    columns = left.columns
    repeated = keyed_join(right, flagged, keys, "inner", null_safe=True).drop("_hot").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    start = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    if distinct:
        dealt = marked.filter("_hot").select(*columns).distinct().withColumn("_slice", F.pmod(start, F.lit(slices)).cast("int"))
        met = keyed_join(dealt, repeated.hint("merge"), [*keys, "_slice"], how, null_safe).drop("_slice")
        return cold.unionByName(met.select(*cold.columns))
    counted = marked.filter("_hot").select(*columns).groupBy(*columns).agg(F.count("*").alias("_copies"))
    parts = F.least(F.col("_copies"), F.lit(slices)).cast("int")
    dealt = counted.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    share = F.floor(F.col("_copies") / parts) + (F.col("_part") < F.col("_copies") % parts).cast("bigint")
    dealt = dealt.select(*columns, share.alias("_share"), F.pmod(start + F.col("_part"), F.lit(slices)).cast("int")
                         .alias("_slice"))
    met = keyed_join(dealt, repeated.hint("merge"), [*keys, "_slice"], how, null_safe).drop("_slice")
    again = met.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_share"))))
    return cold.unionByName(again.select(*cold.columns))


def unique_join(left: DataFrame, right: DataFrame, key: str, known_rows: int | None = None) -> DataFrame:
    """Left join of two sides that are both unique by ``key``, so no key is hot.

    ``known_rows`` bounds the right side; it is broadcast up to the checked size and shuffled otherwise, whatever the
    engine estimates.
    """
    if known_rows is not None and fits_broadcast(right, known_rows=known_rows):
        return left.join(F.broadcast(right), key, "left")
    return merge_join(left, right, [key], "left")


def touched_rows(target: DataFrame, delta: DataFrame, keys: Sequence[str], delta_rows: int | None) -> DataFrame:
    """The target's rows whose key the delta has, where the delta is small enough to be broadcast; else the target.

    One scan of the target without a shuffle, after which a merge works on rows of the delta's size.
    """
    wanted = delta.select(*keys)
    if delta_rows is None or not fits_broadcast(wanted, known_rows=delta_rows):
        return target
    return target.join(F.broadcast(wanted.distinct()), list(keys), "left_semi")


def lookup_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", *, null_safe: bool = False,
    known_rows: int | None = None, keys_from: DataFrame | None = None, limit: int | None = None,
    free_text: bool = False, hot: tuple[HotKeys, str] | None = None, distinct: bool = False,
) -> DataFrame:
    """``left``, ``left_anti`` or ``inner`` join with a broadcast up to a checked size, sliced beyond it.

    ``known_rows`` is an upper bound of the right side's rows, if the caller has one. Frequent keys are looked for
    on ``keys_from`` where it gives the left side's keys more cheaply than the left side itself, or taken from ``hot``,
    where a caller finds those of several lookups together: the keys and this lookup's name among them. ``distinct``
    tells that the caller leaves out equal rows later.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    if fits_broadcast(right, limit, known_rows, free_text):
        return keyed_join(left, F.broadcast(right), keys, how, null_safe)
    if hot is None:
        hot = HotKeys(left if keys_from is None else keys_from, {"keys": keys}), "keys"
    found, most = hot[0].get(hot[1])
    found = found.toDF(*keys)
    if not most:
        return merge_join(left, right, keys, how, null_safe)
    return sliced_join(left, right, keys, how, found, null_safe, max(SLICES, math.ceil(most / SLICE_ROWS)),
                       distinct)


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str], *, shared_are_few: bool,
              hot: tuple[HotKeys, str] | None = None) -> DataFrame:
    """``left_anti`` join for wide rows whose keys can be read cheaply a second time.

    The keys are compared alone first, each key once, so no frequent key can matter. Then the rare outcome, the keys that
    both sides have or, without ``shared_are_few``, those that only the left side has, is broadcast up to the checked
    size, and the wide rows are not shuffled. Where it is not rare, the rows are joined with it as in :func:`lookup_join`,
    where the caller has placed the join: the engine would move a shuffled anti join below lookups that make rows
    narrower. A key with a NULL meets nothing.
    """
    names = [f"`{key}`" for key in keys]
    lines = left.select(*names, F.lit(True).alias("_own"), F.lit(False).alias("_taken")).unionByName(
        right.select(*names, F.lit(False).alias("_own"), F.lit(True).alias("_taken")))
    known = lines.groupBy(*names).agg(F.max("_own").alias("_own"), F.max("_taken").alias("_taken"))
    shared = reduce(and_, [F.col(name).isNotNull() for name in names], F.col("_taken"))
    rare = F.col("_own") & (shared if shared_are_few else ~shared)
    found, count = save_counted(known.filter(rare).select(*names), "keys", lean=True)
    if not fits_broadcast(found, BROADCAST_ROWS, count, free_text=True):
        marked = lookup_join(left, found.withColumn("_found", F.lit(True)), keys, null_safe=not shared_are_few,
                             known_rows=count, free_text=True, hot=hot)
        return marked.filter("_found IS NULL" if shared_are_few else "_found").drop("_found")
    if hot is not None:
        hot[0].skip(hot[1])
    return keyed_join(left, F.broadcast(found), keys, "left_anti" if shared_are_few else "left_semi",
                      null_safe=not shared_are_few)


def resolve(
    rows: DataFrame, lookup: DataFrame, natural_key: Column, lookup_key: str, id_col: str, *,
    known_rows: int | None = None, default: int | None = DEFAULT_ID, keys_from: DataFrame | None = None,
    hot: tuple[HotKeys, str] | None = None,
) -> DataFrame:
    """Add ``id_col`` by looking a natural key up; unmatched rows get the default member.

    ``keys_from`` holds the columns of ``natural_key`` and is cheaper to read than ``rows``, for finding hot keys;
    ``hot`` has them already, under a name.
    """
    side = lookup.select(F.col(lookup_key).alias("_key"), F.col(id_col).alias("_id"))
    keyed = rows.select("*", natural_key.alias("_key"))
    counted = None if keys_from is None else keys_from.select(natural_key.alias("_key"))
    found = lookup_join(keyed, side, ["_key"], known_rows=known_rows, keys_from=counted, hot=hot)
    value = F.col("_id") if default is None else F.coalesce(F.col("_id"), F.lit(default).cast("bigint"))
    return found.select(*rows.columns, value.alias(id_col))

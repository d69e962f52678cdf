"""Blocked Bloom filter as a table, from DataFrame functions alone.

The filter is a table of blocks of four 64-bit words; a value sets one bit in each word of one block. Its size is fixed
by the number of values up to a limit of blocks, so it can always be broadcast; beyond the limit more rows pass that
are not in it. Rows that pass still need an exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_BLOCK = 16  # 16 bits a value: about one false hit in 400
MAX_BLOCKS = 1 << 17  # five numbers a block: 5 MB
_WORDS = range(4)


def _block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(blocks)).cast("int")


def _mask(word: int) -> Column:
    """One of the 64 bits of a word, chosen by six bits of ``_bits``."""
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_bits, {6 * word}) & 63L as int))")


def build(values: DataFrame, column: str, n: int, max_blocks: int = MAX_BLOCKS) -> tuple[DataFrame, int]:
    """The filter over ``n`` distinct values (``_block, _w0 .. _w3``) and its number of blocks."""
    blocks = max(1, min(max_blocks, -(-n // PER_BLOCK)))
    masks = values.select(_block(F.col(column), blocks).alias("_block"), F.xxhash64(column, F.lit(1)).alias("_bits"))
    masks = masks.select("_block", *[_mask(i).alias(f"_w{i}") for i in _WORDS])
    return masks.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in _WORDS]), blocks


def marked(rows: DataFrame, column: str, built: tuple[DataFrame, int], name: str) -> DataFrame:
    """Adds ``name``: whether the filter may hold the value of ``column``; false for null.

    The filter has at most ``MAX_BLOCKS`` rows of five numbers, so it is broadcast.
    """
    table, blocks = built
    value = F.col(column)
    asked = rows.withColumn("_block", F.when(value.isNotNull(), _block(value, blocks))).withColumn(
        "_bits", F.xxhash64(value, F.lit(1)))
    hit = F.lit(True)
    for i in _WORDS:
        hit = hit & (F.col(f"_w{i}").bitwiseAND(_mask(i)) != 0)
    tested = asked.join(F.broadcast(table), "_block", "left").withColumn(name, F.coalesce(hit, F.lit(False)))
    return tested.drop("_block", "_bits", *[f"_w{i}" for i in _WORDS])

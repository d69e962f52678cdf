"""Numpy over whole Arrow batches of texts: words, lines and their hashes without a Python step per word.

A word is a run of characters outside space and U+0009 to U+000D, as in the pattern ``[^\\x20\\x09-\\x0D]+``. All of
those characters are single bytes in UTF-8, so words are found on the bytes. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 2 << 20  # texts of one batch are worked on in slices of about this size; a longer text goes alone
OWNER_BITS = 12  # a slice has at most 2**12 texts
HASH_BITS = 64 - OWNER_BITS
CHUNK_BYTES = 1 << 20  # inside a slice, bytes are expanded to 64-bit numbers in chunks that end between words

_HASH_MASK = np.uint64((1 << HASH_BITS) - 1)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of the public-domain SplitMix64 generator."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """Odd pseudo-random multipliers for the positions 0 to n - 1."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    return mix(steps) | np.uint64(1)


class Texts:
    """The bytes of a slice of texts; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, texts: pa.Array):
        binary = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = binary.buffers()
        bounds = np.frombuffer(offsets, dtype=np.int64)[binary.offset : binary.offset + len(binary) + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        self.data = raw[bounds[0] : bounds[-1]]
        self.offsets = bounds - bounds[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text each byte position lies in."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of True; a run never crosses from one text into the next."""
        n = len(inside)
        if not n:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        begins = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        start, end = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        start[begins] = inside[begins]
        last = begins[1:] - 1
        end[last] = inside[last]
        return np.flatnonzero(start), np.flatnonzero(end) + 1

    def count(self, flag: np.ndarray) -> np.ndarray:
        """Bytes of each text for which ``flag`` holds."""
        return np.diff(np.searchsorted(np.flatnonzero(flag[self.data]), self.offsets))

    def words(self) -> Spans:
        starts, ends = self.runs(~IS_SPACE[self.data])
        return Spans(self, starts, ends)

    def lines(self) -> Spans:
        """The parts between line feeds, empty ones too; a text without any byte has one empty line."""
        breaks = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([breaks, self.offsets[1:]]), kind="stable")
        owner = np.sort(np.concatenate([np.arange(len(self)), self.owner(breaks)]), kind="stable")
        return Spans(self, starts, ends, owner)


class Spans:
    """Pieces of the texts in ascending order, with the text each belongs to."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray | None = None):
        self.texts, self.starts, self.ends = texts, starts, ends
        self.owner = texts.owner(starts) if owner is None else owner

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        """Pieces per text."""
        return np.bincount(self.owner, minlength=len(self.texts))

    def hashes(self, seed: int, fold: np.ndarray = SAME) -> np.ndarray:
        """A 64-bit hash of each piece's bytes after the byte-to-byte map ``fold``."""
        out = np.zeros(len(self), dtype=np.uint64)
        lengths = self.ends - self.starts
        if not len(self):
            return out
        factor = multipliers(int(lengths.max(initial=0)), seed)
        stops = [0]
        while stops[-1] < len(self):
            upto = int(np.searchsorted(self.ends, self.starts[stops[-1]] + CHUNK_BYTES, side="right"))
            stops.append(max(upto, stops[-1] + 1))
        for first, stop in zip(stops, stops[1:], strict=False):
            size = lengths[first:stop]
            filled = size > 0
            if not filled.any():
                continue
            heads = np.cumsum(size) - size
            place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(heads, size)
            at = place + np.repeat(self.starts[first:stop], size)
            value = (fold[self.texts.data[at]].astype(np.uint64) + np.uint64(1)) * factor[place]
            out[first:stop][filled] = np.add.reduceat(value, heads[filled])
        return mix(out ^ mix(lengths.astype(np.uint64) + np.uint64(seed)))


def windows(hashes: np.ndarray, owner: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` neighbours within one text, with the index of each run's first member."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    first = np.flatnonzero(owner[:n] == owner[width - 1 :])
    total = np.zeros(len(first), dtype=np.uint64)
    for place, factor in enumerate(multipliers(width, seed)):
        total += hashes[first + place] * factor
    return mix(total), first


def distinct(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, hash) pairs in ascending order, and how often each occurs.

    Hashes are cut to their upper ``HASH_BITS`` bits, so that one sort of plain integers does the work.
    """
    key = np.sort((owner.astype(np.uint64) << np.uint64(HASH_BITS)) | (values >> np.uint64(OWNER_BITS)))
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(fresh)
    key = key[at]
    return (key >> np.uint64(HASH_BITS)).astype(np.int64), key & _HASH_MASK, np.diff(np.append(at, len(fresh)))


def sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of the 64-bit integers of each owner, wrapping around; ``owner`` ascends."""
    out = np.zeros(n, dtype=values.dtype)
    if len(values):
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[heads]] = np.add.reduceat(values, heads)
    return out


def sliced(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``SLICE_BYTES`` together."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    first = 0
    while first < batch.num_rows:
        start = ends[first] - lengths[first]
        stop = max(int(np.searchsorted(ends, start + SLICE_BYTES, side="right")), first + 1)
        stop = min(stop, first + (1 << OWNER_BITS))
        yield batch.slice(first, stop - first)
        first = stop


def per_text(
    df: DataFrame, column: str, fields: Sequence[T.StructField], compute: Callable[[], Callable], keep: Sequence[str],
) -> DataFrame:
    """Columns computed from whole texts, next to the ``keep`` columns of each row.

    ``compute()`` runs once per task and returns a function from a slice's Arrow array of texts to one array per
    field. A kept column that has the name of a new one gives way to it.
    """
    names = {f.name.lower() for f in fields}
    kept = [c for c in keep if c.lower() not in names]
    schema = T.StructType([*[df.schema[c] for c in kept], *fields])
    types = [f.type for f in to_arrow_schema(T.StructType(list(fields)))]

    def run(batches):
        work = compute()
        for batch in batches:
            for part in sliced(batch, "text"):
                new = work(part.column("text"))
                new = [a if isinstance(a, pa.Array) else pa.array(a) for a in new]
                new = [a if a.type == t else a.cast(t) for a, t in zip(new, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names=schema.names)

    return df.select(*numbered(kept), df[column].cast("string").alias("text")).mapInArrow(run, schema)


def numbered(columns: Sequence[str]) -> list[Column]:
    """Columns under names of their place, so that names of the input cannot clash with those of a step."""
    return [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)]

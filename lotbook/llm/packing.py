"""Best-fit packing of tokenised documents into sequences, by non-negative least squares on the length histogram.

1. Documents become token ids with an end id; only those longer than a sequence are cut, their remainder first.
2. The histogram of piece lengths, at most ``capacity`` numbers, is all that planning sees.
3. Lengths are grouped into classes of ``grain`` tokens. All patterns of at most three classes whose upper bounds add up
   to the capacity are enumerated, and non-negative least squares (Lawson-Hanson) fits how often each is repeated.
4. Repeats are rounded down and filled with real lengths: the longer members come from the pattern's classes, the last
   is the longest piece that still fits. What is left is packed by best fit: the longest piece first, then always the
   longest that fits, each sequence repeated as often as its lengths allow.
5. Every step takes a multiple of equal sequences, so the plan has a few thousand rows whatever the corpus; pieces find
   their sequence by their rank among the pieces of their length.

Planning is bounded by the capacity and runs on the driver; tokenising, ranking and placing are distributed. Ranks come
from a range sort of which the driver sees one count per partition and length.

Defined cases: a null text is an empty one, a document of the end id alone; repeated rows, and rows with equal ids, are
documents of their own, placed once each; ties in length are ordered by id, piece and row; an empty table gives an
empty result. Only the id and the text column are read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.operators.surrogate import assign_surrogate
from lotbook.sources.scratch import save

CAPACITY = 2048
GRAIN = 16
TOKENIZER = "byte_bpe_50k"


@functools.lru_cache(maxsize=4)
def load_tokenizer(name: str = TOKENIZER, path=None):
    """A function from a text to its ids.

    ``name`` is a file of the public vocabularies; ``path`` maps a file name to its place. For a vocabulary that also
    exists as ranks the ids are computed by tiktoken, which gives the ids of the tokenizers file about six times as
    fast; should it fail on a text, the tokenizers file itself is used.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path
    with open(path(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = {"<|endoftext|>": 50256}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    exact = []

    def encode(text: str) -> Sequence[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # a failed match of the splitting pattern surfaces as a panic, which is no Exception
            if not exact:
                exact.append(Tokenizer.from_file(path(f"{name}.json")))
            return exact[0].encode(text, add_special_tokens=False).ids

    return encode


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens: full ones, behind a shorter one if need be."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *[(start, capacity) for start in range(first, n, capacity)]]


def pieces(docs: DataFrame, id_col: str, text_col: str, *, capacity: int = CAPACITY, end_id: int = 0,
           tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``piece, start, length, ids_crc32``, and the ``ids`` themselves if asked for."""
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([
        source.schema["_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])

    def run(batches):
        encode = load_tokenizer(tokenizer)
        for batch in batches:
            owner, out, crcs, kept = [], [], [], []
            for row, text in enumerate(batch.column("_text")):
                ids = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    part = ids[start : start + length]
                    owner.append(row)
                    out.append((number, start, length))
                    crcs.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype(np.int32))
            numbers = np.array(out, dtype=np.int64).reshape(-1, 3)
            columns = [batch.column("_id").take(pa.array(owner, pa.int64())),
                       pa.array(numbers[:, 0].astype(np.int32)), pa.array(numbers[:, 1]), pa.array(numbers[:, 2]),
                       pa.array(crcs, pa.int64())]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def patterns(classes: int) -> np.ndarray:
    """All rows of up to three classes, descending and padded with 0, that add up to ``classes``."""
    rows = [(classes, 0, 0)]
    rows += [(a, classes - a, 0) for a in range((classes + 1) // 2, classes)]
    for a in range(classes, 0, -1):
        for b in range(min(a, classes - a - 1), 0, -1):
            c = classes - a - b
            if c <= b:
                rows.append((a, b, c))
    return np.array(sorted(set(rows), reverse=True), dtype=np.int64)


def nonnegative_least_squares(columns: np.ndarray, wanted: np.ndarray, max_rounds: int = 2000) -> np.ndarray:
    """Lawson-Hanson: ``x >= 0`` with the least ``|A x - wanted|``.

    ``columns`` gives the few rows in which each column of A counts, 0 for none, the same row twice for two.
    """
    n, height = len(columns), len(wanted)
    x, passive = np.zeros(n), np.zeros(n, dtype=bool)
    scale = max(1.0, float(np.abs(wanted).max(initial=0)))

    def dense(chosen: np.ndarray) -> np.ndarray:
        matrix = np.zeros((height + 1, len(chosen)))
        for place in range(columns.shape[1]):
            np.add.at(matrix, (columns[chosen, place], np.arange(len(chosen))), 1.0)
        return matrix[1:]

    def gradient() -> np.ndarray:
        made = np.zeros(height + 1)
        for place in range(columns.shape[1]):
            np.add.at(made, columns[:, place], x)
        rest = np.concatenate([[0.0], wanted - made[1:]])
        return rest[columns].sum(axis=1)

    for _ in range(max_rounds):
        slope = np.where(passive, -np.inf, gradient())
        best = int(np.argmax(slope))
        if not slope[best] > 1e-9 * scale:
            break
        passive[best] = True
        while True:
            chosen = np.flatnonzero(passive)
            fitted = np.linalg.lstsq(dense(chosen), wanted, rcond=None)[0]
            if fitted.min() > 0:
                x[:] = 0
                x[chosen] = fitted
                break
            old = x[chosen]
            falling = fitted <= 0
            share = np.min(old[falling] / np.maximum(old[falling] - fitted[falling], 1e-300))
            x[chosen] = old + share * (fitted - old)
            passive[chosen[(x[chosen] <= 1e-12 * scale) & falling]] = False
            x[~passive] = 0
            if not passive.any():
                break
    return x


@dataclass(frozen=True)
class Plan:
    """Runs of equal sequences: lengths of the members, number of sequences."""

    runs: list[tuple[tuple[int, ...], int]]

    @property
    def sequences(self) -> int:
        return sum(count for _, count in self.runs)

    def slots(self) -> Iterable[tuple[int, int, int, int, int]]:
        """(length, first rank, ranks, first sequence, offset) of each member of each run."""
        used: dict[int, int] = {}
        sequence = 0
        for members, count in self.runs:
            offset = 0
            for length in members:
                first = used.get(length, 0)
                yield length, first, count, sequence, offset
                used[length] = first + count
                offset += length
            sequence += count


class _Stock:
    """Pieces still to be packed, by length."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in histogram.items():
            self.left[length] = count

    def longest(self, limit: int, without: dict[int, int] = {}, least: int = 1) -> int:  # noqa: B006
        """The longest length of ``least`` to ``limit`` in stock after taking ``without``; 0 if there is none."""
        for length in np.flatnonzero(self.left[least : limit + 1])[::-1] + least:
            if self.left[length] > without.get(int(length), 0):
                return int(length)
        return 0

    def take(self, members: Sequence[int], most: int | None = None) -> int:
        """Takes the members as often as possible, ``most`` times at most."""
        need: dict[int, int] = {}
        for length in members:
            need[length] = need.get(length, 0) + 1
        count = min(int(self.left[length]) // n for length, n in need.items())
        count = count if most is None else min(count, most)
        for length, n in need.items():
            self.left[length] -= n * count
        return count


def plan(histogram: dict[int, int], capacity: int = CAPACITY, grain: int = GRAIN) -> Plan:
    """Sequences for a histogram of piece lengths; every piece is placed exactly once."""
    stock, runs = _Stock(histogram, capacity), []
    if histogram.get(capacity):
        runs.append(((capacity,), stock.take([capacity])))
    classes = -(-capacity // grain)
    wanted = np.zeros(classes)
    lengths = np.arange(1, capacity + 1)
    np.add.at(wanted, (lengths - 1) // grain, stock.left[1:].astype(float))
    shapes = patterns(classes)
    repeats = np.floor(nonnegative_least_squares(shapes, wanted) + 1e-6).astype(np.int64) if wanted.any() else []
    for shape, repeat in zip(shapes, repeats, strict=False):
        shape, remaining = [int(c) for c in shape if c], int(repeat)
        while remaining:
            members: list[int] = []
            need: dict[int, int] = {}
            for place, c in enumerate(shape):
                room = capacity - sum(members)
                last = place == len(shape) - 1 and place > 0
                low = max((c - 1) * grain + 1 - (2 * grain if last else 0), 1)
                length = stock.longest(room if last else min(c * grain, room), need, low)
                if not length:
                    break
                members.append(length)
                need[length] = need.get(length, 0) + 1
            else:
                count = stock.take(members, remaining)
                runs.append((tuple(members), count))
                remaining -= count
                continue
            break
    while True:
        members, need, room = [], {}, capacity
        while room and (length := stock.longest(room, need)):
            members.append(length)
            need[length] = need.get(length, 0) + 1
            room -= length
        if not members:
            return Plan(runs)
        runs.append((tuple(members), stock.take(members)))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = CAPACITY, grain: int = GRAIN,
    end_id: int = 0, tokenizer: str = TOKENIZER, with_ids: bool = False,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; members of a sequence follow each other without a gap."""
    cut_up = save(pieces(docs, id_col, text_col, capacity=capacity, end_id=end_id, tokenizer=tokenizer,
                         with_ids=with_ids), "pieces")
    # Full pieces need no rank by id: each is a sequence of its own, in any order.
    numbered = assign_surrogate(cut_up, "_rank", ["_id", "piece"], start=0, within=["length"])
    histogram = {length: count for (length,), count in numbered.counts.items()}
    places: dict[int, list] = {}
    for length, first, count, sequence, offset in plan(histogram, capacity, grain).slots():
        places.setdefault(length, []).append((first, first + count, sequence, offset))
    slot = T.StructType([T.StructField(n, T.LongType()) for n in ("first", "stop", "sequence", "at")])
    schema = T.StructType([T.StructField("length", T.LongType()), T.StructField("_slots", T.ArrayType(slot))])
    # At most one row per length up to the capacity.
    table = docs.sparkSession.createDataFrame(sorted(places.items()), schema)
    rank = F.col("_rank")
    found = numbered.rows.join(F.broadcast(table), "length").withColumn(
        "_slot", F.filter("_slots", lambda s: (s["first"] <= rank) & (rank < s["stop"]))[0])
    columns = [c for c in cut_up.columns if c != "_id"]
    return found.select(
        F.col("_id").alias(id_col), *columns, (F.col("_slot.sequence") + rank - F.col("_slot.first"))
        .alias("sequence_id"), F.col("_slot.at").alias("offset"))

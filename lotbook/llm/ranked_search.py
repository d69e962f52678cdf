"""Ranked lexical search with an inverted index of compressed blocks and Block-Max MaxScore.

**Index.** Documents are gathered into shards of about ``SHARD_BYTES`` of text inside the reading tasks, so the index is
built in one pass without a shuffle. A shard numbers its documents by ascending id. For each of its terms it has one row:
postings in blocks of 128 as byte-packed gaps and frequencies, and per block the last document, the largest frequency
and the smallest document size, from which the block's bound follows once the corpus statistics are known. One more row
without a term holds the ids and sizes of the shard's documents.

**Statistics.** Numbers of documents and terms are summed over the shards' own rows, document frequencies over the rows
of the queried terms. Only two numbers reach the driver.

**Search.** Items are dealt into blocks of about ``ITEM_BLOCK``; each pair of shard and item block is one group that
gets the postings of the block's terms. For one item, lists are ordered by their bound. Lists whose bounds sum up to no
more than the worst score kept are non-essential: documents that only they hold cannot enter. Documents are worked on in
windows of ascending number, short ones first so that the worst score kept soon rises: essential lists are added up, then the others from the strongest to the weakest, where a
candidate is dropped without decompressing a block if its score so far, the block's bound and the bounds of all weaker
lists do not pass the worst score kept. Each shard returns its best ``k`` of an item, and a window over these merges them.

**Scores** are whole numbers: with N documents that have a term, L their terms, n a document's terms, df and tf, a
term weighs ``floor(1000 * ln((2N + 2) / (2 df + 1)))`` and adds ``w * ((10**9 tf) div (1000 tf + 20 m))``, where
``m = 50 + (50 n N) div L``. Equal scores are ordered by ascending id, ids that are null last.

Defined cases: null and empty texts hold no term and are never found; a text of any length is one document; rows that
repeat an id are ranked each; rows that repeat an item are answered each; an item without terms, or whose terms no
document has, gives no row; empty tables give an empty result. Only the id and text columns are read. Terms are told
apart by a 64-bit hash within a shard and by their spelling across shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lotbook.llm.text_arrays import LOWER, Spans, Texts, sliced
from lotbook.llm.vocabulary import Vocabulary
from lotbook.sources.scratch import save, save_counted

K = 50
BLOCK = 128
SHARD_BYTES = 16 << 20
SHARD_DOCS = 1 << 16
ITEM_BLOCK = 256
FIRST_WINDOW = 1 << 7  # documents; each window is twice the one before, up to the largest
WINDOW = 1 << 12
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
IS_TERM = np.zeros(256, dtype=bool)
IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _width(most: np.ndarray) -> np.ndarray:
    """Bytes that a number needs."""
    return 1 + (most > 0xFF).astype(np.int64) + (most > 0xFFFF) + (most > 0xFFFFFF)


def packed_blocks(docs: np.ndarray, counts: np.ndarray, heads: np.ndarray, before: np.ndarray) -> pa.Array:
    """Postings as one binary per block: a byte of widths, the gaps, the frequencies.

    ``heads`` are the places where blocks begin, ``before`` the document number each block's gaps start from.
    """
    sizes = np.diff(np.append(heads, len(docs)))
    block = np.repeat(np.arange(len(heads)), sizes)
    gaps = np.empty(len(docs), dtype=np.int64)
    gaps[1:] = docs[1:] - docs[:-1]
    gaps[heads] = docs[heads] - before
    wide = [_width(np.maximum.reduceat(v, heads)) for v in (gaps, counts)]
    lengths = 1 + sizes * (wide[0] + wide[1])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    data = np.zeros(bounds[-1], dtype=np.uint8)
    data[bounds[:-1]] = wide[0] | wide[1] << 4
    place = np.arange(len(docs)) - heads[block]
    begin = bounds[:-1] + 1
    for values, width in ((gaps, wide[0]), (counts, wide[1])):
        at = begin[block] + place * width[block]
        for byte in range(4):
            has = np.flatnonzero(width[block] > byte)
            data[at[has] + byte] = values[has] >> 8 * byte & 0xFF
        begin = begin + sizes * width
    return pa.Array.from_buffers(
        pa.large_binary(), len(heads), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])


def unpacked(block: bytes, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and frequencies of a block."""
    widths = block[0] & 15, block[0] >> 4
    size = (len(block) - 1) // sum(widths)
    at, found = 1, []
    for width in widths:
        raw = np.frombuffer(block, dtype=np.uint8, count=size * width, offset=at).reshape(size, width)
        found.append(raw @ (1 << 8 * np.arange(width)))
        at += size * width
    return before + np.cumsum(found[0]), found[1]


class _Shard:
    """Documents gathered until they fill a shard."""

    def __init__(self):
        self.vocabulary, self.owners, self.sizes, self.ids, self.bytes = Vocabulary(), [], [], [], 0

    def add(self, ids: pa.Array, column: pa.Array) -> None:
        texts = Texts(column)
        spans = Spans(texts, *texts.runs(IS_TERM[texts.data]))
        self.vocabulary.add(spans, spans.hashes(11, LOWER))
        self.owners.append(spans.owner + sum(map(len, self.sizes)))
        self.sizes.append(spans.counts())
        self.ids.append(ids)
        self.bytes += len(texts.data)

    def full(self) -> bool:
        return self.bytes >= SHARD_BYTES or sum(map(len, self.sizes)) >= SHARD_DOCS

    def rows(self, number: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        terms, _, code = self.vocabulary.finish()
        sizes = np.concatenate(self.sizes).astype(np.int64)
        ids = pa.chunked_array(self.ids).combine_chunks()
        order = pc.sort_indices(ids).to_numpy()
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        n = len(order)
        whole = pa.array([0, n], pa.int32())
        nothing = pa.ListArray.from_arrays(pa.array([0, 0], pa.int32()), pa.array([], pa.int32()))
        yield pa.RecordBatch.from_arrays([
            pa.array([number]), pa.nulls(1, pa.string()), pa.array([int((sizes > 0).sum())]),
            pa.array([int(sizes.sum())]), nothing, nothing, nothing,
            pa.ListArray.from_arrays(pa.array([0, 0], pa.int32()), pa.array([], pa.binary())),
            pa.ListArray.from_arrays(whole, ids.take(pa.array(order))),
            pa.ListArray.from_arrays(whole, pa.array(sizes[order])),
        ], schema=schema)
        if not len(terms):
            return
        pair, counts = np.unique(code * n + place[np.concatenate(self.owners)], return_counts=True)
        term, doc = pair // n, pair % n
        first = np.searchsorted(term, np.arange(len(terms) + 1))
        blocks = -(-np.diff(first) // BLOCK)
        block_bounds = np.concatenate([[0], np.cumsum(blocks)])
        of_term = np.repeat(np.arange(len(terms)), blocks)
        heads = first[of_term] + BLOCK * (np.arange(len(of_term)) - block_bounds[of_term])
        last = doc[np.minimum(heads + BLOCK, first[of_term + 1]) - 1]
        before = np.where(heads == first[of_term], -1, doc[heads - 1])
        packed = packed_blocks(doc, counts, heads, before)
        largest, smallest = np.maximum.reduceat(counts, heads), np.minimum.reduceat(sizes[order][doc], heads)
        for start in range(0, len(terms), 1 << 14):
            stop = min(start + (1 << 14), len(terms))
            inside, offsets = slice(block_bounds[start], block_bounds[stop]), block_bounds[start : stop + 1]
            offsets = offsets - offsets[0]
            size = stop - start
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(size, number)), terms[start:stop].cast(pa.string()),
                pa.array(np.diff(first)[start:stop]), pa.nulls(size, pa.int64()),
                *[_lists(v[inside].astype(np.int32), offsets) for v in (last, largest, smallest)],
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), packed[inside].cast(pa.binary())),
                pa.nulls(size, schema.field("ids").type), pa.nulls(size, schema.field("sizes").type),
            ], schema=schema)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index as a written table: a row per shard and term, and one without a term per shard."""
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("term", T.StringType()), T.StructField("df", T.LongType()),
        T.StructField("total", T.LongType()), T.StructField("last", ints), T.StructField("max_tf", ints),
        T.StructField("min_n", ints), T.StructField("blocks", T.ArrayType(T.BinaryType())),
        T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
        T.StructField("sizes", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for part in sliced(batch, "text"):
                shard.add(part.column("id"), part.column("text"))
                if shard.full():
                    yield from shard.rows(number, arrow)
                    number, shard = number + 1, _Shard()
        if shard.sizes:
            yield from shard.rows(number, arrow)

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return save(rows.mapInArrow(run, schema), "index")


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.array_distinct(F.regexp_extract_all(F.translate(text, upper, upper.lower()), F.lit(TERM), F.lit(0)))


class _List:
    """The postings of one term in one shard, with bounds; blocks are decompressed when asked for, and once."""

    def __init__(self, weight: int, last, max_tf, min_n, blocks, norm, norms: np.ndarray):
        self.weight, self.last, self.blocks, self.norms = weight, np.asarray(last, dtype=np.int64), blocks, norms
        self.bounds = self.gain(np.asarray(max_tf, dtype=np.int64), norm(np.asarray(min_n, dtype=np.int64)))
        self.bound = int(self.bounds.max())
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def gain(self, tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return self.weight * ((10**9 * tf) // (1000 * tf + 20 * norms))

    def open(self, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Document numbers of a block and what the term adds to their scores."""
        if block not in self.opened:
            docs, tf = unpacked(self.blocks[block], int(self.last[block - 1]) if block else -1)
            self.opened[block] = docs, self.gain(tf, self.norms[docs])
        return self.opened[block]


def best(lists: list[_List], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the ``k`` best documents of a shard, by Block-Max MaxScore; equal scores by number."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    below = np.concatenate([[0], np.cumsum([x.bound for x in lists])]).astype(np.int64)
    docs, scores, worst = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 0
    start, width = 0, min(FIRST_WINDOW, WINDOW)
    while start < n_docs:
        # Later documents lose ties, so a bound must pass the worst score kept.
        essential = int(np.searchsorted(below[1:], worst, side="right"))
        if essential == len(lists):
            break
        stop = min(start + width, n_docs)
        score = np.zeros(stop - start, dtype=np.int64)
        for x in lists[essential:]:
            for block in range(*np.searchsorted(x.last, [start, stop - 1]) + [0, 1]):
                if block < len(x.last):
                    at, gain = x.open(block)
                    inside = slice(*np.searchsorted(at, [start, stop]))
                    score[at[inside] - start] += gain[inside]
        found = np.flatnonzero(score)
        for i in range(essential - 1, -1, -1):
            x = lists[i]
            block = np.searchsorted(x.last, found + start)
            bound = np.append(x.bounds, 0)[block]
            keep = score[found] + bound + below[i] > worst
            found, block = found[keep], block[keep]
            if not len(found):
                break
            heads = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            for head, end in zip(heads, [*heads[1:], len(block)], strict=True):
                if block[head] < len(x.last):
                    at, gain = x.open(int(block[head]))
                    asked = found[head:end] + start
                    place = np.minimum(np.searchsorted(at, asked), len(at) - 1)
                    score[found[head:end]] += np.where(at[place] == asked, gain[place], 0)
        found = found[score[found] > worst]
        if len(found):
            docs, scores = np.append(docs, found + start), np.append(scores, score[found])
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            worst = int(scores[-1]) if len(docs) == k else 0
        start, width = stop, min(2 * width, WINDOW)
    return docs, scores


def search(index: DataFrame, items: DataFrame, k: int = K, item_col: str = "item_id", text_col: str = "text",
           id_col: str = "doc_id") -> DataFrame:
    """The ``k`` best documents of each item: the item's id, ``rank`` (int, from 1), the document's id and ``score``."""
    n_docs, n_terms = index.filter("term IS NULL").agg(F.sum("df"), F.sum("total")).first()
    asked, n_items = save_counted(items.select(
        F.monotonically_increasing_id().alias("item"), F.col(f"`{item_col}`").alias("name"),
        terms(F.col(f"`{text_col}`").cast("string")).alias("terms")), "items")
    item_blocks = max(1, -(-n_items // ITEM_BLOCK))
    part = F.pmod(F.xxhash64("item"), F.lit(item_blocks)).alias("part")
    queried = asked.select("item", part, F.explode("terms").alias("term")).groupBy("term", "part").agg(
        F.collect_list("item").alias("items"))
    postings = save(
        index.filter("term IS NOT NULL").join(queried.select("term").distinct(), "term", "left_semi"), "postings")
    weight = F.floor(1000 * F.log((2.0 * (n_docs or 0) + 2.0) / (2.0 * F.sum("df") + 1.0))).cast("long")
    weights = postings.groupBy("term").agg(weight.alias("weight")).join(queried, "term")
    wanted = postings.join(weights, "term").select(
        "shard", "part", "weight", "items", "last", "max_tf", "min_n", "blocks", "ids", "sizes")
    none = {"weight": "long", "items": "array<long>"}
    shards = index.filter("term IS NULL").select(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(item_blocks - 1).cast("long"))).alias("part"),
        *[F.lit(None).cast(t).alias(c) for c, t in none.items()], "last", "max_tf", "min_n", "blocks", "ids", "sizes")
    schema = T.StructType([
        T.StructField("item", T.LongType()), T.StructField("id", index.schema["ids"].dataType.elementType),
        T.StructField("score", T.LongType())])
    arrow = to_arrow_schema(schema)

    def norm(sizes: np.ndarray) -> np.ndarray:
        return 50 + (50 * sizes * n_docs) // n_terms

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        about = next(r for r in rows if r["items"] is None)
        norms = norm(np.asarray(about["sizes"], dtype=np.int64)) if n_terms else np.zeros(0, dtype=np.int64)
        lists: dict[int, list[_List]] = {}
        for row in rows:
            if row["items"] is not None:
                found = _List(row["weight"], row["last"], row["max_tf"], row["min_n"], row["blocks"], norm, norms)
                for item in row["items"]:
                    lists.setdefault(item, []).append(found)
        out: tuple[list, list, list] = ([], [], [])
        for item, own in lists.items():
            docs, scores = best(own, len(norms), k)
            out[0].extend([item] * len(docs))
            out[1].extend(about["ids"][d] for d in docs)
            out[2].extend(scores.tolist())
        return pa.table([pa.array(v, f.type) for v, f in zip(out, arrow, strict=True)], schema=arrow)

    heaps = save(wanted.unionByName(shards).groupBy("shard", "part").applyInArrow(run, schema), "heaps")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "name"), "item").select(
        F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def rank(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The ``k`` best documents of each item, over an index of all documents."""
    return search(build_index(docs), items, k)

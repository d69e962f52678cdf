"""Collocations: frequent phrases of two to five words whose weakest cut is still strong, counted exactly.

**Words.** Texts are read once. Each reading task gathers shards of about ``SHARD_BYTES`` of text and writes, per shard,
its distinct words with their counts and the text as codes of those words, with a break between pieces. Words found
often enough in their language get a dense id. Every shard learns the ids of its own words from a broadcast dictionary,
if that is small by its measured rows and bytes, and by a shuffled join otherwise.

**Phrases.** Word ids of a phrase are packed into one number. A shard counts its phrases of one length in counting
quotient filters, one for each part of the permuted key space (:mod:`lotbook.llm.quotient_filter`), and the filters of a
part are merged over all shards by merging their sorted entries. A phrase can only be frequent if the two phrases of one
word less in it are, so lengths are worked through in turn: the merge sends each shard a bit for each of its entries,
broadcast if all bits are few by their bytes, and the shard keeps the places that go on. Text that no frequent phrase covers is left behind. Permuted keys are spread
evenly over the parts, and a shard has one entry for a phrase however often it holds it, so no phrase makes a part heavy.
The number of parts follows the number of words.

**Cuts.** The score of a cut is ``floor(1000 * a * n / (l * r))`` in whole decimals; the least counts, and among equals the
earliest. A phrase is dropped if a longer candidate holds it and is ``percent`` % as frequent. As phrases of one word
more lie between, it is enough to look at those.

Defined cases: null texts count as empty, a null language as ``und``; pieces without words, and texts without any, add
nothing; a text of any length is one text; repeated rows count each; an empty table, or one without frequent words,
gives an empty result. Only the text and language columns are read. Words are told apart by a 64-bit hash of word and
language within a shard and by their spelling across shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lotbook.llm import quotient_filter as qf
from lotbook.llm.text_arrays import IS_SPACE, LOWER, Spans, Texts, mix, sliced
from lotbook.llm.vocabulary import Vocabulary
from lotbook.operators.surrogate import assign_surrogate
from lotbook.sources.scratch import save, save_counted

LONGEST = 5
LEAST = 100
TOP = 2000
PERCENT = 100
SHARD_BYTES = 16 << 20
BROADCAST_WORDS = 1 << 20
BROADCAST_BYTES = 32 << 20  # of the words as text; of the shards' marks
PART_WORDS = 1 << 20  # words of the corpus for each part of the key space
IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[[*b".,;:!?", 10, 11, 12, 13]] = True
IS_WORD = ~IS_BREAK & ~IS_SPACE
_INTS = T.ArrayType(T.IntegerType())
_STEP = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("part", T.LongType()), T.StructField("entries", T.BinaryType()),
    T.StructField("open", T.BinaryType())])
_MERGED = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("part", T.LongType()), T.StructField("marks", T.BinaryType()),
    T.StructField("ids", _INTS), T.StructField("f", T.LongType())])


def _hashes(words: Spans, langs: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """A 64-bit hash of each word with its text's language; the languages, and which one each text has."""
    coded = langs.dictionary_encode()
    names = Texts(coded.dictionary)
    lang = coded.indices.to_numpy(zero_copy_only=False)
    mark = Spans(names, names.offsets[:-1], names.offsets[1:], np.arange(len(names))).hashes(13)
    hashes = mix(words.hashes(12, LOWER) ^ mark[lang[words.owner]]) if len(words) else np.zeros(0, np.uint64)
    return hashes, coded.dictionary, lang


def _word_hashes(words: pa.Array, langs: pa.Array) -> np.ndarray:
    """:func:`_hashes` of single words."""
    texts = Texts(words)
    return _hashes(Spans(texts, texts.offsets[:-1], texts.offsets[1:], np.arange(len(texts))), langs)[0]


class _Shard:
    """Words of the texts gathered so far."""

    def __init__(self):
        self.vocabulary, self.langs, self.breaks, self.bytes = Vocabulary(), [], [], 0

    def add(self, column: pa.Array, langs: pa.Array) -> None:
        texts = Texts(column)
        spans = Spans(texts, *texts.runs(IS_WORD[texts.data]))
        hashes, names, lang = _hashes(spans, langs)
        first = self.vocabulary.add(spans, hashes)
        self.langs.append(names.take(pa.array(lang[spans.owner[first]])))
        before = np.searchsorted(np.flatnonzero(IS_BREAK[texts.data]), spans.starts)
        apart = np.ones(len(spans), dtype=bool)
        apart[1:] = (spans.owner[1:] != spans.owner[:-1]) | (before[1:] != before[:-1])
        self.breaks.append(apart)
        self.bytes += len(texts.data)

    def row(self, number: int, schema: pa.Schema) -> pa.RecordBatch:
        words, first, code = self.vocabulary.finish()
        apart = np.concatenate(self.breaks)
        codes = np.zeros(len(code) + int(apart.sum()), dtype=np.int32)
        codes[np.arange(len(code)) + np.cumsum(apart)] = code + 1
        bounds = pa.array([0, len(words)], pa.int32())
        langs = pa.chunked_array(self.langs).combine_chunks().take(pa.array(first)).cast(pa.string())
        counts = np.bincount(code, minlength=len(words)).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([number]), *[pa.ListArray.from_arrays(bounds, x) for x in (
                langs, words.cast(pa.string()), pa.array(counts))],
            pa.array([_stored(codes)], pa.binary())], schema=schema)


def _stored(codes: np.ndarray) -> bytes:
    """Numbers below 2**31, compressed byte by byte of their places, as the upper ones differ little."""
    return zlib.compress(codes.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _restored(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64)


def _shards(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Per shard: its distinct words with language and count, and the text as codes (from 1; 0 is a break)."""
    strings = T.ArrayType(T.StringType())
    schema = T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("langs", strings), T.StructField("words", strings),
        T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("codes", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for part in sliced(batch, "text"):
                shard.add(part.column("text"), part.column("lang"))
                if shard.bytes >= SHARD_BYTES:
                    yield shard.row(number, arrow)
                    number, shard = number + 1, _Shard()
        if shard.bytes:
            yield shard.row(number, arrow)

    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang")
    return docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), lang).mapInArrow(run, schema)


def _windows(ids: np.ndarray, at: np.ndarray, size: int, width: int) -> qf.Limbs:
    """Permuted keys of the phrases of ``size`` words that begin at the places ``at``."""
    return qf.permuted(qf.pack([ids[at + i] for i in range(size)], width), size * width)


def _counted(shard: int, ids: np.ndarray, begins: np.ndarray, size: int, width: int, part_bits: int,
             ) -> Iterator[pa.RecordBatch]:
    """The state of a shard and its filters of phrases of ``size`` words that begin where ``begins`` is set."""
    schema = to_arrow_schema(_STEP)
    part_bits = min(part_bits, qf.widths(size * width)[0])
    keys, counts, _ = qf.tallied(_windows(ids, np.flatnonzero(begins), size, width))
    part = qf.parts(keys, size * width, part_bits)
    heads, stops = np.unique(part, return_index=True)[1], np.searchsorted(part, np.unique(part), side="right")
    filters = [qf.dumped([k[a:b] for k in keys], counts[a:b], size * width, part_bits)
               for a, b in zip(heads, stops, strict=True)]
    yield pa.RecordBatch.from_arrays([
        pa.array([shard] * (len(heads) + 1)), pa.array([-1, *part[heads].tolist()], pa.int64()),
        pa.array([_stored(ids), *filters], pa.binary()),
        pa.array([zlib.compress(np.packbits(begins).tobytes(), 1)] + [None] * len(heads), pa.binary())],
        schema=schema)


def _first_step(width: int, part_bits: int, dictionary=None):
    """From codes and the ids of the shard's words to phrases of two words.

    ``dictionary``, if given, holds the hashes of all words with an id in ascending order, and those ids; else the rows
    bring the ids of their shard's words as ``known``.
    """
    def ids_of(batch: pa.RecordBatch, row: int) -> np.ndarray:
        """The id of each word of a shard, 0 without one."""
        if dictionary is None:
            code, number = batch.column("known")[row].values.flatten()
            table = np.zeros(batch.column("n")[row].as_py(), dtype=np.int64)
            table[code.to_numpy()] = number.to_numpy()
            return table
        hashes, numbers = dictionary.value
        own = _word_hashes(batch.column("words")[row].values, batch.column("langs")[row].values)
        at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
        return np.where(hashes[at] == own, numbers[at], 0)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                table = np.append(0, ids_of(batch, row))
                ids = np.append(table[_restored(batch.column("codes")[row].as_py())], 0)
                begins = ids > 0
                begins[:-1] &= ids[1:] > 0
                shard = batch.column("shard")[row].as_py()
                yield from _counted(shard, *_trimmed(ids, ids > 0, 1, begins), 2, width, part_bits)

    return run


def _trimmed(ids: np.ndarray, alive: np.ndarray, size: int, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the words that no frequent phrase of ``size`` words covers; one break stays for each run of them."""
    covered = alive.copy()
    for i in range(1, size):
        covered[i:] |= alive[:-i]
    keep = covered.copy()
    keep[1:] |= covered[:-1]
    ids = np.where(covered, ids, 0)
    return np.append(ids[keep], 0), np.append(begins[keep], False)


def _next_step(size: int, width: int, part_bits: int):
    """From phrases of ``size - 1`` words and their marks to those of ``size`` words."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "entries", "open", "marks")]
            for shard, entries, opened, marks in zip(*columns, strict=True):
                ids = _restored(entries.as_py())
                raw = np.frombuffer(zlib.decompress(opened.as_py()), dtype=np.uint8)
                at = np.flatnonzero(np.unpackbits(raw, count=len(ids)))
                bits, old = (size - 1) * width, size - 1
                keys, _, place = qf.tallied(_windows(ids, at, old, width))
                part = qf.parts(keys, bits, min(part_bits, qf.widths(bits)[0]))
                frequent = np.zeros(len(part), dtype=bool)
                for mark in marks.as_py():
                    first, stop = np.searchsorted(part, [mark["part"], mark["part"] + 1])
                    flags = np.frombuffer(zlib.decompress(mark["marks"]), dtype=np.uint8)
                    frequent[first:stop] = np.unpackbits(flags, count=stop - first)
                alive = np.zeros(len(ids), dtype=bool)
                alive[at] = frequent[place]
                begins = alive.copy()
                begins[:-1] &= alive[1:]
                begins[-1:] = False
                yield from _counted(shard.as_py(), *_trimmed(ids, alive, old, begins), size, width, part_bits)

    return run


def _merge(size: int, width: int, part_bits: int, least: int):
    """Merges the filters of one part: its frequent phrases, and for each shard the marks of its entries."""
    schema, bits = to_arrow_schema(_MERGED), size * width
    part_bits = min(part_bits, qf.widths(bits)[0])

    def run(group: pa.Table) -> pa.Table:
        shards, part = group.column("shard").to_pylist(), group.column("part")[0].as_py()
        filters = [qf.loaded(x.as_py(), part, bits, part_bits) for x in group.column("entries")]
        keys = [np.concatenate([f[0][i] for f in filters]) for i in range(len(qf.widths(bits)))]
        keys, total, place = qf.tallied(keys, np.concatenate([f[1] for f in filters]))
        frequent = total >= least
        flags = frequent[place]
        found = np.flatnonzero(frequent)
        ids = np.stack(qf.unpack(qf.restored([k[found] for k in keys], bits), width, size), axis=1).astype(np.int32)
        phrases = pa.ListArray.from_arrays(
            pa.array(np.arange(len(found) + 1, dtype=np.int32) * size), pa.array(ids.ravel()))
        marked, stop = [], 0
        for shard, (_, counts) in zip(shards, filters, strict=True):
            own = flags[stop : stop + len(counts)]
            stop += len(counts)
            if own.any():
                marked.append((shard, zlib.compress(np.packbits(own).tobytes(), 1)))
        n, m = len(found), len(marked)
        return pa.table([
            pa.array([None] * n + [s for s, _ in marked], pa.int64()), pa.array([part] * (n + m), pa.int64()),
            pa.array([None] * n + [x for _, x in marked], pa.binary()),
            pa.concat_arrays([phrases, pa.nulls(m, phrases.type)]),
            pa.concat_arrays([pa.array(total[found], pa.int64()), pa.nulls(m, pa.int64())])], schema=schema)

    return run


def _counts(docs: DataFrame, text_col: str, lang_col: str, longest: int, least: int,
            ) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Frequent words (``lang, word, id, f``), words per language (``lang, n``), frequent phrases (``ids, f``)."""
    shards = save(_shards(docs, text_col, lang_col), "shards")
    spoken = shards.select(F.explode(F.arrays_zip("langs", "words", "counts")).alias("w")).select("w.*")
    per_lang = save(spoken.groupBy(F.col("langs").alias("lang")).agg(F.sum("counts").alias("n")), "langs")
    often = spoken.groupBy(F.col("langs").alias("lang"), F.col("words").alias("word")).agg(F.sum("counts").alias("f"))
    words = assign_surrogate(often.filter(F.col("f") >= least), "id", ["lang", "word"])
    frequent, n_words = words.rows, words.total
    if not n_words or longest < 2:
        return frequent, per_lang, None
    # A language's number of words is one row, so this sum is a small job.
    n_total = per_lang.agg(F.sum("n")).first()[0]
    width, part_bits = n_words.bit_length(), max(0, int(n_total // PART_WORDS).bit_length())

    size = frequent.agg(F.sum(F.octet_length("word") + F.octet_length("lang"))).first()[0]
    if n_words <= BROADCAST_WORDS and size <= BROADCAST_BYTES:
        known = frequent.select("lang", "word", "id").toArrow().combine_chunks()
        hashes = _word_hashes(known.column("word").combine_chunks(), known.column("lang").combine_chunks())
        order = np.argsort(hashes)
        dictionary = docs.sparkSession.sparkContext.broadcast((hashes[order], known.column("id").to_numpy()[order]))
        state = shards.select("shard", "langs", "words", "codes")
    else:
        own = shards.select("shard", F.posexplode(F.arrays_zip("langs", "words")).alias("code", "w"))
        same = (F.col("w.langs") == F.col("lang")) & (F.col("w.words") == F.col("word"))
        known = own.join(frequent, same).groupBy("shard").agg(F.collect_list(F.struct("code", "id")).alias("known"))
        state, dictionary = shards.select("shard", "codes", F.size("words").alias("n")).join(known, "shard"), None
    step = save(state.mapInArrow(_first_step(width, part_bits, dictionary), _STEP), "phrases")
    found = []
    for size in range(2, longest + 1):
        filters = step.filter("part >= 0").select("shard", "part", "entries").groupBy("part")
        merged, n_merged = save_counted(
            filters.applyInArrow(_merge(size, width, part_bits, least), _MERGED), "merged")
        found.append(merged.filter("ids IS NOT NULL").select("ids", "f"))
        if not n_merged or size == longest:
            break
        marks = merged.filter("marks IS NOT NULL").groupBy("shard").agg(
            F.collect_list(F.struct("part", "marks")).alias("marks"))
        if merged.agg(F.sum(F.octet_length("marks"))).first()[0] <= BROADCAST_BYTES:
            marks = F.broadcast(marks)
        state = step.filter("part < 0").select("shard", "entries", "open").join(marks, "shard")
        step = save(state.mapInArrow(_next_step(size + 1, width, part_bits), _STEP), "phrases")
    return frequent, per_lang, reduce(DataFrame.unionByName, found)


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, longest: int = LONGEST, least: int = LEAST,
    top: int = TOP, percent: int = PERCENT,
) -> DataFrame:
    """The ``top`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a``, ``l`` and ``r`` are the numbers of the phrase and of both sides of its weakest cut, ``n`` that of all words.
    """
    words, per_lang, phrases = _counts(docs, text_col, lang_col, longest, least)
    if phrases is None:
        empty = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        return docs.sparkSession.createDataFrame([], empty)
    words = save(words.withColumn("id", F.col("id").cast("int")), "words")
    known = phrases.unionByName(words.select(F.array("id").alias("ids"), "f"))
    inner = F.size("ids") - 1
    longer = phrases.filter(inner > 1).select(
        F.explode(F.array(F.slice("ids", F.lit(1), inner), F.slice("ids", F.lit(2), inner))).alias("ids"),
        F.col("f").alias("longer")).groupBy("ids").agg(F.max("longer").alias("longer"))
    kept = phrases.join(longer, "ids", "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("f")))
    cuts = kept.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", F.lit(1), F.col("k")).alias("head"),
                       F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail"))
    first = words.select(F.col("id").alias("_first"), "lang")
    sides = (
        cuts.join(known.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head")
        .join(known.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
        .join(first, F.col("ids")[0] == F.col("_first")).join(per_lang, "lang")
    )
    exact = "1000 * CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0))"
    score = F.expr(f"({exact}) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    scored = sides.withColumn("score", score).groupBy("lang", "ids", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "ids", "a", "n", "cut.*")
    # Ties of score and count are kept until their phrases are spelled out.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    likely = save(scored.withColumn("place", F.rank().over(order)).filter(F.col("place") <= top), "likely")
    spelled = (
        likely.select("ids", F.posexplode("ids").alias("pos", "id")).join(words.select("id", "word"), "id")
        .groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("spoken"))
        .select("ids", F.array_join("spoken.word", " ").alias("phrase")))
    ranked = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return likely.join(spelled, "ids").withColumn("rank", F.row_number().over(ranked).cast("long")).filter(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

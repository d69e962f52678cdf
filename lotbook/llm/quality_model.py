"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

``score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)``. The pairwise part is computed in time linear in
the features present by ``1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``.

Inputs of a score are the text alone and the metadata columns named by the caller. The model is fitted on a sample of
at most ``max_rows`` labelled documents, those whose ids hash lowest; one vector of at most ``2**hash_bits`` words per
document reaches the driver. Every document is scored on its whole text.

Defined cases: a null text is an empty one; empty texts and texts without words are scored from their statistics; null
metadata is 0; without labelled rows, or with one class only, the model is its bias alone (0.5 without rows); repeated
rows get equal scores; a label row with a null id or label takes no part; input columns named like a result give way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.llm.text_arrays import HASH_BITS as WORD_BITS
from lotbook.llm.text_arrays import LOWER, Texts, distinct, numbered, sliced, windows

HASH_BITS = 14
RANK = 8
MAX_ROWS = 4_000
STATISTICS = (
    "symbols", "digits", "capitals", "exclamations", "lone_marks", "repeated_neighbours", "distinct_words",
    "repeated_lines", "repeated_windows", "word_length", "length", "short", "accented",
)
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>{}[]\\^~=_+@"))
_DIGIT = np.isin(np.arange(256), list(b"0123456789"))
_UPPER = np.isin(np.arange(256), list(range(65, 91)))
_LETTER = _UPPER | np.isin(np.arange(256), list(range(97, 123)))
_STEP = np.array([3.0])


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # one per hashed word, then per statistic, then per metadata column
    factors: np.ndarray  # (features, rank)
    hash_bits: int
    metadata: tuple[str, ...]

    def raw(self, rows: np.ndarray, features: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """The linear score of ``n`` documents from their (row, feature, value) triples, rows ascending."""
        scaled = self.factors[features] * values[:, None]
        total = np.zeros((n, self.factors.shape[1]))
        square = np.zeros_like(total)
        linear = np.zeros(n)
        if len(rows):
            heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
            total[rows[heads]] = np.add.reduceat(scaled, heads)
            square[rows[heads]] = np.add.reduceat(scaled * scaled, heads)
            linear[rows[heads]] = np.add.reduceat(self.weights[features] * values, heads)
        return self.bias + linear + 0.5 * (total * total - square).sum(axis=1)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def statistics(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The statistics of each text in [0, 1], and its distinct words: row, word hash, count."""
    n = len(texts)
    spans = texts.words()
    hashes = spans.hashes(11, LOWER)
    words = spans.counts().astype(float)
    some = np.maximum(words, 1)
    size = np.maximum(np.diff(texts.offsets), 1)
    row, word, count = distinct(spans.owner, hashes)
    kinds = np.bincount(row, minlength=n)
    same = (hashes[1:] == hashes[:-1]) & (spans.owner[1:] == spans.owner[:-1])
    neighbours = np.bincount(spans.owner[1:][same], minlength=n)
    single = (spans.ends - spans.starts == 1)
    marks = single & ~_LETTER[texts.data[spans.starts]] & ~_DIGIT[texts.data[spans.starts]]
    lone = np.bincount(spans.owner[marks], minlength=n)
    lines = texts.lines()
    line_row, _, line_count = distinct(lines.owner, lines.hashes(12))
    line_total = np.maximum(np.bincount(line_row, weights=line_count, minlength=n), 1)
    line_kinds = np.bincount(line_row, minlength=n)
    shingle, first = windows(hashes, spans.owner, 3, 13)
    shingle_row, _, shingle_count = distinct(spans.owner[first], shingle)
    shingle_total = np.maximum(np.bincount(shingle_row, weights=shingle_count, minlength=n), 1)
    shingle_kinds = np.bincount(shingle_row, minlength=n)
    letters = np.maximum(texts.count(_LETTER), 1)
    high = np.arange(256) >= 128
    bang = np.arange(256) == ord("!")
    columns = [
        texts.count(_SYMBOL) / some, texts.count(_DIGIT) / size, texts.count(_UPPER) / letters,
        texts.count(bang) / some, lone / some, neighbours / some, kinds / some,
        1 - line_kinds / line_total, (shingle_total - shingle_kinds) / shingle_total,
        (spans_bytes(spans, n) / some) / 20, np.log1p(words) / 12, (words < 10).astype(float),
        texts.count(high) / size,
    ]
    return np.clip(np.stack(columns, axis=1), 0, 1), row, word, count, words


def spans_bytes(spans, n: int) -> np.ndarray:
    return np.bincount(spans.owner, weights=spans.ends - spans.starts, minlength=n)


def features(texts: Texts, metadata: np.ndarray, hash_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) triples with ascending rows: word counts of unit length, statistics, metadata."""
    table, row, word, count, _ = statistics(texts)
    n = len(texts)
    bucket = (word >> np.uint64(WORD_BITS - hash_bits)).astype(np.int64)
    row, bucket, count = _merged(row, bucket, count.astype(float), hash_bits)
    length = np.sqrt(np.bincount(row, weights=count * count, minlength=n))
    table = np.concatenate([_STEP * table, metadata], axis=1)
    width = table.shape[1]
    rows = np.concatenate([row, np.repeat(np.arange(n), width)])
    ids = np.concatenate([bucket, np.tile(np.arange(width) + (1 << hash_bits), n)])
    values = np.concatenate([count / np.maximum(length[row], 1e-12), table.ravel()])
    order = np.argsort(rows, kind="stable")
    return rows[order], ids[order], values[order]


def _merged(row, bucket, count, hash_bits):
    """Counts of words that share a bucket added up."""
    key = (row.astype(np.int64) << hash_bits) | bucket
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    if not len(key):
        return row, bucket, count
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[heads] >> hash_bits, key[heads] & ((1 << hash_bits) - 1), np.add.reduceat(count, heads)


def _metadata_column(df: DataFrame, names: Sequence[str]) -> Column:
    """Metadata on a log scale in about [0, 1], null as 0."""
    return F.array(*[F.coalesce(F.log1p(F.greatest(F.col(c).cast("double"), F.lit(0.0))) / 12, F.lit(0.0))
                     for c in names]).cast("array<double>")


def _matrix(lists: pa.Array, n: int, width: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, width) if width else np.zeros((n, 0))


def _with_metadata(df: DataFrame, id_col: str, text_col: str, metadata: Sequence[str]) -> DataFrame:
    """One struct column of text and metadata, so that input columns of any name stay apart."""
    return df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"),
                     _metadata_column(df, metadata).alias("_meta"))


def training_rows(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    metadata: Sequence[str] = (), max_rows: int = MAX_ROWS, hash_bits: int = HASH_BITS,
):
    """Features and labels of the sample, in the order of the ids' hashes."""
    usable = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    sample = (
        usable.select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).cast("int").alias("_label"))
        .distinct().orderBy(F.xxhash64("_id"), "_id", "_label").limit(max_rows)
    )
    # At most max_rows pairs of a number and a flag.
    found = _with_metadata(docs, id_col, text_col, metadata).join(F.broadcast(sample), "_id")
    width = len(metadata)

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "_text"):
                n = part.num_rows
                rows, ids, values = features(Texts(part.column("_text")), _matrix(part.column("_meta"), n, width),
                                             hash_bits)
                bounds = pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_label"),
                     pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32))),
                     pa.ListArray.from_arrays(bounds, pa.array(values.astype(np.float32)))],
                    names=["_id", "_label", "_ids", "_values"])

    schema = T.StructType([found.schema["_id"], T.StructField("_label", T.IntegerType()),
                           T.StructField("_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("_values", T.ArrayType(T.FloatType()))])
    rows = (
        found.mapInArrow(run, schema)
        .orderBy(F.xxhash64("_id"), "_id", "_label", "_ids", "_values").limit(max_rows)
    ).toArrow()
    ids, values = rows.column("_ids").combine_chunks(), rows.column("_values").combine_chunks()
    sizes = np.diff(ids.offsets.to_numpy()) if len(rows) else np.zeros(0, dtype=np.int64)
    return (np.asarray(ids.flatten()), np.asarray(values.flatten()).astype(float), sizes,
            rows.column("_label").to_numpy().astype(float))


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    metadata: Sequence[str] = (), max_rows: int = MAX_ROWS, hash_bits: int = HASH_BITS, rank: int = RANK,
    epochs: int = 6, rate: float = 0.1, l2: float = 1e-5, seed: int = 1,
) -> Model:
    """AdaGrad on the logistic loss, one mini-batch after another in a fixed order."""
    ids, values, sizes, label = training_rows(
        docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, metadata=metadata, max_rows=max_rows,
        hash_bits=hash_bits)
    n_features = (1 << hash_bits) + len(STATISTICS) + len(metadata)
    draw = np.random.default_rng(seed)
    weights, factors = np.zeros(n_features), draw.normal(0, 0.05, (n_features, rank))
    n = len(label)
    if not n:
        return Model(0.0, weights, np.zeros_like(factors), hash_bits, tuple(metadata))
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    if label.min() == label.max():
        return Model(bias, weights, np.zeros_like(factors), hash_bits, tuple(metadata))
    g_bias, g_weights, g_factors = 1e-8, np.full(n_features, 1e-8), np.full((n_features, rank), 1e-8)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    for _ in range(epochs):
        order = draw.permutation(n)
        for at in range(0, n, 32):
            chosen = order[at : at + 32]
            where = np.concatenate([np.arange(begins[i], begins[i + 1]) for i in chosen])
            row = np.repeat(np.arange(len(chosen)), sizes[chosen])
            f, x = ids[where], values[where]
            part = factors[f] * x[:, None]
            total = np.zeros((len(chosen), rank))
            np.add.at(total, row, part)
            square = np.zeros_like(total)
            np.add.at(square, row, part * part)
            raw = bias + np.bincount(row, weights=weights[f] * x, minlength=len(chosen)) \
                + 0.5 * (total * total - square).sum(axis=1)
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[chosen]
            step = error[row] * x
            touched, inverse = np.unique(f, return_inverse=True)
            d_weights = np.bincount(inverse, weights=step, minlength=len(touched)) + l2 * weights[touched]
            d_factors = np.zeros((len(touched), rank))
            np.add.at(d_factors, inverse, step[:, None] * (total[row] - part))
            d_factors += l2 * factors[touched]
            g_weights[touched] += d_weights**2
            g_factors[touched] += d_factors**2
            g_bias += error.sum() ** 2
            weights[touched] -= rate * d_weights / np.sqrt(g_weights[touched])
            factors[touched] -= rate * d_factors / np.sqrt(g_factors[touched])
            bias -= rate * error.sum() / np.sqrt(g_bias)
    return Model(float(bias), weights, factors, hash_bits, tuple(metadata))


def score(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score",
          keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``score_col`` in [0, 1], higher for better texts. The model is broadcast; its size is fixed by its bits."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    width = len(model.metadata)
    keep = docs.columns if keep is None else list(keep)
    kept = [c for c in keep if c.lower() != score_col.lower()]
    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField(score_col, T.DoubleType())])

    def run(batches):
        machine = shared.value
        for batch in batches:
            for part in sliced(batch, "text"):
                n = part.num_rows
                rows, ids, values = features(Texts(part.column("text")), _matrix(part.column("meta"), n, width),
                                             machine.hash_bits)
                raw = machine.raw(rows, ids, values, n)
                chance = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(chance)], names=schema.names)

    return docs.select(
        *numbered(kept), F.col(text_col).cast("string").alias("text"),
        _metadata_column(docs, model.metadata).alias("meta")).mapInArrow(run, schema)

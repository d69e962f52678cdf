"""Quality rules: repetition limits, and a log-likelihood ratio of hashed n-grams between trusted and raw texts.

The n-grams of a text are its byte trigrams, with any white space as a space, and for each word but the first whether
it repeats the word before. They are hashed to ``2**GRAM_BITS`` buckets. Two multinomials are counted, one over the
trusted documents and one over all documents; the trusted one is smoothed towards the raw one by ``PRIOR`` n-grams. A
text's score is the mean of ``log(trusted / raw)`` over its n-grams, each limited to ``LIMIT``, and it is kept if the
score reaches a fixed threshold. No random choice is made: equal texts get equal verdicts.

Raw counts cover every n-gram of every document, trusted counts every n-gram of every trusted one. Trusted ids are
broadcast if they are few, by count and by bytes; else the documents that a Bloom filter lets through are joined with
them. Each task adds up its own counts, so what is shuffled and what reaches the driver is bounded by the
buckets; the table of ratios is broadcast at that fixed size.

Defined cases: null and empty texts have no words and fail the base rule; texts shorter than an n-gram score 0;
without trusted documents every score is 0 and only the base rule decides; repeated rows get equal results; an empty
table gives an empty result; input columns named like a result give way.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.llm import bloom
from lotbook.llm.text_arrays import HASH_BITS, IS_SPACE, OWNER_BITS, Spans, Texts, distinct, per_text, sliced, windows
from lotbook.sources.scratch import save_counted

GRAM_BITS = 16
PRIOR = 100_000.0
LIMIT = 4.0
THRESHOLD = -0.1
BROADCAST_IDS = 1_000_000
BROADCAST_BYTES = 16 << 20  # of the ids as text
WINDOW = 5
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_FOLD = np.where(IS_SPACE, 32, np.arange(256)).astype(np.uint32)
_BUCKETS = (1 << GRAM_BITS) + 2  # the last two: a word repeats the one before, or differs


def grams(texts: Texts, words: Spans, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram, texts ascending within each of the two kinds of n-grams."""
    folded = _FOLD[texts.data]
    n = max(len(folded) - 2, 0)
    code = (folded[:n] << np.uint32(16)) | (folded[1 : n + 1] << np.uint32(8)) | folded[2 : n + 2]
    bucket = ((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - GRAM_BITS)).astype(np.int32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(texts.offsets))
    inside = owner[:n] == owner[2:] if n else np.zeros(0, dtype=bool)
    together = words.owner[1:] == words.owner[:-1]
    same = (hashes[1:] == hashes[:-1])[together]
    return (np.concatenate([owner[:n][inside], words.owner[1:][together].astype(np.int32)]),
            np.concatenate([bucket[inside], np.where(same, _BUCKETS - 2, _BUCKETS - 1).astype(np.int32)]))


def base_counts(texts: Texts, words: Spans, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The counts behind the base rule."""
    n = len(texts)
    n_words = words.counts()
    bytes_in_words = np.diff(np.searchsorted(np.flatnonzero(~IS_SPACE[texts.data] & ((texts.data & 0xC0) != 0x80)),
                                             texts.offsets))
    lines = texts.lines()
    filled = np.searchsorted(words.starts, lines.starts) < np.searchsorted(words.starts, lines.ends)
    owner, _, count = distinct(lines.owner[filled], lines.hashes(7)[filled])
    n_dup_lines = np.bincount(owner, weights=count - 1, minlength=n).astype(np.int64)

    found, first = windows(hashes, words.owner, WINDOW, 8)
    owner = words.owner[first].astype(np.uint64)
    key = (owner << np.uint64(HASH_BITS)) | (found >> np.uint64(OWNER_BITS))
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    if len(twice):
        twice = np.unique(twice)
        at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
        again = first[twice[at] == key]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + WINDOW, -1)
    inside = np.cumsum(covered)[:-1] > 0
    n_repeat_words = np.bincount(words.owner[inside], minlength=n)
    return {"n_words": n_words, "word_chars": bytes_in_words, "n_symbols": texts.count(_SYMBOL),
            "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words}


def _marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``_text`` of every document with whether it counts as ``_raw`` and as ``_trusted``."""
    ids, n = save_counted(trusted.filter("_id IS NOT NULL").distinct(), "trusted")
    size = ids.agg(F.sum(F.octet_length(F.col("_id").cast("string")))).first()[0] or 0
    if n <= BROADCAST_IDS and size <= BROADCAST_BYTES:
        known = F.broadcast(ids.withColumn("_trusted", F.lit(True)))
        return docs.join(known, "_id", "left").select(
            "_text", F.lit(True).alias("_raw"), F.coalesce("_trusted", F.lit(False)).alias("_trusted"))
    likely = bloom.marked(docs, "_id", bloom.build(ids, "_id", n), "_hit").filter("_hit")
    good = likely.join(ids, "_id", "left_semi").select(
        "_text", F.lit(False).alias("_raw"), F.lit(True).alias("_trusted"))
    return docs.select("_text", F.lit(True).alias("_raw"), F.lit(False).alias("_trusted")).unionByName(good)


def gram_counts(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts per bucket over all documents and over the trusted ones."""
    flagged = _marked(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")),
                      trusted.select(F.col(id_col).alias("_id")))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("bucket", "raw", "good")])

    def run(batches):
        raw, good = np.zeros(_BUCKETS, dtype=np.int64), np.zeros(_BUCKETS, dtype=np.int64)
        for batch in batches:
            for part in sliced(batch, "_text"):
                texts = Texts(part.column("_text"))
                words = texts.words()
                owner, bucket = grams(texts, words, words.hashes(6))
                for total, name in ((raw, "_raw"), (good, "_trusted")):
                    counted = part.column(name).to_numpy(zero_copy_only=False)
                    total += np.bincount(bucket[counted[owner]], minlength=_BUCKETS)
        at = np.flatnonzero(raw + good)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(good[at])], names=schema.names)

    rows = flagged.mapInArrow(run, schema).groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("good").alias("good")).toPandas()
    raw, good = np.zeros(_BUCKETS), np.zeros(_BUCKETS)
    raw[rows["bucket"]], good[rows["bucket"]] = rows["raw"], rows["good"]
    return raw, good


def log_ratios(raw: np.ndarray, good: np.ndarray, prior: float = PRIOR, limit: float = LIMIT) -> np.ndarray:
    """``log(trusted / raw)`` per bucket; 0 everywhere without trusted n-grams."""
    if not raw.sum() or not good.sum():
        return np.zeros(len(raw))
    q = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
    p = (good + prior * q) / (good.sum() + prior)
    return np.clip(np.log(p / q), -limit, limit)


def apply_rules(
    docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    keep: Sequence[str] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """Adds the base counts, ``score``, ``base_failed`` and ``kept``; ``trusted`` has the trusted documents' ids."""
    ratios = log_ratios(*gram_counts(docs, trusted, id_col, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    fields = [*[T.StructField(c, T.LongType()) for c in counts], T.StructField("score", T.DoubleType()),
              T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]

    def compute():
        ratio = shared.value

        def work(column):
            texts = Texts(column)
            words = texts.words()
            hashes = words.hashes(6)
            found = base_counts(texts, words, hashes)
            owner, bucket = grams(texts, words, hashes)
            total = np.bincount(owner, weights=ratio[bucket], minlength=len(texts))
            score = total / np.maximum(np.bincount(owner, minlength=len(texts)), 1)
            failed = (found["n_words"] < 10) | (100 * found["n_repeat_words"] > 20 * found["n_words"])
            return [*[found[c] for c in counts], score, failed, ~failed & (score >= threshold)]

        return work

    return per_text(docs, text_col, fields, compute, docs.columns if keep is None else keep)

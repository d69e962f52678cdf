"""The quality rules and the quality classifier."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotbook.llm import quality_model, quality_rules
from lotbook.llm.text_arrays import Texts
from tests.llm.fixtures import by_id, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [None, "", " \n\t", "a", "#", "ab cd", "x " * 40, "l\nl\n l\nl\n\n\n", "tab\tand\vand\f", "a b c d e f a b c d e",
           "a b c d e a b c d e a b c d", "é ü ß " * 12 + "#*$%&|<>", "one line\r\none line\r\none line", "🙂 " * 11]


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": lines, "n_repeat_words": len(covered)}


def junk(draw, n):
    return " ".join(w + draw.choice(["***", "$$$", "&&&"]) for w in prose(draw, n).split())


@pytest.fixture(scope="module")
def corpus():
    """(doc_id, text, source) with junk at every fifth id, and the labels of the first three hundred."""
    draw = random.Random(8)
    rows = [(i, junk(draw, draw.randint(12, 150)) if i % 5 == 0 else prose(draw, draw.randint(12, 150)), "s")
            for i in range(450)]
    return rows, [(i, int(i % 5 != 0), 0) for i in range(300)]


def test_base_counts_equal_brute_force(spark):
    draw = random.Random(9)
    texts = AWKWARD + ["\n".join(draw.choice(["ba be bi", "do du", "", " "]) for _ in range(30)) for _ in range(30)]
    frame = documents(spark, [(i, t, "s") for i, t in enumerate(texts)], extra=("n_words", "kept", "_text", "score"))
    none = spark.createDataFrame([], "doc_id long")
    found = by_id(quality_rules.apply_rules(frame, none))
    for i, text in enumerate(texts):
        wanted = brute_counts(text)
        assert {c: found[i][c] for c in wanted} == wanted
        failed = wanted["n_words"] < 10 or 100 * wanted["n_repeat_words"] > 20 * wanted["n_words"]
        assert (found[i]["base_failed"], found[i]["kept"]) == (failed, not failed)


def test_ratio_keeps_clean_texts_and_drops_junk(spark, corpus):
    rows, labels = corpus
    trusted = spark.createDataFrame([(i,) for i, q, _ in labels if q] + [(None,), (10**9,)], "doc_id long")
    found = by_id(quality_rules.apply_rules(documents(spark, rows), trusted))
    for i, _, _ in rows:
        assert found[i]["kept"] == (i % 5 != 0 and not found[i]["base_failed"])


def test_scores_are_mean_log_ratios_of_exact_counts(spark, corpus):
    rows, labels = corpus
    rows = rows[:60]
    trusted = {i for i, q, _ in labels if q}

    def grams(text):
        data = re.sub(r"[\x09-\x0D]", " ", text).encode()
        words = WORD.findall(text)
        trigrams = Counter(((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 0x9E3779B1 % 2**32) >> 16
                           for i in range(len(data) - 2))
        trigrams[1 << 16] = sum(a == b for a, b in zip(words, words[1:], strict=False))
        trigrams[(1 << 16) + 1] = max(len(words) - 1, 0) - trigrams[1 << 16]
        return trigrams

    raw, good = np.zeros((1 << 16) + 2), np.zeros((1 << 16) + 2)
    for i, text, _ in rows:
        for bucket, n in grams(text).items():
            raw[bucket] += n
            good[bucket] += n * (i in trusted)
    ratio = quality_rules.log_ratios(raw, good)
    frame = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    found = by_id(quality_rules.apply_rules(documents(spark, rows), frame))
    for i, text, _ in rows:
        own = grams(text)
        assert found[i]["score"] == pytest.approx(
            sum(n * ratio[b] for b, n in own.items()) / sum(own.values()), abs=1e-9)


def test_pairwise_part_is_linear_time_identity():
    draw = np.random.default_rng(2)
    model = quality_model.Model(0.3, draw.normal(size=20), draw.normal(size=(20, 4)), 4, ())
    ids, values = np.array([1, 5, 7, 19]), draw.normal(size=4)
    pairs = sum(model.factors[ids[a]] @ model.factors[ids[b]] * values[a] * values[b]
                for a in range(4) for b in range(a + 1, 4))
    wanted = 0.3 + model.weights[ids] @ values + pairs
    assert model.raw(np.zeros(4, dtype=int), ids, values, 1)[0] == pytest.approx(wanted)
    assert model.raw(np.zeros(0, dtype=int), ids[:0], values[:0], 2).tolist() == [0.3, 0.3]


def test_classifier_on_labels_it_has_not_seen(spark, corpus):
    rows, labels = corpus
    docs = documents(spark, rows + [(9000, None, None), (9001, "", "s"), (9001, "", "s")], extra=("score", "_input"))
    table = spark.createDataFrame([*labels, (None, 1, 0), (1, None, 0), (10**9, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_model.fit(docs, table, metadata=("n_chars",))
    scored = quality_model.score(docs, model).withColumn("held_out", quality_model.held_out(F.col("doc_id"))).collect()
    assert len(scored) == len(rows) + 3 and all(0 <= r["score"] <= 1 for r in scored)
    for row in scored:
        if row["doc_id"] < 450:
            assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1)
            assert (row["score"] >= 0.5) == (row["doc_id"] % 5 != 0)
    again = quality_model.fit(docs.repartition(5), table, metadata=("n_chars",))
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias


def test_classifier_without_labels_or_documents(spark, corpus):
    rows, _ = corpus
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = documents(spark, rows[:5])
    model = quality_model.fit(docs, none)
    assert {r["score"] for r in quality_model.score(docs, model).collect()} == {0.5}
    assert quality_model.score(documents(spark, []), model).collect() == []


def test_words_and_lines_of_sliced_texts():
    import pyarrow as pa

    texts = Texts(pa.array([None, "a b", "", "c", " d\n\ne "]).slice(1))
    words, lines = texts.words(), texts.lines()
    assert words.counts().tolist() == [2, 0, 1, 2] and lines.counts().tolist() == [1, 1, 1, 3]
    assert [bytes(texts.data[s:e]) for s, e in zip(words.starts, words.ends, strict=True)] == [b"a", b"b", b"c", b"d", b"e"]
    long = Texts(pa.array(["x" * (3 << 20) + " y", "x" * (3 << 20)]))
    hashes = long.words().hashes(1)
    assert hashes[0] == hashes[2] != hashes[1]

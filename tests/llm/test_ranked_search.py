"""Block-Max MaxScore against the score worked out for every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from lotbook.llm import ranked_search as rs
from tests.llm.fixtures import documents, prose


def spoken(text):
    return re.findall(rs.TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(i, Counter(spoken(t))) for i, t in docs]
    n_docs, total = sum(1 for _, c in counted if c), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, counts in counted:
            size = sum(counts.values())
            if size:
                m, score = 50 + 50 * size * n_docs // total, 0
                for term in set(spoken(text)) & set(counts):
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += weight * (10**9 * counts[term] // (1000 * counts[term] + 20 * m))
                if score > 0:
                    scored.append((-score, doc))
        out += [(item, rank, doc, -s) for rank, (s, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k, extra=()):
    frame = documents(spark, [(i, t, "s") for i, t in docs], extra)
    asked = spark.createDataFrame(items, "item_id long, text string")
    rows = rs.rank(frame, asked, k)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def _corpus(seed, n):
    draw = random.Random(seed)
    words = [prose(draw, 1).lower() for _ in range(300)]
    texts = [" ".join(words[int(300 * draw.random() ** 3)] for _ in range(draw.choice([3, 40, 200]))) for _ in range(n)]
    return [(i, t) for i, t in enumerate(texts)], words


@pytest.mark.parametrize(("shard_bytes", "window", "item_block"), [(1 << 24, 4096, 256), (40_000, 64, 3)])
def test_ranks_equal_brute_force(spark, monkeypatch, shard_bytes, window, item_block):
    monkeypatch.setattr(rs, "ITEM_BLOCK", item_block)
    docs, words = _corpus(5, 900)
    draw = random.Random(6)
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([1, 5, 30])))) for i in range(20)]
    # The limits below live in the workers, so they are set through the functions that run there.
    lists = _lists(docs, items, shard_bytes)
    for own, want in lists:
        monkeypatch.setattr(rs, "WINDOW", window)
        got = rs.best(own, len(docs), 10)
        assert list(zip(got[0].tolist(), got[1].tolist(), strict=True)) == want
    assert found(spark, docs, items, 10) == brute(docs, items, 10)


def _lists(docs, items, shard_bytes):
    """Per item its posting lists over one shard, and its ten best documents."""
    counted = [Counter(spoken(t)) for _, t in docs]
    sizes = np.array([sum(c.values()) for c in counted])
    norms = 50 + 50 * sizes * len(docs) // int(sizes.sum())
    df = Counter(t for c in counted for t in c)
    out = []
    for _, text in items:
        own, score = [], np.zeros(len(docs), dtype=np.int64)
        for term in set(spoken(text)) & set(df):
            at = np.array([i for i, c in enumerate(counted) if term in c])
            tf = np.array([counted[i][term] for i in at])
            heads = np.arange(0, len(at), 7)  # short blocks, so that many can be passed over
            ends = np.append(heads[1:], len(at))
            before = np.where(heads == 0, -1, at[heads - 1])
            weight = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[term] + 1)))
            blocks = rs.packed_blocks(at, tf, heads, before).to_pylist()
            own.append(rs._List(
                weight, at[ends - 1], [tf[a:b].max() for a, b in zip(heads, ends, strict=True)],
                [sizes[at[a:b]].min() for a, b in zip(heads, ends, strict=True)], blocks,
                lambda n: 50 + 50 * n * len(docs) // int(sizes.sum()), norms))
            score[at] += weight * (10**9 * tf // (1000 * tf + 20 * norms[at]))
        order = [i for i in np.lexsort((np.arange(len(docs)), -score))[:10] if score[i] > 0]
        out.append((own, [(int(i), int(score[i])) for i in order]))
    return out


def test_blocks_are_passed_over_without_decompression():
    docs, words = _corpus(7, 3000)
    (own, want), = _lists(docs, [(0, " ".join(words[:3] + words[200:204]))], 0)
    got = rs.best(own, len(docs), 10)
    assert got[0].tolist() == [d for d, _ in want]
    assert sum(len(x.opened) for x in own) < sum(len(x.blocks) for x in own)


def test_packed_blocks_round_trip():
    draw = np.random.default_rng(2)
    docs = np.sort(draw.choice(1 << 26, 1000, replace=False))
    counts = draw.choice([1, 3, 300, 70_000, 1 << 25], 1000)
    heads = np.array([0, 128, 256, 400, 999])
    before = np.where(heads == 0, -1, docs[heads - 1])
    blocks = rs.packed_blocks(docs, counts, heads, before).to_pylist()
    for head, stop, block, base in zip(heads, [*heads[1:], 1000], blocks, before, strict=True):
        at, tf = rs.unpacked(block, int(base))
        assert at.tolist() == docs[head:stop].tolist() and tf.tolist() == counts[head:stop].tolist()


def test_defined_cases(spark):
    long = prose(random.Random(2), 30_000)
    docs = [(1, None), (2, ""), (3, "..."), (4, "Same text"), (5, "same TEXT"), (5, "same text"), (6, long), (7, "Ünü_x 5")]
    items = [(0, "same"), (0, "same"), (1, None), (2, "!"), (3, "absent"), (4, "ünü x ÜNÜ"), (5, "Ünü"), (6, long[:200])]
    got = found(spark, docs, items, 50, extra=("shard", "term", "id", "item", "k0"))
    assert got == brute(docs, items, 50)
    assert [r[2:] for r in got if r[0] == 0].count((5, got[0][3])) == 4
    assert found(spark, [], items, 50) == [] and found(spark, docs, [], 50) == []
    assert found(spark, [(1, None), (2, "")], items, 50) == []

"""Exact phrase counts by quotient filters, and collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lotbook.llm import collocations as co
from lotbook.llm import quotient_filter as qf
from tests.llm.fixtures import prose

SCHEMA = "doc_id long, text string, lang string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, top):
    out = []
    for lang in {"und" if r[2] is None else r[2] for r in rows}:
        f, n = Counter(), 0
        for _, text, own in rows:
            if ("und" if own is None else own) == lang:
                for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
                    words = re.findall(r"[^\x20\x09]+", piece)
                    n += len(words)
                    f.update(tuple(words[i : i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in candidates.items():
            inside = any(
                b >= a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
                for h, b in candidates.items() if len(h) > len(g))
            if not inside:
                score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, rank, p.decode(), -a, l, r, n, -s) for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = co.collocations(frame, **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("width", [1, 3, 15, 16, 25, 31])
@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_filters_give_keys_and_counts_back(width, size):
    draw = np.random.default_rng(width * 10 + size)
    bits = width * size
    for part_bits in (0, 4):
        part_bits = min(part_bits, qf.widths(bits)[0])
        ids = [draw.integers(0, 1 << width, 3000) for _ in range(size)]
        keys = qf.permuted(qf.pack(ids, width), bits)
        back = qf.unpack(qf.restored(keys, bits), width, size)
        assert all((a == b).all() for a, b in zip(back, ids, strict=True))
        added = draw.choice([1, 2, 254, 255, 1 << 40], 3000)
        keys, counts, _ = qf.tallied(keys, added)
        assert counts.sum() == added.sum()
        part = qf.parts(keys, bits, part_bits)
        for p in np.unique(part):
            own = part == p
            data = qf.dumped([k[own] for k in keys], counts[own], bits, part_bits)
            limbs, tally = qf.loaded(data, int(p), bits, part_bits)
            assert all((a == b[own]).all() for a, b in zip(limbs, keys, strict=True)) and (tally == counts[own]).all()


def test_equal_keys_and_distinct_keys_stay_apart():
    """Every key of a small width, so the permutation must be one to one."""
    for bits in (1, 2, 7, 12):
        keys = qf.permuted([np.arange(1 << bits, dtype=np.uint64)], bits)[0]
        assert sorted(keys.tolist()) == list(range(1 << bits))


def test_collocations_equal_brute_force(spark):
    draw = random.Random(8)
    words = [prose(draw, 1).lower().strip(".") for _ in range(25)]
    fixed = [" ".join(draw.choice(words) for _ in range(draw.randint(3, 7))) for _ in range(6)]
    rows = []
    for i in range(400):
        parts = [draw.choice(fixed) if draw.random() < 0.4 else draw.choice(words) for _ in range(30)]
        text = "".join(p + draw.choice([" ", "  ", "\t", ", ", ". ", "\n"]) for p in parts)
        rows.append((i, text.title() if i % 3 else text, draw.choice(["aa", "bb", None, "und"])))
    for least in (5, 40):
        assert found(spark, rows, least=least) == brute(rows, least, 2000)
    assert found(spark, rows, least=5, top=7) == brute(rows, 5, 7)


def test_many_parts_and_shards(spark, monkeypatch):
    """One part for every 64 words, and each shard counted apart, must not change a result."""
    draw = random.Random(9)
    rows = [(i, " ".join(draw.choice("abcdefgh") for _ in range(200)), "xx") for i in range(60)]
    monkeypatch.setattr(co, "PART_WORDS", 64)
    assert found(spark, rows, least=10) == brute(rows, 10, 2000)
    monkeypatch.setattr(co, "BROADCAST_WORDS", 0)  # ids come by a shuffled join
    assert found(spark, rows, least=10) == brute(rows, 10, 2000)


def test_defined_cases(spark):
    long = "so on and so on and on " * 5000
    rows = [(1, None, "xx"), (2, "", None), (3, " .,; ", "xx"), (4, long, "xx"), (4, long, "xx"), (5, "a " * 300, ""),
            (6, "Ünï çédé, " * 150, "yy"), (7, "ABC d\x0be abc D " * 120, None), (8, "word", "zz")]
    assert found(spark, rows) == brute(rows, 100, 2000)
    assert found(spark, []) == [] and found(spark, rows[:3]) == []
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS shard", "2 AS ids", "3 AS f", "4 AS word", "5 AS score")
    assert sorted(tuple(r) for r in co.collocations(frame).collect()) == brute(rows, 100, 2000)

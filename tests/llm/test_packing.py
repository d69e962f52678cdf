import random
import zlib

import numpy as np
import pytest

from lotbook.llm import packing
from tests.llm.fixtures import documents, prose


def exact_ids(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


TEXTS = [None, "", " ", "a", "x<|endoftext|>y", "日本語 текст émoji 🙂‍🙂", "\n\n\n   \t", "don't I'LL 1234567",
         "z" * 5000, "word " * 3000, prose(random.Random(1), 2500)]


@pytest.fixture(scope="module")
def table():
    draw = random.Random(2)
    texts = TEXTS + [prose(draw, draw.choice([3, 30, 100, 300, 500])) for _ in range(150)]
    return {i: t for i, t in enumerate(texts)}


def test_pieces_cover_every_document_with_the_tokenizers_ids(spark, table):
    frame = documents(spark, [(i, t, "s") for i, t in table.items()], extra=("piece", "length", "_rank"))
    rows = packing.pack(frame, capacity=512, with_ids=True).collect()
    wanted = dict(zip(table, exact_ids(table.values()), strict=True))
    by_doc = {}
    for row in rows:
        by_doc.setdefault(row["doc_id"], []).append(row)
    assert set(by_doc) == set(table)
    for i, found in by_doc.items():
        found.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(len(found)))
        assert sum([r["ids"] for r in found], []) == wanted[i]
        assert all(r["length"] == 512 for r in found[1:]) and found[0]["length"] <= 512
        for r in found:
            part = wanted[i][r["start"] : r["start"] + r["length"]]
            assert r["ids"] == part and r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())


def test_sequences_are_gapless_full_and_few(spark, table):
    rows = packing.pack(documents(spark, [(i, t, "s") for i, t in table.items()]), capacity=512).collect()
    sequences = {}
    for row in rows:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= 512
    least = -(-sum(r["length"] for r in rows) // 512)
    assert len(sequences) <= 1.05 * least + 1


def test_repeated_rows_and_empty_table(spark):
    rows = packing.pack(documents(spark, [(1, "same", "s")] * 3 + [(None, "same", "s")])).collect()
    assert len(rows) == 4 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 4
    assert packing.pack(documents(spark, [])).collect() == []


def test_plan_places_every_length_once():
    draw = random.Random(4)
    for _ in range(20):
        histogram = {length: draw.randint(1, 40) for length in draw.sample(range(1, 257), draw.randint(1, 120))}
        plan = packing.plan(histogram, capacity=256, grain=8)
        used = {}
        for members, count in plan.runs:
            assert sum(members) <= 256 and count > 0
            for length in members:
                used[length] = used.get(length, 0) + count
        assert used == histogram
        slots = list(plan.slots())
        assert sum(s[2] for s in slots) == sum(histogram.values())


def test_patterns_are_all_triples():
    found = {tuple(sorted(c for c in row if c)) for row in packing.patterns(12)}
    wanted = {(12,)} | {tuple(sorted((a, 12 - a))) for a in range(1, 12)} | {
        tuple(sorted((a, b, 12 - a - b))) for a in range(1, 11) for b in range(1, 12 - a)}
    assert found == wanted


def test_least_squares_meets_the_optimality_conditions():
    draw = np.random.default_rng(3)
    shapes = packing.patterns(16)
    for _ in range(5):
        wanted = draw.integers(0, 50, 16).astype(float)
        x = packing.nonnegative_least_squares(shapes, wanted)
        matrix = np.zeros((17, len(shapes)))
        for place in range(3):
            np.add.at(matrix, (shapes[:, place], np.arange(len(shapes))), 1.0)
        slope = matrix[1:].T @ (wanted - matrix[1:] @ x)
        assert x.min() >= 0 and slope.max() <= 1e-6 * 50 and np.abs(slope[x > 0]).max(initial=0) <= 1e-6 * 50

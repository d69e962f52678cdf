import random
import re

import numpy as np
import pytest

from lotbook.llm.components import components
from lotbook.llm.near_duplicates import near_duplicates, super_minhash
from lotbook.llm.text_arrays import mix
from tests.llm.fixtures import by_id, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < 4:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def brute_force(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in texts}


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    bases = [prose(draw, n) for n in (12, 30, 60, 200, 400)]
    out = {}
    for number in range(160):
        words = draw.choice(bases).split(" ")
        for _ in range(draw.choice([0, 0, 1, 2, 4, 8])):
            words[draw.randrange(len(words))] = prose(draw, 1)
        text = " ".join(words)
        out[number] = text.upper() if number % 7 == 0 else text
    awkward = [None, "", "  \t\n", "one", "ONE", "one two", "one  two", "é é é", "É é é", "a b c d", "a b c d e",
               "the same four words " * 500, "the same four words " * 400]
    return out | {1000 + i: t for i, t in enumerate(awkward)}


def test_components_equal_brute_force(spark, texts):
    frame = documents(spark, [(i, t, "s") for i, t in texts.items()], extra=("component_id", "_class", "set", "_id"))
    found = by_id(near_duplicates(frame))
    wanted = brute_force(texts)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == wanted
    assert all(r["kept"] == (i == wanted[i][1]) for i, r in found.items())


def test_chain_of_many_links_is_one_component(spark):
    words = prose(random.Random(1), 140).split()
    texts = {i: " ".join(words[i : i + 60]) for i in range(0, 80)}
    wanted = brute_force(texts)
    found = by_id(near_duplicates(documents(spark, [(i, t, "s") for i, t in texts.items()])))
    assert {r["component_id"] for r in found.values()} == {i for _, i in wanted.values()} == {0}


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = prose(random.Random(2), 40)
    frame = documents(spark, [(5, text, "s"), (5, text, "s"), (3, text, "s"), (None, text, "s"), (None, None, "s")])
    rows = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(frame).collect()), key=repr)
    assert rows == sorted([(5, 3, False), (5, 3, False), (3, 3, True), (None, 3, True), (None, None, True)], key=repr)
    assert near_duplicates(documents(spark, [])).collect() == []


def test_signatures_estimate_similarity_with_less_variance_than_independent_places():
    draw = np.random.default_rng(1)
    errors = []
    for trial in range(200):
        pool = mix(draw.integers(1, 2**62, 60).astype(np.uint64))
        a, b = pool[:45], pool[15:]
        one = super_minhash(np.zeros(len(a), dtype=np.int64), a, 1, 96)
        two = super_minhash(np.zeros(len(b), dtype=np.int64), b, 1, 96)
        errors.append((one == two).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.01
    assert np.var(errors) < 0.25 / 96  # what independent hashes would have


def test_signature_is_the_minimum_over_each_elements_own_permutation():
    elements = mix(np.arange(1, 8, dtype=np.uint64))
    together = super_minhash(np.zeros(7, dtype=np.int64), elements, 1, 24)[0]
    alone = super_minhash(np.arange(7), elements, 7, 24)
    assert np.array_equal(np.sort(np.floor(alone), axis=1), np.tile(np.arange(24.0), (7, 1)))
    assert np.array_equal(together, alone.min(axis=0))


def test_components_of_stars_chains_and_loops(spark):
    links = [(1, 1), (9, 2), (2, 5), (5, 7), (30, 20), (20, 10), (10, 40), (40, 30), (None, 3), (3, 4)]
    found = {(r["node"], r["root"]) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {(9, 2), (5, 2), (7, 2), (20, 10), (30, 10), (40, 10), (4, 3)}


def _row_groups(rows):
    """Groups of rows by brute force, each with its least id, where rows may share an id."""
    found = brute_force(dict(enumerate(t for _, t in rows)))
    least = {}
    for i, (key, _) in enumerate(rows):
        root = found[i][1]
        least[root] = min(least.get(root, key), key)
    return sorted((key, found[i][0], least[found[i][1]], key == least[found[i][1]]) for i, (key, _) in enumerate(rows))


def test_text_ids_and_shared_ids(spark):
    draw = random.Random(21)
    bases = [prose(draw, 80) for _ in range(12)]
    rows = []
    for i in range(90):
        words = bases[i % 12].split(" ")
        words[draw.randrange(len(words))] = prose(draw, 1)
        rows.append((f"id{draw.randint(0, 45):03d}", " ".join(words)))
    rows += [("x1", bases[0] + " a"), ("x1", bases[1] + " a")]
    frame = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    assert sorted(tuple(r) for r in near_duplicates(frame).collect()) == _row_groups(rows)
    numbers = [(1, bases[0]), (1, bases[1]), (2, bases[0] + " b"), (3, bases[1] + " b")]
    frame = spark.createDataFrame(numbers, "doc_id long, text string")
    assert sorted(tuple(r) for r in near_duplicates(frame).collect()) == _row_groups(numbers)

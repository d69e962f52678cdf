import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotbook.llm import prefix_forest

SCHEMA = "vec_id long, embedding array<float>, label int"


def search(spark, rows, k=20, every=20, **options):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    for name in ("vector", "class_id", "rank"):
        frame = frame.withColumn(name, F.lit("own"))
    out = {}
    for r in prefix_forest.nearest(frame, F.col("vec_id") % every == 0, k, **options).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(i, s) for _, i, s in sorted(found)] for q, found in out.items()}


def brute(rows, k=20, every=20):
    ids = np.array([i for i, _ in rows])
    table = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        scores = table @ table[q]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), scores[j]) for j in order]
    return out


@pytest.fixture(scope="module")
def clustered():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(40, 16))
    table = centres[draw.integers(0, 40, 1500)] + draw.normal(scale=0.2, size=(1500, 16))
    table *= draw.uniform(0.2, 3, (1500, 1))  # lengths differ, so the nearest by angle is not the nearest
    return [(i, [float(x) for x in v]) for i, v in enumerate(table)]


@pytest.mark.parametrize("block_rows", [64, 1024])
def test_recall_and_exact_scores(spark, clustered, block_rows):
    found, wanted = search(spark, clustered, block_rows=block_rows), brute(clustered)
    assert set(found) == set(wanted)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.95 * sum(map(len, wanted.values()))
    exact = {i: np.array(v, dtype=np.float32).astype(float) for i, v in clustered}
    for q, near in found.items():
        assert len(near) == 20 and q not in {i for i, _ in near}
        assert [s for _, s in near] == pytest.approx([exact[i] @ exact[q] for i, _ in near], abs=1e-12)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def test_one_vector_on_a_third_of_the_rows(spark, clustered):
    rows = [(i, clustered[0][1] if i % 3 == 0 else v) for i, v in clustered[:600]]
    found, wanted = search(spark, rows, block_rows=32), brute(rows)
    for q in wanted:
        if q % 3 == 0:
            assert [i for i, _ in found[q]] == [i for i, _ in wanted[q]]


def test_unusable_and_few_vectors(spark):
    bad = [(20, None), (40, []), (60, [0.0, 0.0]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]),
           (120, [None, 1.0]), (140, [1.0, 2.0, 3.0]), (None, [1.0, 0.0])]
    good = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 0.0]), (3, [-1.0, 0.0])]
    assert search(spark, bad + good) == {0: [(1, 2.0), (2, 2.0), (3, -1.0)]}
    assert search(spark, bad[:3]) == {} and search(spark, []) == {} and search(spark, good[1:]) == {}


def test_prefix_lengths():
    a = np.array([0, 1, 2**61, 2**62 - 1, 5 << 40], dtype=np.int64)
    b = np.array([0, 0, 0, 2**62 - 2, 4 << 40], dtype=np.int64)
    assert prefix_forest.common_prefix(a, b).tolist() == [62, 61, 0, 61, 21]


def test_every_dimension_is_searched(spark):
    draw = np.random.default_rng(4)
    flat = [(i, [float(x) for x in draw.normal(size=8)]) for i in range(60)]
    deep = [(i, [float(x) for x in draw.normal(size=5)]) for i in range(60, 200)]
    assert search(spark, flat + deep, k=5) == {
        q: [(i, pytest.approx(s, abs=1e-12)) for i, s in near] for part in (flat, deep) for q, near in brute(part, 5).items()}


def test_many_ties_are_settled_by_id_within_a_bound(spark, monkeypatch):
    """Sparse vectors, of which hundreds are equally near: each block hands on no more than it can need."""
    rows = [(i, [1.0, float(i % 2), *[float(i // 2 == j) for j in range(320)]]) for i in range(640)]
    table = pd.DataFrame({
        "pos": range(640), "vec": [np.array(v).tobytes() for _, v in rows], "class_id": range(640), "key": 0})
    asked = table.head(32).assign(floor=-np.inf, home=0, block=0, blocks=1, tree=0)
    found = prefix_forest._compare(21)(table, asked).dropna(subset=["cand"])
    assert found.groupby("query").size().max() == 21
    near = search(spark, rows)
    assert {q: [i for i, _ in n] for q, n in near.items()} == {q: [i for i, _ in n] for q, n in brute(rows).items()}

import random
import re

import pytest

from lotbook.llm.mixing import mix
from tests.llm.fixtures import by_id, documents, prose

WEIGHTS = (3, 1, 2)


def wanted_targets(sizes):
    """Dealing by weight with the excess dealt again, source by source."""
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, capped = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in capped]
        total = sum(weight[s] for s in rest)
        dealt = {s: left * weight[s] / total for s in rest}
        over = [s for s in rest if dealt[s] > 2 * sizes[s]]
        if not over:
            return dealt | capped
        for s in over:
            capped[s] = 2.0 * sizes[s]
            left -= capped[s]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    out = []
    for i in range(400):
        source = draw.choice(["b", "b", "b", "b", "a", "Z", "é", None, "tiny"]) if i else "tiny"
        out.append((i, prose(draw, draw.choice([1, 3, 3, 20, 80, 300])), source))
    out += [(1000, None, "b"), (1001, "", "a"), (1002, None, "nothing"), (1003, " ", "nothing")]
    return out + [(2000 + i, "all of one size and one source", "b") for i in range(150)]


def test_targets_sizes_and_taken_words(spark, rows):
    found = by_id(mix(documents(spark, rows, extra=("size", "taken", "part", "rate")), WEIGHTS, 1.5))
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    totals = {s: sum(sizes[i] for i in sizes if source[i] == s) for s in set(source.values())}
    targets = wanted_targets({s: n for s, n in totals.items()})
    assert set(found) == set(sizes)
    for i, row in found.items():
        assert (row["size"], row["source_size"]) == (sizes[i], totals[source[i]])
        assert row["target"] == pytest.approx(targets[source[i]], rel=1e-9, abs=1e-9)
        assert row["taken"] == row["copies"] * sizes[i] and 0 <= row["taken"] <= 2 * sizes[i]
    for s, target in targets.items():
        taken = sum(found[i]["taken"] for i in found if source[i] == s)
        assert abs(taken - target) <= max(3, 0.01 * target)


def test_rates_tilt_exponentially_and_meet_the_target(spark, rows):
    import math

    found = by_id(mix(documents(spark, rows), WEIGHTS, 1.5))
    for s in ("b", "Z", None):
        own = [found[i] for i, _, source in rows if source == s and found[i]["size"]]
        assert sum(r["rate"] * r["size"] for r in own) == pytest.approx(own[0]["target"], rel=1e-6)
        lam = {round(math.log(r["rate"]) / r["size"], 9) for r in own if r["rate"] < 2 - 1e-9}
        assert len(lam) <= 1


def test_reruns_agree_whatever_the_partitions(spark, rows):
    def taken(n):
        frame = documents(spark, rows).repartition(n)
        return {i: r["taken"] for i, r in by_id(mix(frame, WEIGHTS, 1.5)).items()}

    assert taken(1) == taken(7)


def test_one_class_is_split_into_whole_copies(spark):
    found = mix(documents(spark, [(i, "two words", "only") for i in range(501)]), (1,), 1.5).collect()
    assert sorted(r["copies"] for r in found) == [1] * 250 + [2] * 251 or sorted(
        r["copies"] for r in found) == [1] * 249 + [2] * 252


def test_empty_and_wordless_tables(spark):
    assert mix(documents(spark, []), WEIGHTS, 1.5).collect() == []
    rows = mix(documents(spark, [(1, None, None), (1, None, None)]), WEIGHTS, 1.5).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in rows] == [(0, 0.0, 0)] * 2

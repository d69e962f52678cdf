import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotbook.sources.scratch import save
from tests.llm.fixtures import documents, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(11)
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels = [], []
    base = prose(draw, 80)
    for i in range(300):
        if i % 6 == 0:
            text = " ".join(w + "$$$" for w in prose(draw, 60).split())
        elif i % 6 == 1:
            text = base + " " + prose(draw, 2)
        else:
            text = prose(draw, draw.randint(20, 120)) + (f" mail ann{i}@example.com" if i % 6 == 2 else "")
        rows.append((i, text, draw.choice(["a", "b", None])))
        labels.append((i, int(i % 6 != 0), 0))
    rows += [(None, prose(draw, 50), "a"), (301, rows[3][1], "b")]
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_each_stage_takes_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.toPandas()
        if name != "packing":
            assert docs.columns == columns
    ids = {name: set(rows["doc_id"].dropna().astype(int)) for name, rows in kept.items()}
    assert ids["quality classifier"] == {i for i in range(300) if i % 6} | {301}
    assert ids["near duplicates"] == {i for i in range(300) if i % 6 > 1} | {1}
    assert kept["near duplicates"]["doc_id"].isna().sum() == 1
    before = kept["near duplicates"].dropna(subset=["doc_id"]).set_index("doc_id")["text"]
    after = kept["personal data"].dropna(subset=["doc_id"]).set_index("doc_id")["text"]
    assert set(before[before != after.reindex(before.index)].index) == {i for i in range(300) if i % 6 == 2}
    assert not after.str.contains("@example", regex=False).all()
    counts = kept["source mix"]["doc_id"].value_counts()
    assert counts.max() == 2 and kept["source mix"]["doc_id"].isna().sum() == 1
    packed = kept["packing"]
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
    assert (packed["piece"] == 0).sum() == len(kept["source mix"])


def test_run_applies_all_stages(spark, folder):
    assert set(corpus_pipeline.run(spark, folder).columns) >= {"doc_id", "piece", "sequence_id", "offset"}


def test_near_duplicates_share_shingles_of_five_words(spark, tmp_path):
    draw = random.Random(12)
    texts = {}
    for group in range(12):
        words = [f"w{group}x{n}" for n in range(40 + 3 * group)]
        for member in range(6):
            changed = list(words)
            for _ in range(member % 3):
                changed[draw.choice([0, 1, 2, 20, 30, -1])] = f"new{group}x{member}"
            texts[100 * group + member] = " ".join(changed)
        texts[100 * group + 50] = " ".join([*words[:20], "inner", *words[21:]])

    def kept(width):
        sets = {}
        for i, text in texts.items():
            words = text.split()
            sets[i] = {tuple(words[n : n + width]) for n in range(len(words) - width + 1)}
        root = {i: i for i in texts}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a in sets:
            for b in sets:
                if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
        return {i for i in texts if find(i) == i}

    assert kept(4) < kept(5) < set(texts)
    docs = documents(spark, [(i, text, "a") for i, text in texts.items()])
    docs.write.parquet(str(tmp_path / "docs"))
    stage = dict(corpus_pipeline.STAGES)["near duplicates"]
    assert {r["doc_id"] for r in stage(spark, spark.read.parquet(str(tmp_path / "docs")), "").collect()} == kept(5)


def test_columns_named_like_helpers_keep_their_values(spark, folder):
    names = ["_row", "_score", "_found", "_copy", "_copies", "_key", "_place", "_pieces", "_news", "row", "k0", "_id"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.select("*", *[F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n)
                              for n in names])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = save(stage(spark, docs, folder), "stage")
        assert docs.columns == columns
        rows = docs.collect()
        assert rows, name
        for row in rows:
            shown = "-" if row["doc_id"] is None else row["doc_id"]
            assert all(row[n] == f"{n} {shown}" for n in names)


def test_rows_that_share_an_id(spark):
    """Texts of one id are documents of their own; repeated rows are one."""
    draw = random.Random(15)
    one, two = prose(draw, 60), prose(draw, 60)
    rows = [(1, one, "a"), (1, two, "a"), (1, two, "a"), (2, one + " more", "a"), (3, two + " more", "a")]
    stages = dict(corpus_pipeline.STAGES)
    left = stages["near duplicates"](spark, documents(spark, rows), "")
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == sorted([(1, one), (1, two)])
    mixed = stages["source mix"](spark, documents(spark, rows), "").collect()
    assert {r["text"] for r in mixed} <= {t for _, t, _ in rows} and 4 <= len(mixed) <= 10

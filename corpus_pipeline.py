"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.llm import mixing, near_duplicates, packing, quality_model, surrogates
from lotbook.llm.queries import SOURCE_WEIGHTS, SURROGATE_KEY, table
from lotbook.sources.scratch import save

SHINGLE_WORDS = 5  # the operator's own query takes four


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed(docs: DataFrame, *told_apart: str) -> tuple[DataFrame, str]:
    """The documents with a key of their id and a hash of the given columns, null for those without an id."""
    key = unused(docs, "_key")
    own = F.struct("doc_id", F.xxhash64(*told_apart))
    return docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), own)), key


def one_of_each(docs: DataFrame, key: str) -> DataFrame:
    """One row of each key, the first by its plain columns."""
    place = unused(docs, "_place")
    plain = [f.name for f in docs.schema if isinstance(f.dataType, T.AtomicType)]
    order = Window.partitionBy(key).orderBy(*[F.col(f"`{c}`") for c in plain])
    return docs.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).drop(place)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rates 0.5 or better."""
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"), metadata=("n_chars",))
    score = unused(docs, "_score")
    scored = quality_model.score(docs, model, score_col=score)
    return scored.filter(F.col(score) >= 0.5).select(*columns(docs))


def near_duplicate_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id; rows without an id stay.

    Rows that share an id but not their text are documents of their own.
    """
    own, key = keyed(docs, "text")
    found = near_duplicates.near_duplicates(own, key, width=SHINGLE_WORDS)
    kept = found.filter(F.col("kept") & F.col(key).isNotNull()).select(key).distinct()
    single = one_of_each(own.join(kept, key, "left_semi"), key).select(*columns(docs))
    return single.unionByName(docs.filter("doc_id IS NULL"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; ``n_chars`` follows the new text."""
    count = unused(docs, "_found")
    done = surrogates.replace_personal_data(docs, SURROGATE_KEY, count_col=count)
    length = F.when(F.col(count) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", length).select(*columns(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows without an id are taken once.

    Rows of equal id, text and source are one document that is taken as often as all of them.
    """
    own, key = keyed(docs, "text", "source")
    copies, copy = unused(docs, "_copies"), unused(docs, "_copy")
    taken = (
        mixing.mix(own, SOURCE_WEIGHTS, share=1.5, cap=2.0, id_col=key).filter(F.col(key).isNotNull())
        .groupBy(key).agg(F.sum("copies").cast("int").alias(copies)).filter(F.col(copies) > 0))
    single = one_of_each(own.join(taken, key), key)
    repeated = single.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return repeated.select(*columns(docs)).unionByName(docs.filter("doc_id IS NULL"))


def columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces packed into sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near duplicates", near_duplicate_removal),
    ("personal data", personal_data),
    ("source mix", source_mix),
    ("packing", sequences),
]

#: Models, sketches and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = save(docs, name.replace(" ", "_"))
    return docs

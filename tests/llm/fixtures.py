"""Small inputs with the awkward cases every operator has to bear."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu ma me mi mo mu na ne ni no nu".split()


def prose(draw: random.Random, n: int) -> str:
    """Made-up words in sentences and lines."""
    out = []
    for i in range(n):
        word = "".join(draw.choice(SYLLABLES) for _ in range(draw.randint(1, 4)))
        out.append(word.capitalize() if i % 9 == 0 else word)
        if i % 9 == 8:
            out[-1] += "."
    return "\n".join(" ".join(out[i : i + 30]) for i in range(0, n, 30))


def documents(spark, rows, extra=()):
    """(doc_id, text, source) rows as a documents table; ``extra`` columns of those names hold a constant."""
    from pyspark.sql import functions as F

    made = [(i, t, "xx", s, None if t is None else len(t)) for i, t, s in rows]
    frame = spark.createDataFrame(made, DOCUMENTS).repartition(3)
    for name in extra:
        frame = frame.withColumn(name, F.lit("own"))
    return frame


def by_id(frame, key="doc_id"):
    return {row[key]: row for row in frame.collect()}

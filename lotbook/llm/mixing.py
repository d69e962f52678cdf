"""Mixing sources to target weights by entropy balancing.

Every source gets a target number of tokens. The rates of its documents are those closest to the base rate 1, in
Kullback-Leibler divergence, for which the expected tokens meet the target and no rate is above ``cap``:

    rate_i = min(cap, exp(lambda_s * size_i / mean_size_s))

The dual has one convex problem in ``lambda_s`` for each source, as the sources' constraints share no document. Newton's
method solves all of them together: each iteration is one grouped sum of gradients and curvatures over the distinct
(source, size) classes, a step per source, and a bracket that a step may not leave. Nothing but the number of open
sources reaches the driver.

Rates become whole copies class by class, from the largest size to the smallest, carrying the rounding error along, so a
source ends within half of its smallest documents' size of the target wherever small documents have room. Inside a
class of equal documents the extra copies go to the rows whose hashes come first. The result depends on rows alone.

Scale: documents are read once into (id, source, size). Classes number at most the distinct sizes of a source, at
most about the square root of twice its tokens; they are all that one task ever gathers for a source. Ranks inside a
class are computed in up to 4,096 parts, so neither a source nor a class sits in one task.

Defined cases: a null text has size 0; rows of size 0 are taken once (0 words); null is a source of its own; repeated
rows are documents of their own; a source without words has target 0; an empty table gives an empty result. Only the id,
text and source columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotbook.operators.surrogate import assign_surrogate
from lotbook.sources.scratch import save, save_counted

WORD = r"[^\x20\x09-\x0D]+"
CLASS_PARTS = 4_096  # a class is ranked in up to so many parts
TOLERANCE = 1e-9
MAX_ITERATIONS = 80


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Adds ``source_id`` (sources by code point, null last), ``weight`` and ``target``.

    ``sources`` has ``source`` and ``source_size``. The budget, ``share`` of all sizes, is dealt by weight; what is above
    ``cap`` times a source's size is dealt again to the others until none is above. Each round is one sum.
    """
    ordered = sources.withColumn("_last", F.col("source").isNull().cast("int")).withColumn(
        "_name", F.coalesce("source", F.lit("")))
    numbered = save(assign_surrogate(ordered, "source_id", ["_last", "_name"], start=0).rows, "sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = numbered.select(
        "source", "source_id", "source_size", F.element_at(cycle, (F.col("source_id") % len(weights) + 1).cast("int"))
        .alias("weight"))
    budget = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        limit = cap * F.col("source_size")
        full = F.col("weight") * F.lit(level) >= limit
        spent, open_weight, most = rows.agg(
            F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
            F.max(limit / F.col("weight"))).first()
        if not open_weight:
            level = most or 0.0
            break
        raised = (budget - spent) / open_weight
        if raised <= level * (1 + 1e-15):
            break
        level = raised
    return rows.withColumn("target", F.least(F.col("weight") * F.lit(level), cap * F.col("source_size")))


def dual_multipliers(classes: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """``source_id, lam``: Newton iterations on the dual of every source at once.

    ``classes`` has ``source_id, size, n`` with positive sizes, ``targets`` has ``source_id, source_size, target`` and
    the number of documents ``n_docs``. Sources at their cap have an infinite multiplier, those without target one of
    minus infinity, and neither takes part.
    """
    x = F.col("size") * F.col("n_docs") / F.col("source_size")  # size over the source's mean size
    at_cap = F.col("target") >= F.lit(cap * (1 - TOLERANCE)) * F.col("source_size")
    state = targets.select(
        "source_id", "source_size", "n_docs", "target",
        F.when(F.col("target") <= 0, F.lit(-math.inf)).when(at_cap, F.lit(math.inf)).otherwise(0.0).alias("lam"),
        F.lit(-math.inf).alias("lo"), F.lit(math.inf).alias("hi"),
        (at_cap | (F.col("target") <= 0)).alias("done"))
    state, _ = save_counted(state, "dual")
    for _ in range(MAX_ITERATIONS):
        moving = state.filter(~F.col("done"))
        tilt = F.exp(F.least(F.col("lam") * x, F.lit(700.0)))
        held = tilt >= cap
        sums = (
            classes.join(moving.select("source_id", "lam", "source_size", "n_docs"), "source_id")
            .groupBy("source_id").agg(
                F.sum(F.col("n") * F.col("size") * F.least(tilt, F.lit(float(cap)))).alias("tokens"),
                F.sum(F.when(held, 0.0).otherwise(F.col("n") * F.col("size") * x * tilt)).alias("slope"))
        )
        gap = F.col("tokens") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap >= 0, F.col("lam")).otherwise(F.col("hi"))
        step = moving.join(sums, "source_id", "left").withColumn("gap", gap).withColumn("lo", lo).withColumn("hi", hi)
        newton = F.when(F.col("slope") > 0, F.col("lam") - F.col("gap") / F.col("slope"))
        inside = newton.isNotNull() & (newton > F.col("lo")) & (newton < F.col("hi"))
        middle = (
            F.when(F.col("lo") == -math.inf, F.col("hi") - 1 - F.abs("hi"))
            .when(F.col("hi") == math.inf, F.col("lo") + 1 + F.abs("lo")).otherwise((F.col("lo") + F.col("hi")) / 2))
        met = F.coalesce(F.abs("gap") <= F.lit(TOLERANCE) * F.col("target"), F.lit(True)) | (
            F.col("hi") - F.col("lo") <= 1e-14 * F.abs("lam"))
        moved = step.select(
            "source_id", "source_size", "n_docs", "target",
            F.when(met, F.col("lam")).when(inside, newton).otherwise(middle).alias("lam"), "lo", "hi",
            met.alias("done"))
        state = save(state.filter("done").unionByName(moved), "dual")
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select("source_id", "lam")


def _copies(classes: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for each class of one source, largest size first, carrying the rounding error."""
    classes = classes.sort_values("size", ascending=False)
    carried, copies = 0.0, []
    for size, n, rate, cap in zip(classes["size"], classes["n"], classes["rate"], classes["cap"], strict=True):
        wanted = n * rate * size + carried
        count = min(max(round(wanted / size), 0), int(n * cap))
        carried = wanted - count * size
        copies.append(count)
    return classes.assign(copies=copies)[["source_id", "size", "n", "copies"]]


def mix(
    docs: DataFrame, weights: Sequence[float], share: float, cap: float = 2.0, *, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """Per document: id, ``size``, ``source_size``, ``target`` (its source's), ``rate``, ``copies`` and ``taken``."""
    sized = save(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size")), "sized")
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("n_docs"))
    dealt = source_targets(totals.select("source", "source_size"), weights, share, cap)
    same_source = F.col("t.source").eqNullSafe(F.col("s.source"))
    targets = save(dealt.alias("t").join(totals.select("source", "n_docs").alias("s"), same_source).select(
        "t.*", "n_docs"), "targets")

    grouped = sized.groupBy("source", "size").agg(F.count("*").alias("n"))
    classes = save(grouped.alias("s").join(targets.alias("t"), same_source).select(
        "t.source_id", "s.source", "size", "n"), "classes")
    lam = dual_multipliers(classes.filter("size > 0"), targets, cap)
    x = F.col("size") * F.col("n_docs") / F.col("source_size")
    rate = (
        F.when(F.col("size") == 0, 1.0).when(F.col("lam") == math.inf, float(cap)).when(F.col("lam") == -math.inf, 0.0)
        .otherwise(F.least(F.exp(F.least(F.col("lam") * x, F.lit(700.0))), F.lit(float(cap)))))
    rated = save(classes.join(targets.drop("source"), "source_id").join(lam, "source_id").select(
        "source_id", "source", "size", "n", "source_size", "target", rate.alias("rate")), "rated")
    copies = (
        rated.filter("size > 0").select("source_id", "size", "n", "rate", F.lit(float(cap)).alias("cap"))
        .groupBy("source_id").applyInPandas(_copies, "source_id bigint, size bigint, n bigint, copies bigint"))
    rated = rated.join(copies.drop("n"), ["source_id", "size"], "left").withColumn(
        "copies", F.coalesce("copies", "n"))

    # Of the n rows of a class, copies mod n get one more. Rows are ranked in parts of a class, by a hash of the id; the
    # rank of a row is its rank in the part plus the rows of the class's earlier parts.
    part = F.pmod(F.xxhash64("_id"), F.lit(CLASS_PARTS)).cast("int").alias("part")
    counted = sized.select("source", "size", part).groupBy("source", "size", "part").agg(F.count("*").alias("m"))
    before = F.sum("m").over(Window.partitionBy("source", "size").orderBy("part")) - F.col("m")
    starts = counted.select("source", "size", "part", before.alias("before"))
    same_class = same_source & (F.col("t.size") == F.col("s.size"))
    slots = save(starts.alias("s").join(rated.alias("t"), same_class).select("t.*", "part", "before"), "slots")
    placed = sized.select("*", part).alias("s").join(
        slots.alias("t"), same_class & (F.col("s.part") == F.col("t.part")))
    order = Window.partitionBy("t.source_id", "t.size", "t.part").orderBy(F.xxhash64("_id"), "_id")
    ranked = placed.withColumn("_rank", F.row_number().over(order) - 1 + F.col("before"))
    extra = F.col("_rank") < F.col("copies") % F.col("n")
    taken_copies = F.floor(F.col("copies") / F.col("n")) + extra.cast("long")
    return ranked.select(
        F.col("_id").alias(id_col), F.col("s.size").alias("size"), "source_size", "target", "rate",
        taken_copies.cast("long").alias("copies"), (taken_copies * F.col("s.size")).cast("long").alias("taken"))

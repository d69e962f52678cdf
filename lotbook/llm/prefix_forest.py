"""Approximate nearest neighbours by largest inner product, with a forest of sorted hash strings.

**Index.** Every vector gets one string of ``BITS`` hyperplane signs per tree. For inner products of vectors of unequal
length a coordinate is added that brings all indexed vectors to one length; queries have 0 there. A tree is the array of
its strings in sorted order, cut into blocks of ``block_rows``; neighbours in the array share long prefixes. Positions
come from a distributed range sort.

**Search.** A query descends in each tree to where its string would stand, the longest prefix match, and compares itself
with the blocks around it. Then all trees ascend together: if the entries that share ``x_t`` bits with the query in tree
t have all been seen, a vector as near as the k-th best so far was missed with a chance of at most
``prod_t (1 - p**x_t)``, where p is the chance that one hyperplane does not separate the two. Queries for which that is
above ``miss`` widen their stretch in every tree, to shorter prefixes; those for which the stretches would hold as much
as the whole array go to the root, that is to all blocks of the first tree. So clustered vectors are found in a few
blocks, and vectors without near neighbours, for which no hash is selective, are searched in full, in blocks.

**Ties and repeats.** Equal vectors are one entry with its ``k + 1`` smallest ids, which is all that any query can need;
a query's result is worked out once per distinct vector. So a vector that fills a third of the table costs one entry.

Scores are inner products of the original vectors in double precision. Vectors of different dimensions have none, so
each dimension is a table of its own. Vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do rows with a null id; repeated rows count once; an empty table gives an empty result. Only the id and the vector column are read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.operators.surrogate import assign_surrogate
from lotbook.sources.scratch import save, save_counted

TREES = 8
BITS = 62
BLOCK_ROWS = 1024
MISS = 0.03
QUERIES_PER_GROUP = 2048
_SEED = 20


def usable(vector: Column) -> Column:
    """Not null, at least one component other than 0, all finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < math.inf) & ~F.isnan(x))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _bit_length(x: np.ndarray) -> np.ndarray:
    high = x >> np.uint64(31)
    part = np.where(high > 0, high, x & np.uint64(0x7FFFFFFF))
    return np.frexp(part.astype(np.float64))[1] + np.where(high > 0, 31, 0)


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bits two strings share."""
    return BITS - _bit_length(a.astype(np.uint64) ^ b.astype(np.uint64))


def _strings(classes: DataFrame, dimension: int, longest: float, trees: int) -> DataFrame:
    """``class_id``, the vector as packed doubles, its length, and its strings as an entry and as a query."""
    fields = [T.StructField("class_id", T.LongType()), T.StructField("vec", T.BinaryType()),
              T.StructField("norm", T.DoubleType()), T.StructField("entry_keys", T.ArrayType(T.LongType())),
              T.StructField("query_keys", T.ArrayType(T.LongType()))]

    def run(batches):
        draw = np.random.default_rng(_SEED)
        planes = draw.normal(size=(dimension + 1, trees * BITS))
        weight = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)

        def keys(sides: np.ndarray) -> pa.Array:
            packed = (sides > 0).reshape(-1, trees, BITS).astype(np.int64) @ weight
            bounds = np.arange(len(packed) + 1, dtype=np.int32) * trees
            return pa.ListArray.from_arrays(pa.array(bounds), pa.array(packed.ravel()))

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                vectors = flat.reshape(part.num_rows, dimension)
                norm = np.sqrt((vectors * vectors).sum(axis=1))
                sides = vectors @ planes[:-1]
                rest = np.sqrt(np.maximum(longest * longest - norm * norm, 0))
                packed = [row.tobytes() for row in vectors]
                yield pa.RecordBatch.from_arrays(
                    [part.column("class_id"), pa.array(packed, pa.binary()), pa.array(norm),
                     keys(sides + rest[:, None] * planes[-1]), keys(sides)], names=[f.name for f in fields])

    return classes.select("class_id", "vector").mapInArrow(run, T.StructType(fields))


_FOUND = "query long, tree int, cand long, score double, lo int, hi int"


def _compare(k: int):
    """Queries of a group against the entries of one block: the best candidates, and how far the block's ends reach."""

    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if entries.empty or queries.empty:
            return pd.DataFrame({c: [] for c in ("query", "tree", "cand", "score", "lo", "hi")})
        entries = entries.sort_values("pos")
        known = np.frombuffer(b"".join(entries["vec"]), dtype=np.float64).reshape(len(entries), -1)
        asked = np.frombuffer(b"".join(queries["vec"]), dtype=np.float64).reshape(len(queries), -1)
        ids, entry_key = entries["class_id"].to_numpy(), entries["key"].to_numpy()
        own, key = queries["class_id"].to_numpy(), queries["key"].to_numpy()
        floor = queries["floor"].to_numpy()
        home, block = queries["home"].to_numpy(), int(queries["block"].iloc[0])
        lo = np.where(home >= block, common_prefix(key, np.full_like(key, entry_key[0])), BITS)
        hi = np.where(home <= block, common_prefix(key, np.full_like(key, entry_key[-1])), BITS)
        lo[(home >= block) & (block == 0)] = -1
        hi[(home <= block) & (block == queries["blocks"].to_numpy() - 1)] = -1
        out = []
        tree = int(queries["tree"].iloc[0])
        for at in range(0, len(asked), 256):
            scores = asked[at : at + 256] @ known.T
            few = min(k, scores.shape[1])
            best = np.argpartition(-scores, few - 1, axis=1)[:, :few]
            value = np.take_along_axis(scores, best, axis=1)
            # Of entries as good as the last of the best, those of least id are kept: an entry's id is its vector's
            # least, so no other can be among the best.
            edge = value.min(axis=1)
            row, place = np.nonzero(scores >= np.maximum(edge, floor[at : at + 256])[:, None])
            if len(row) > few * len(scores) or np.bincount(row, minlength=1).max(initial=0) > few:
                order = np.lexsort((ids[place], -scores[row, place], row))
                row, place = row[order], place[order]
                kept = np.arange(len(row)) - np.searchsorted(row, row) < few
                row, place = row[kept], place[kept]
            out.append(pd.DataFrame({"query": own[at + row], "tree": tree, "cand": ids[place],
                                     "score": scores[row, place], "lo": BITS, "hi": BITS}))
        ends = pd.DataFrame({"query": own, "tree": tree, "cand": pd.array([None] * len(own), "Int64"),
                             "score": np.nan, "lo": lo, "hi": hi})
        return pd.concat([*out, ends])

    return run


def _visit(index: DataFrame, visits: DataFrame, k: int, n_queries: int) -> DataFrame:
    """Compares queries with blocks; ``visits`` has a row per query, tree and block, with the query's vector."""
    groups = max(1, math.ceil(n_queries / QUERIES_PER_GROUP))
    visits = visits.withColumn("salt", F.pmod(F.xxhash64("class_id"), F.lit(groups)).cast("int"))
    needed = visits.select("tree", "block", "salt").distinct()
    entries = index.join(needed, ["tree", "block"])
    keys = ["tree", "block", "salt"]
    visits = visits.select([F.col(c).alias(c) for c in visits.columns])  # attributes apart from those in ``needed``
    return entries.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInPandas(_compare(k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best distinct candidates of each query, ties by their least id."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cand"))
    scores = found.groupBy("query", "cand").agg(F.max("score").alias("score"))
    return scores.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, *, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, block_rows: int = BLOCK_ROWS, miss: float = MISS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest found for each query row, itself left out."""
    spark = vectors.sparkSession
    rows = vectors.withColumn("_query", F.coalesce(is_query, F.lit(False))).select(
        F.col(id_col).cast("long").alias("_id"), F.col(vector_col).alias("vector"), "_query").filter(
        F.col("_id").isNotNull() & usable(F.col("vector")))
    dimensions = sorted(r["d"] for r in rows.select(F.size("vector").alias("d")).distinct().collect())
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [_nearest(rows.filter(F.size("vector") == d), d, k, trees, block_rows, miss) for d in dimensions]
    return reduce(DataFrame.unionByName, found) if found else empty


def _nearest(rows: DataFrame, dimension: int, k: int, trees: int, block_rows: int, miss: float) -> DataFrame:
    """:func:`nearest` among usable vectors of one dimension: ``_id, vector, _query``."""
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = save(rows.withColumn("vector", F.col("vector").cast("array<double>")).distinct(), "vectors")
    first = F.row_number().over(Window.partitionBy("vector").orderBy("_id"))
    classes = save(
        rows.withColumn("_place", first).filter(F.col("_place") <= k + 1).groupBy("vector")
        .agg(F.array_sort(F.collect_list("_id")).alias("ids")).withColumn("class_id", F.col("ids")[0]), "classes")
    asked = save(rows.filter("_query").select(F.col("_id").alias("query_id"), "vector").join(
        classes.select("vector", "class_id"), "vector").select("query_id", "class_id"), "asked")
    if asked.isEmpty():
        return empty
    longest = math.sqrt(classes.agg(F.max(F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x * x))).first()[0])
    hashed = save(_strings(classes, dimension, longest, trees), "strings")

    entries = hashed.select("class_id", F.posexplode("entry_keys").alias("tree", "key"), F.lit(0).alias("asks"))
    queries = hashed.join(asked.select("class_id").distinct(), "class_id", "left_semi")
    strings = entries.unionByName(
        queries.select("class_id", F.posexplode("query_keys").alias("tree", "key"), F.lit(1).alias("asks")))
    numbered = assign_surrogate(strings, "pos", ["key", "asks", "class_id"], start=0, within=["tree"])
    n_all = numbered.counts[(0,)]
    blocks = math.ceil(n_all / block_rows)
    placed = save(numbered.rows.withColumn("block", F.floor(F.col("pos") / block_rows).cast("int")), "placed")
    index = save(placed.filter("asks = 0").join(hashed.select("class_id", "vec"), "class_id").select(
        "tree", "block", "pos", "key", "class_id", "vec"), "index")
    homes = save(placed.filter("asks = 1").join(hashed.select("class_id", "vec", "norm"), "class_id").select(
        "tree", F.col("block").alias("home"), "key", "class_id", "vec", "norm"), "homes")

    every = F.sequence(F.lit(0), F.lit(blocks - 1))
    state, n_open = save_counted(queries.select(
        "class_id", F.lit(1).alias("width"), F.lit(-math.inf).alias("floor")), "open")
    best = None
    while n_open:
        at = homes.join(state, "class_id").withColumn("blocks", F.lit(blocks))
        around = F.sequence(F.greatest(F.col("home") - F.col("width"), F.lit(0)),
                            F.least(F.col("home") + F.col("width"), F.lit(blocks - 1)))
        whole = F.col("width") >= blocks
        visits = at.filter(~whole | (F.col("tree") == 0)).withColumn(
            "block", F.explode(F.when(whole, every).otherwise(around)))
        found = save(_visit(index, visits, k + 1, n_open), "visited")
        scored = found.filter("cand IS NOT NULL").select("query", "cand", "score")
        best = save(_best(scored if best is None else scored.unionByName(best), k + 1), "best")
        # What each tree has seen in full: all that share one bit more than the nearer end of the stretch.
        reach = found.groupBy("query", "tree").agg(F.min("lo").alias("lo"), F.min("hi").alias("hi"))
        known = best.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        chance = (
            reach.join(known, "query", "left").join(
                state.filter(F.col("width") < blocks).select(F.col("class_id").alias("query"), "width"), "query")
            .join(queries.select(F.col("class_id").alias("query"), "norm"), "query")
            .withColumn("near", F.greatest(F.least(F.col("kth") / (F.col("norm") * longest), F.lit(1.0)), F.lit(-1.0)))
            .withColumn("p", 1 - F.acos("near") / math.pi)
            .withColumn("seen", F.pow("p", F.greatest("lo", "hi") + 1))
            .groupBy("query", "width", "p", "kth", "n")
            .agg(F.sum(F.log1p(-F.least("seen", F.lit(1 - 1e-15)))).alias("log_miss")))
        # The prefix length at which the chance would be low enough, and the blocks such a prefix spans.
        bits = F.log(1 - F.pow(F.lit(miss), 1 / trees)) / F.log("p")
        span = F.ceil(F.lit(2.0 * blocks) * F.pow(F.lit(2.0), -bits))
        wider = F.greatest(F.col("width") * 3, F.coalesce(span, F.lit(blocks))).cast("int")
        state, n_open = save_counted(
            chance.filter((F.coalesce("n", F.lit(0)) < k + 1) | (F.col("log_miss") > math.log(miss)))
            .select(F.col("query").alias("class_id"),
                    F.when((F.coalesce("n", F.lit(0)) < k + 1) | (2 * wider * trees >= blocks), F.lit(blocks))
                    .otherwise(wider).alias("width"),
                    F.when(F.col("n") >= k + 1, F.col("kth")).otherwise(F.lit(-math.inf)).alias("floor")), "open")

    ids = best.join(classes.select(F.col("class_id").alias("cand"), "ids"), "cand").select(
        "query", "score", F.explode("ids").alias("vec_id"))
    nearby = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("_place", F.row_number().over(nearby)).filter(F.col("_place") <= k + 1)
    results = asked.join(ids, asked["class_id"] == ids["query"]).filter(F.col("vec_id") != F.col("query_id"))
    final = Window.partitionBy("query_id").orderBy("_place")
    return results.withColumn("rank", F.row_number().over(final).cast("int")).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")

import re

import pytest
from pyspark.sql import functions as F

from lotbook.operators import lookup
from lotbook.operators.merge import union_with_priority
from lotbook.sources.feeds import OFFLINE, ONLINE
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third have none."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(6000).select(key.cast("bigint").alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def members(spark):
    return spark.range(0, 6000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("m")).union(
        spark.createDataFrame([(7, 70), (None, -5)], "k bigint, m bigint"))


def test_hot_keys_are_the_frequent_ones_only(skewed):
    assert rows(lookup.hot_keys(skewed, ["k"])) == [(7,), (None,)]
    assert rows(lookup.hot_keys(skewed.filter("k <> 7"), ["k"])) == []


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_sliced_join_equals_plain_join(skewed, members, how, null_safe):
    plain = lookup.lookup_join(skewed, members, ["k"], how, null_safe=null_safe)
    sliced = lookup.lookup_join(skewed, members, ["k"], how, null_safe=null_safe, limit=0)
    assert rows(sliced, *plain.columns) == rows(plain)


def test_non_unique_lookup_multiplies_rows_in_both_ways(skewed, members):
    twice = members.union(members.filter("k = 7"))
    plain = lookup.lookup_join(skewed, twice, ["k"])
    assert plain.count() == 6000 + skewed.filter("k = 7").count()
    assert rows(lookup.lookup_join(skewed, twice, ["k"], limit=0)) == rows(plain)


def test_hot_key_is_spread_over_partitions(spark, skewed, members):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.lookup_join(skewed, members, ["k"], limit=0)
        spread = joined.filter("k = 7").select(F.spark_partition_id().alias("p")).groupBy("p").count()
        sizes = [r["count"] for r in spread.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 4 and max(sizes) < 2000 * 0.6


def test_broadcast_only_up_to_the_checked_size(skewed, members):
    def plan(limit):
        frame = lookup.lookup_join(skewed, members, ["k"], limit=limit)
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert lookup.fits_broadcast(members, 3002) and not lookup.fits_broadcast(members, 3001)
    assert not lookup.fits_broadcast(members, 10, known_rows=11)
    assert "strategy=broadcast" in plan(5000)
    assert "_slice" in plan(100)


def test_resolve_gives_the_default_member(spark):
    table = spark.createDataFrame([("A", 1), ("B", 2)], "src string, id bigint")
    found = spark.createDataFrame([("A",), ("C",), (None,)], "t string")
    assert rows(lookup.resolve(found, table, F.col("t"), "src", "id")) == [("A", 1), ("C", -1), (None, -1)]
    assert rows(lookup.resolve(found, table, F.col("t"), "src", "id", default=None)) == [
        ("A", 1), ("C", None), (None, None)]


def test_priority_looks_at_the_unfiltered_primary_feed(spark):
    feed = spark.createDataFrame(
        [("A", "x", OFFLINE.system), ("A", "x", OFFLINE.system), ("B", "", OFFLINE.system), ("A", "y", ONLINE.system),
         ("B", "y", ONLINE.system), ("C", "y", ONLINE.system), (None, "y", ONLINE.system)],
        "key string, name string, source_system string",
    )
    merged = union_with_priority(feed.filter("name <> ''"), feed, "key")
    assert rows(merged, "key", "name") == [("A", "x"), ("C", "y"), (None, "y")]


def test_equal_rows_of_a_hot_key_are_spread_too(spark, members):
    same = spark.range(30_000).select(F.lit(7).cast("bigint").alias("k")).union(
        spark.range(30_000).select((F.col("id") * 2).alias("k")))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup.lookup_join(same, members, ["k"], limit=0).filter("k = 7")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30_000 and len(sizes) == 4 and max(sizes) < 15_000


def test_texts_beyond_the_byte_limit_are_not_broadcast(spark, monkeypatch):
    wide = spark.range(10).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 100).alias("t"))
    assert lookup.fits_broadcast(wide, known_rows=10, free_text=True)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 999)
    assert not lookup.fits_broadcast(wide, known_rows=10, free_text=True) and not lookup.fits_broadcast(wide)
    assert lookup.fits_broadcast(wide, known_rows=10)


def test_one_pass_finds_the_hot_keys_of_all_lookups(spark, skewed):
    """Seven lookups above the limit take one job for their frequent keys, and find what single passes find."""
    wide = skewed.select("*", *[(F.col("v") % n).alias(f"m{n}") for n in (2, 3, 5, 7, 9000)]).withColumn(
        "t", F.when(F.col("v") % 4 == 0, F.lit("é\"x")))
    keysets = {"k": ["k"], **{f"m{n}": [f"m{n}"] for n in (2, 3, 5, 7, 9000)}, "both": ["k", "t"]}
    tracker, group = spark.sparkContext.statusTracker(), "hot-keys"
    hot = lookup.HotKeys(wide, keysets)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.sparkContext.setJobGroup(group, "")
    try:
        hot.get("k")
        assert len(tracker.getJobIdsForGroup(group)) == 1
    finally:
        spark.sparkContext.setJobGroup("", "")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert rows(hot.get("k")[0]) == [(7,), (None,)] and hot.get("k")[1] == 2001
    assert len(rows(hot.get("m7")[0])) == 7 and rows(hot.get("m9000")[0]) == []
    counts = wide.groupBy("k", "t").count().filter(F.col("count") > 6000 * lookup.HOT_SHARE).drop("count")
    assert rows(hot.get("both")[0], "k", "t") == rows(counts, "k", "t")
    assert rows(lookup.HotKeys(wide.limit(0), keysets).get("k")[0]) == []


def test_text_keys_are_merged_by_a_hash_first(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 0)
    pairs = [("same beginning", "a"), ("same beginning", None), (None, None), ("same beginning", "b")]
    left = spark.createDataFrame([(*pair, i) for i, pair in enumerate(pairs)], "x string, y string, v int")
    right = spark.createDataFrame([(*pair, 10 * i) for i, pair in enumerate(pairs[:3])], "x string, y string, w int")
    safe = lookup.lookup_join(left, right, ["x", "y"], null_safe=True, known_rows=3)
    text = safe._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[(coalesce\()?_hash", text) and "_hash" not in safe.columns
    assert rows(safe, "v", "w") == [(0, 0), (1, 10), (2, 20), (3, None)]
    assert rows(lookup.lookup_join(left, right, ["x", "y"], known_rows=3), "v", "w") == [(0, 0), (1, None), (2, None), (3, None)]
    assert rows(lookup.lookup_join(left, right, ["x", "y"], "left_anti", known_rows=3), "v") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("shared_are_few", [True, False])
@pytest.mark.parametrize("limit", [0, 100])
def test_anti_join_by_its_rare_keys_equals_a_plain_one(spark, monkeypatch, shared_are_few, limit):
    """Keys that repeat on either side or hold a NULL; wide rows are only shuffled beyond the limit."""
    left = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 1), ("a", None, 2), ("b", "x", 3), (None, None, 4), ("c", "y", 5)], "k string, l string, v int")
    right = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), (None, None), ("c", "z")], "k string, l string")
    expected = rows(left.join(right, ["k", "l"], "left_anti"))
    assert len(expected) == 4
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", limit)
    hot = lookup.HotKeys(left, {"keys": ["k", "l"]})
    found = lookup.anti_join(left, right, ["k", "l"], shared_are_few=shared_are_few, hot=(hot, "keys"))
    assert rows(found) == expected
    assert ("SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()) == (limit == 0)
    assert ("keys" in hot.keysets) == (limit == 0)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_copies_of_a_hot_key_may_be_left_out(spark, members, how):
    """A binary key, as a digest is; a hot key's copies leave as one row, and other rows as they came."""
    pairs = spark.range(6000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).cast("bigint").alias("n"))
    left = pairs.select(F.unhex(F.md5(F.col("n").cast("string"))).alias("k"), "n")
    right = members.filter("k IS NOT NULL").distinct().groupBy("k").agg(F.max("m").alias("m")).select(
        F.unhex(F.md5(F.col("k").cast("string"))).alias("k"), "m")
    plain = lookup.lookup_join(left, right, ["k"], how)
    few = lookup.lookup_join(left, right, ["k"], how, limit=0, distinct=True)
    assert rows(lookup.hot_keys(left, ["k"])) == [r for r in rows(left.filter("n = 7").select("k").distinct())]
    assert few.filter("n = 7").count() == 1 and few.filter("n <> 7").count() == plain.filter("n <> 7").count()
    assert rows(few.distinct(), *plain.columns) == rows(plain.distinct())


def test_a_shuffled_anti_join_stays_behind_the_lookups(spark, monkeypatch):
    """Only the rare keys are joined, and narrow rows are shuffled: lookups made before are worked out before."""
    monkeypatch.setattr(lookup, "BROADCAST_ROWS", 2)
    left = spark.range(100).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("t"), F.col("id") % 2).alias("t"))
    small = spark.createDataFrame([("t0", 0), ("t1", 1)], "t string, v int")
    narrow = lookup.lookup_join(left, small, ["t"], known_rows=2).drop("t")
    found = lookup.anti_join(narrow, spark.range(90).select(F.col("id").cast("string").alias("k")), ["k"], shared_are_few=True)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found, "k", "v") == [(str(i), i % 2) for i in range(90, 100)]
    assert text.index("_found") < text.index("strategy=broadcast")

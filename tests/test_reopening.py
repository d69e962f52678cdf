"""A warehouse that another session, or another database name, opens again."""

import datetime as dt
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lotbook.operators.insert_only import load_insert_only, not_in_table
from lotbook.operators.scd2 import detect_mirror_changes, detect_versions
from lotbook.plans.warehouse import run_warehouse
from lotbook.sources.scratch import new_folder
from lotbook.sources.store import DIGEST, Store, digest
from tests import feeds
from tests.conftest import rows

DAY, DAY2 = dt.date(2024, 1, 10), dt.date(2024, 2, 1)
TABLES = ("ce_dealers", "ce_customers_sdc", "ce_sales", "dim_customers_sdc", "dim_dealers", "fct_sales")

SECOND_DAY = """
import datetime as dt, json, sys
from pyspark.sql import SparkSession
root, scratch = sys.argv[1:]
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.checkpoint.dir", scratch)
         .config("spark.sql.warehouse.dir", scratch + "/warehouse").getOrCreate())
from lotbook.plans.warehouse import run_warehouse
from lotbook.sources.store import Store
from tests import feeds
store = Store(spark, root, "second")
done = run_warehouse(feeds.feed(spark, ({}, {"id": "101", "customertelephonenumber": "555-9"})), store, dt.date(2024, 2, 1))
print("ROWS", json.dumps({"done": done, "facts": store.read("fct_sales").count(),
      "rows": {t: store.rows(t) for t in sys.argv[3:] or done}}))
"""


def test_second_session_adds_nothing(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    store = Store(spark, root, "first_day")
    # Two loads: the second closes a customer version, so tables were replaced as well.
    run_warehouse(feeds.feed(spark), store, DAY)
    changed = ({}, {"id": "101", "customertelephonenumber": "555-9"})
    run_warehouse(feeds.feed(spark, changed), store, DAY2)
    assert store.read("ce_customers_sdc").filter("is_active = 'N'").count() == 1
    before = {t: store.rows(t) for t in TABLES}
    out = subprocess.run(
        [sys.executable, "-c", SECOND_DAY, root, str(tmp_path / "scratch")], capture_output=True, text=True,
        cwd=Path(__file__).resolve().parent.parent, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    import json

    said = json.loads(out.stdout.split("ROWS", 1)[1])
    loads = {t: counts for t, counts in said["done"].items() if t != "fct_sales"}
    assert sum(sum(counts.values()) for counts in loads.values()) == 0
    assert said["facts"] == before["fct_sales"] > 0
    assert {t: said["rows"][t] for t in before} == before


def test_other_database_name_over_the_same_root(spark):
    root = new_folder(spark, "root")
    one = Store(spark, root, "reopen_one")
    dealers = spark.createDataFrame([("A", "A"), ("B", "B")], "dealer_src_id string, dealer_name string")
    dealers = dealers.withColumn("source_system", F.lit("s")).withColumn("source_entity", F.lit("e"))
    load_insert_only(one, "ce_dealers", dealers, DAY, 2)
    one.replace("ce_dealers", one.read("ce_dealers").withColumn("dealer_name", F.lit("NEW")))
    two = Store(spark, root, "reopen_two")
    assert load_insert_only(two, "ce_dealers", dealers, DAY, 2) == {"New rows": 0, "Default rows": 0}
    assert two.rows("ce_dealers") == 3 and {r[0] for r in two.read("ce_dealers").select("dealer_name").collect()} == {"NEW"}


def test_a_second_writer_fails_at_the_pointer(spark, monkeypatch):
    store = Store.temporary(spark)
    store.ensure("ce_dealers")
    seen = iter([[], ["000000000=other"]])
    monkeypatch.setattr(store, "_pointers", lambda table: next(seen))
    with pytest.raises(RuntimeError, match="another writer"):
        store._point("ce_dealers", "mine")


@pytest.fixture
def large(spark, store, monkeypatch):
    """A table above the broadcast limit, and a delta of three keys."""
    for module in ("lookup", "insert_only"):
        monkeypatch.setattr(f"lotbook.operators.{module}.BROADCAST_ROWS", 1000)
    table = spark.range(1, 5001).select(
        F.col("id").alias("dealer_id"), F.concat(F.lit("D"), "id").alias("dealer_src_id"),
        F.concat(F.lit("D"), "id").alias("dealer_name"), F.lit("s").alias("source_system"),
        F.lit("e").alias("source_entity"), F.lit(DAY).alias("insert_dt"), F.lit(DAY).alias("update_dt"))
    store.append("ce_dealers", table)
    delta = spark.createDataFrame([("D7", "D7"), ("X1", "X1"), ("X2", "X2")], "dealer_src_id string, dealer_name string")
    return delta.withColumn("source_system", F.lit("s")).withColumn("source_entity", F.lit("e"))


def test_small_delta_meets_a_reduced_target_in_its_own_partitions(spark, store, large):
    fresh = not_in_table(large, store, "ce_dealers", ["dealer_src_id"], candidate_rows=3)
    text = fresh._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "LeftSemi" in text and "Coalesce 1" not in text
    assert rows(fresh, "dealer_src_id") == [("X1",), ("X2",)]
    load_insert_only(store, "ce_dealers", large, DAY, 3)
    assert rows(store.read("ce_dealers").filter("dealer_id > 5000"), "dealer_id", "dealer_src_id") == [
        (5001, "X1"), (5002, "X2")]


def test_history_joins_do_not_broadcast_a_large_target(spark):
    target = spark.range(5000).select(
        F.col("id").cast("string").alias("k"), F.lit("a").alias("t"), F.lit("Y").alias("is_active"),
        F.col("id").alias("n"), F.lit(DAY).alias("start_dt"), F.lit(DAY).alias("end_dt")).withColumn(
        DIGEST, digest([F.col("t")]))
    snapshot = spark.createDataFrame([("7", "b"), ("x", "a")], "k string, t string")
    for known, whole in ((2, False), (10**6, True)):
        versions = detect_versions(target, snapshot, "k", digest([F.col("t")]), known)
        assert rows(versions, "k", "change") == [("7", "version"), ("x", "new")]
        text = versions._jdf.queryExecution().optimizedPlan().toString()
        assert ("strategy=merge" in text) == whole and ("LeftSemi" in text) != whole
    source = snapshot.withColumn("is_active", F.lit("Y")).withColumn("start_dt", F.lit(DAY)).withColumn(
        "end_dt", F.lit(DAY))
    mirror = detect_mirror_changes(target, source, "k", "n", digest([F.col("t")]), ["start_dt", "end_dt", "is_active"], 2)
    assert rows(mirror, "k", "change", "_row") == [("7", "reopen", 7), ("x", "insert", None)]

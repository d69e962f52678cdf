"""The physical plans of the hot paths."""

import contextlib
import datetime as dt
import io
import re

import pytest
from pyspark.sql import functions as F

from checks import tpch_feed
from lotbook.operators.periods import DEFAULT_PERIODS, Period, within_periods
from lotbook.operators.surrogate import assign_surrogate
from lotbook.plans import entities, sales
from lotbook.sources.feeds import OFFLINE, judged_lines
from tests import feeds
from tests.conftest import rows

DAY = dt.date(2024, 1, 10)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    """Columns of every file scan in the plan."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    text = out.getvalue()
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


@pytest.fixture(scope="module")
def feed(spark):
    return feeds.feed(spark)


def test_profiles_read_only_their_columns(feed):
    assert scanned(entities.profile(feed, ("dealer",))) == [{"cardelername"}, {"car_dealer_name"}]


def test_sales_read_no_phones_and_join_without_products(feed, store):
    frame = sales.sales_to_load(feed, store)
    text = plan(frame)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text and "Window" not in text
    columns = set().union(*scanned(frame))
    assert "saleprice" in columns
    assert not {"customertelephonenumber", "customer_telephone_number", "salesperson", "employee"} & columns


def test_small_lookups_are_broadcast(feed, store):
    entities.load_entity(feed, store, entities.DEALERS, DAY)
    text = plan(entities.resolve_entity(feed.select("dealer"), store, entities.DEALERS))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_period_range_reaches_the_scan(feed, store):
    sales.load_sales(feed, store, DAY)
    text = plan(within_periods(store.read("ce_sales"), DEFAULT_PERIODS[:1]))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThanOrEqual(date_id,4500)" in pushed and "LessThanOrEqual(date_id,4593)" in pushed


def test_periods_are_pruned(feed, store):
    entities.load_dates(store, DAY)
    sales.load_sales(feed, store, DAY)
    sales.load_fact(store, DAY)
    frame = store.read("fct_sales").filter("sales_period = '2022_Q2'")
    assert "PartitionFilters: [isnotnull(sales_period" in plan(frame)
    assert all("sales_period=2022_Q2" in f for f in frame.inputFiles())


def test_numbering_needs_no_window_and_no_second_shuffle(spark):
    numbered = assign_surrogate(spark.range(100).select(F.col("id").alias("k")), "n", ["k"]).rows
    text = plan(numbered)
    assert "Window" not in text and "hashpartitioning" not in text


def test_fact_numbers_need_no_sort(spark, feed, store, monkeypatch):
    """Numbers follow from runs of sale ids: of one load, of two, and sorted where they cannot."""
    entities.load_dates(store, DAY)
    sales.load_sales(feed, store, DAY)
    text = plan(sales.numbered_fact(store, DEFAULT_PERIODS).rows)
    assert "rangepartitioning" not in text and "Sort " not in text
    other = store.read("ce_sales").limit(1).drop("sale_id", "date_id")
    for first in (101, 107):  # two loads of six sales, three in each of two periods
        ids = spark.range(first, first + 6).select(
            F.col("id").alias("sale_id"), F.when(F.col("id") < first + 3, 4600).otherwise(4700).cast("bigint").alias("date_id"))
        store.append("ce_sales", ids.crossJoin(other).coalesce(1))
    assert [r for r in sales.sale_runs(store, DEFAULT_PERIODS) if r[0] != "2022_Q2"] == [
        ("2022_Q3", 101, 103, 0), ("2022_Q3", 107, 109, 3), ("2022_Q4", 104, 106, 0), ("2022_Q4", 110, 112, 3)]
    found = sales.numbered_fact(store, DEFAULT_PERIODS)
    columns = ["sales_period", "sale_id", "sale_surr_id"]
    by_runs = rows(found.rows, *columns)
    assert [r[2] for r in by_runs if r[0] == "2022_Q4"] == [2, 3, 4, 5, 6, 7]
    monkeypatch.setattr(sales, "sale_runs", lambda *_: None)
    in_order = sales.numbered_fact(store, DEFAULT_PERIODS)
    assert rows(in_order.rows, *columns) == by_runs and in_order.counts == found.counts


def test_gaps_and_overlaps_are_no_runs(feed, store):
    entities.load_dates(store, DAY)
    sales.load_sales(feed, store, DAY)
    whole = store.read("ce_sales")
    assert sales.sale_runs(store, DEFAULT_PERIODS)
    store.replace("ce_sales", whole.withColumn("sale_id", F.col("sale_id") * 2).coalesce(1))
    assert sales.sale_runs(store, [Period("all", 1, 10**6)]) is None


def test_only_lines_with_a_quote_meet_the_quote_pattern(spark):
    lines = spark.createDataFrame([(";".join("x" * len(OFFLINE.columns)),)], "value string")
    text = plan(judged_lines(lines, OFFLINE))
    assert "regexp_replace" in text and text.count("regexp_replace") == text.count("Contains(")


def test_conflicting_customers_read_the_feed_once(feed, store):
    text = plan(entities.to_load(feed, store, entities.CUSTOMERS))
    assert "customername" not in text and "customer_name_and_surname" not in text


def test_lines_of_a_large_table_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """The tasks of the last join, and of what follows it, hold no more lines of a larger table."""
    tables = {
        "region": "0 r_regionkey, 'R' r_name", "nation": "0 n_nationkey, 'N' n_name, 0 n_regionkey",
        "customer": "id c_custkey, 'C' c_name, 0 c_nationkey, 'S' c_mktsegment",
        "supplier": "id s_suppkey, 'S' s_name", "part": "id p_partkey, 'P q' p_name, 'B' p_brand, 'T' p_type, 1 p_size",
        "orders": "id o_orderkey, id % 9 o_custkey, 'O' o_orderstatus, '1' o_orderpriority, timestamp_ntz'2000-01-01' o_orderdate",
        "lineitem": "id % 500 l_orderkey, id % 7 l_partkey, id % 5 l_suppkey, 1 l_linenumber, 1.5D l_extendedprice, "
                    "0.1D l_discount, 0.1D l_tax, 'A' l_returnflag",
    }
    for name, columns in tables.items():
        n = 1 if name in ("region", "nation") else 1000
        spark.range(n).selectExpr(*columns.split(", ")).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(tpch_feed, "SPREAD_ROWS", 10, raising=False)
    monkeypatch.setattr(tpch_feed, "LINE_ROWS", 50, raising=False)
    lines = tpch_feed.sale_lines(spark, str(tmp_path))
    sizes = [r["count"] for r in lines.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 1000 and len(sizes) > 10 and max(sizes) < 200

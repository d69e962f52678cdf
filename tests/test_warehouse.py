import datetime as dt
import os
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lotbook.operators import quality
from lotbook.operators.audit import AuditLog, log_history
from lotbook.operators.calendar import build_calendar
from lotbook.operators.measures import percent_of
from lotbook.operators.periods import DEFAULT_PERIODS, Period, check_periods, within_periods
from lotbook.plans import dimensions, entities, sales
from lotbook.plans.warehouse import run_warehouse
from lotbook.schemas import TABLES
from lotbook.sources.store import Store
from tests import feeds
from tests.conftest import rows

DAY1, DAY2 = dt.date(2024, 1, 10), dt.date(2024, 2, 10)
OFFLINE_ROWS = (
    {},
    {"id": "101", "date": "2023-03-05", "saleprice": "N/A", "caryear": "99", "customerbuildingnumber": None},
    {"id": "101", "date": "2023-03-05", "saleprice": "N/A", "caryear": "99", "customerbuildingnumber": None},
    {"id": "102", "date": " 2022-06-01", "cardelername": " ", "customername": None},
    {"id": "103", "date": "2022-13-45", "customerstate": None, "customercity": ""},
    {"id": " ", "date": "2022-06-03"},
    {"id": "104", "date": "06/02/2022", "salesperson": "", "salespersonid": "AnnLee"},
    {"id": "105", "date": "2010-01-01", "salespersonid": "Shy", "salesperson": None},
)
ONLINE_ROWS = (
    {},
    {"id": "100", "car_dealer_name": "Only Online"},
    {"id": "901", "employee_id": "shy", "employee": "Shy Person", "reduction_percent": "0.0705"},
)


@pytest.fixture(scope="module")
def loaded(spark):
    """A store after two runs over the same feed, with the counts of both runs."""
    store = Store.temporary(spark)
    feed = feeds.feed(spark, OFFLINE_ROWS, ONLINE_ROWS)
    return store, run_warehouse(feed, store, DAY1), run_warehouse(feed, store, DAY2)


def test_counts_of_the_first_run(loaded):
    _, first, _ = loaded
    assert {t: c.get("New rows") for t, c in first.items() if "New rows" in c} == {
        "ce_countries": 1, "ce_states": 1, "ce_cities": 1, "ce_streets": 2, "ce_addresses": 4, "ce_car_brands": 1,
        "ce_car_models": 1, "ce_cars": 2, "ce_employees": 2, "ce_dealers": 2, "ce_payment_methods": 2,
        "ce_sales_channels": 2, "ce_dates": 7670,
    }
    assert first["ce_sales"] == {"Inserted": 8}
    assert sum(first["fct_sales"].values()) == 5


def test_second_run_adds_nothing(loaded):
    store, first, second = loaded
    for table, counts in second.items():
        if table != "fct_sales":
            assert set(counts.values()) == {0}, table
    assert second["fct_sales"] == first["fct_sales"]
    assert store.read("fct_sales").count() == 5


def test_sales_of_the_entity_layer(loaded):
    store, _, _ = loaded
    found = {r.source_id: r for r in store.read("ce_sales").collect()}
    assert sorted(found) == ["OFFLINE_100", "OFFLINE_101", "OFFLINE_102", "OFFLINE_103", "OFFLINE_104",
                             "OFFLINE_105", "ONLINE_900", "ONLINE_901"]
    assert found["OFFLINE_101"].sale_price is None and found["OFFLINE_100"].sale_price == Decimal("200.00")
    assert (found["OFFLINE_102"].date_id, found["OFFLINE_102"].dealer_id, found["OFFLINE_102"].customer_id) == (
        -1, -1, -1)
    assert found["OFFLINE_103"].date_id == -1 and found["OFFLINE_105"].date_id == 1
    assert found["OFFLINE_104"].date_id == (dt.date(2022, 6, 2) - dt.date(2010, 1, 1)).days + 1
    # The offline feed knows the id SHY, without a name: that keeps the online employee away too.
    assert found["ONLINE_901"].employee_id == -1 and found["OFFLINE_105"].employee_id == -1
    assert found["OFFLINE_104"].employee_id == found["OFFLINE_100"].employee_id > 0
    assert found["ONLINE_901"].reduction_percent == Decimal("0.07")
    assert found["OFFLINE_100"].income is None and found["ONLINE_900"].commission_rate is None


def test_missing_parts_of_places(loaded):
    store, _, _ = loaded
    addresses = {r.address_src_id: r for r in store.read("ce_addresses").filter("address_id > 0").collect()}
    street = store.read("ce_streets").filter("street_name = 'ELM'").first().street_id
    assert addresses[f"ELM_{street}_N. A._N1"].building_number == "n. a."
    assert addresses["ELM_-1_7_N1"].street_id == -1
    cars = {r.car_src_id: r.year for r in store.read("ce_cars").filter("car_id > 0").collect()}
    assert cars == {"FIAT_PANDA_2015": 2015, "FIAT_PANDA_99": -1}


def test_fact_rows(loaded):
    store, _, _ = loaded
    facts = {r.source_id: r for r in store.read("fct_sales").collect()}
    assert sorted(facts) == ["OFFLINE_100", "OFFLINE_101", "OFFLINE_104", "ONLINE_900", "ONLINE_901"]
    assert facts["OFFLINE_100"].calc_commission_check == Decimal("0.20")
    assert facts["OFFLINE_100"].calc_discount_value == Decimal("0.00")
    assert facts["ONLINE_900"].calc_discount_value == Decimal("0.30")
    assert facts["OFFLINE_101"].sales_period == "2023_Q1"
    numbers = rows(store.read("fct_sales").filter("sales_period = '2022_Q2'"), "sale_surr_id")
    assert numbers == [(n,) for n in range(2, 2 + len(numbers))]
    assert rows(sales.uncovered_sales(store), "source_id") == [
        ("OFFLINE_102",), ("OFFLINE_103",), ("OFFLINE_105",)]


def test_default_members(loaded):
    store, _, _ = loaded
    row = store.read("ce_dates").filter("date_id = -1").first()
    assert (row.date, row.day, row.quarter) == (dt.date(1900, 1, 1), 1, 1)
    row = store.read("dim_dates").filter("date_surr_id = -1").first()
    assert (row.day, row.quarter, row.month_name) == (-1, -1, "n. a.")
    assert store.read("ce_customers_sdc").filter("customer_id = -1").first().end_dt == dt.date(9999, 12, 31)
    assert store.read("dim_customers_sdc").filter("customer_surr_id = -1").first().end_dt is None
    for table in TABLES.values():
        if table.default:
            assert store.read(table.name).filter(F.col(table.id_col) == -1).count() == 1, table.name


def test_dimension_dates_keep_the_entity_number(loaded):
    store, _, _ = loaded
    joined = store.read("dim_dates").join(store.read("ce_dates").select("date", "date_id"), "date")
    assert joined.filter("date_id > 0 AND date_id <> date_surr_id").count() == 0
    row = store.read("dim_dates").filter("date = '2022-05-01'").first()
    assert (row.month_name, row.day_of_week, row.is_weekend) == ("May      ", "Sunday   ", "Y")


def test_integrity_rules_hold(loaded):
    store, _, _ = loaded
    tables = [t for t in TABLES if t != "log_table"]
    report = quality.check_store(store, tables, DEFAULT_PERIODS)
    broken = rows(report.filter("violations > 0"), "table_name", "rule", "columns", "violations")
    assert broken == []
    rules = {r.rule for r in report.select("rule").distinct().collect()}
    assert rules == {"unique", "foreign key", "not null", "domain", "length", "period"}


def test_log_has_a_row_per_load(loaded):
    store, first, second = loaded
    log = store.read("log_table")
    periods = len(first["fct_sales"])  # the fact has a row for each of its periods
    assert log.count() == len(first) + len(second) + 2 * (periods - 1)
    facts = log.filter("procedure_name = 'LOAD_FCT_SALES'")
    assert facts.count() == 2 * periods and sum(r.rows_affected for r in facts.collect()) == 10
    assert facts.filter("log_message LIKE '2022_Q3: date ids 4594 to 4686, rows: %'").count() == 2
    assert log.filter("status <> 'Success'").count() == 0
    history = log_history(store, "LOAD_CE_DEALERS").collect()
    assert [r.log_message for r in history] == [
        "Successfully loaded dealers. New rows: 0, Default rows: 0",
        "Successfully loaded dealers. New rows: 2, Default rows: 1"]
    assert [r.rows_affected for r in history] == [0, 3]


def test_employee_with_two_spellings_doubles_the_sale(spark, store):
    feed = feeds.feed(spark, ({}, {"id": "200", "salesperson": "Ann Leigh"}), ())
    entities.load_entity(feed, store, entities.EMPLOYEES, DAY1)
    for entity in (entities.DEALERS, entities.SALES_CHANNELS, entities.PAYMENT_METHODS):
        entities.load_entity(feed, store, entity, DAY1)
    assert store.read("ce_employees").filter("employee_id > 0").count() == 2
    assert sales.load_sales(feed, store, DAY1) == {"Inserted": 4}
    found = quality.duplicates(store.read("ce_employees"), ["employee_src_id"])
    assert rows(found) == [("ANNLEE", 2)]


def test_long_texts_are_cut_when_stored_and_then_not_found(spark, store):
    feed = feeds.feed(spark, ({"cardelername": "D" * 120},), ())
    entities.load_entity(feed, store, entities.DEALERS, DAY1)
    assert rows(store.read("ce_dealers").filter("dealer_id > 0"), "dealer_name") == [("D" * 100,)]
    sales.load_sales(feed, store, DAY1)
    assert store.read("ce_sales").first().dealer_id == -1


def test_new_sales_only(spark, store):
    sales.load_sales(feeds.feed(spark, ({},), ({},)), store, DAY1)
    grown = feeds.feed(spark, ({}, {"id": "300"}), ({}, {"id": "300"}))
    assert sales.load_sales(grown, store, DAY2) == {"Inserted": 1}
    assert rows(store.read("ce_sales"), "sale_id", "source_id", "insert_dt") == [
        (1, "OFFLINE_100", DAY1), (2, "ONLINE_900", DAY1), (3, "OFFLINE_300", DAY2)]


def test_sales_with_sliced_joins_are_the_same(spark, store, monkeypatch):
    feed = feeds.feed(spark, OFFLINE_ROWS, ONLINE_ROWS)
    expected = rows(sales.sales_to_load(feed, store))
    monkeypatch.setattr("lotbook.operators.lookup.BROADCAST_ROWS", 0)
    assert rows(sales.sales_to_load(feed, store)) == expected


def test_sales_loads_leave_no_intermediates(spark, monkeypatch):
    """Loads by broadcasts and by shuffles number the same rows, and what they wrote on the way is gone."""
    feed, found = feeds.feed(spark, OFFLINE_ROWS * 3, ONLINE_ROWS * 2), []
    for limit in (100_000, 0):
        store = Store.temporary(spark)
        entities.load_customers(feed, store, DAY1)
        monkeypatch.setattr("lotbook.operators.lookup.BROADCAST_ROWS", limit)
        here = Path(store.root.removeprefix("file:")).parent
        before = set(os.listdir(here))
        assert sales.load_sales(feed, store, DAY1) == {"Inserted": 8} and sales.load_sales(feed, store, DAY2) == {"Inserted": 0}
        assert set(os.listdir(here)) == before
        found.append(rows(store.read("ce_sales")))
        assert {r[3] for r in found[-1]} == {-1, 1, 2}
    assert found[0] == found[1]


def test_customer_paths_are_told_apart(spark):
    """NULL, an empty text and a text like the mark of NULL; texts that run into the next column."""
    texts = [None, "", "-", "1:a", "a", "é", "a-"]
    n = len(sales.CUSTOMER_PATH) - 2
    data = [(one, other, *["x"] * n) for one in texts for other in texts]
    paths = spark.createDataFrame(data, ", ".join(f"{c} string" for c in sales.CUSTOMER_PATH))
    assert paths.select(sales.path_mark()).distinct().count() == len(data) == 49


def test_fact_period_is_replaced_or_emptied(spark, store):
    feed = feeds.feed(spark, ({}, {"id": "101", "date": "2022-12-24"}), ())
    entities.load_dates(store, DAY1)
    dimensions.load_dim_dates(store, DAY1)
    sales.load_sales(feed, store, DAY1)
    periods = [Period("2022_Q2", 4500, 4594), Period("2022_Q4", 4687, 4777)]
    assert sales.load_fact(store, DAY1, periods) == {"2022_Q2": 1, "2022_Q4": 1}
    assert sales.load_fact_period(store, DAY2, 4500, 4593, "2022_Q2") == {"2022_Q2": 1}
    assert rows(store.read("fct_sales"), "sales_period", "insert_dt") == [("2022_Q2", DAY2), ("2022_Q4", DAY1)]
    assert sales.load_fact_period(store, DAY2, 1, 2, "2022_Q2") == {"2022_Q2": 0}
    assert rows(store.read("fct_sales"), "sales_period") == [("2022_Q4",)]
    wrong = [Period("2022_Q4", 4500, 4501)]
    assert quality.outside_period(store.read("fct_sales"), wrong).count() == 1
    assert quality.outside_period(store.read("fct_sales"), periods).count() == 0


def test_periods_are_half_open_and_must_not_overlap(spark):
    days = spark.createDataFrame([(4499,), (4500,), (4593,), (4594,), (5299,), (5300,), (-1,)], "date_id bigint")
    assert rows(within_periods(days, DEFAULT_PERIODS)) == [
        (4500, "2022_Q2"), (4593, "2022_Q2"), (4594, "2022_Q3"), (5299, "2024_Q2")]
    with pytest.raises(ValueError, match="overlap"):
        check_periods([Period("a", 1, 5), Period("b", 4, 6)])


def test_percent_of(spark):
    frame = spark.createDataFrame(
        [(Decimal("200.00"), Decimal("0.10")), (None, Decimal("1.00")), (Decimal("5.00"), None)],
        "price decimal(12,2), rate decimal(5,2)")
    price, rate = F.col("price"), F.col("rate")
    assert [r[0] for r in frame.select(percent_of(price, rate)).collect()] == [
        Decimal("0.20"), Decimal("0.00"), Decimal("0.00")]
    assert frame.select(percent_of(price, rate, rate_is_fraction=True)).first()[0] == Decimal("20.00")


def test_calendar_numbers_and_growth(spark, store):
    assert build_calendar(spark).count() == 7670
    entities.load_dates(store, DAY1, dt.date(2020, 1, 1), dt.date(2020, 1, 31))
    grown = entities.load_dates(store, DAY2, dt.date(2020, 1, 15), dt.date(2020, 3, 1), dt.date(2020, 1, 1))
    assert grown == {"New rows": 30, "Default rows": 0}
    assert rows(store.read("ce_dates").filter("date = '2020-03-01'"), "date_id", "quarter") == [(61, 1)]
    with pytest.raises(ValueError, match="below 1"):
        build_calendar(spark, dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2020, 1, 1))


def test_failed_loads_are_logged_and_raised(spark, store):
    log = AuditLog(store)
    with pytest.raises(RuntimeError, match="no feed"), log.together():
        with log.loading("LOAD_X") as note:
            note.report("x", {"New rows": 2})
        with log.loading("LOAD_Y"):
            raise RuntimeError("no feed")
    assert rows(store.read("log_table"), "procedure_name", "rows_affected", "log_message", "status") == [
        ("LOAD_X", 2, "Successfully loaded x. New rows: 2", "Success"), ("LOAD_Y", -1, "Error: no feed", "Error")]


def test_failed_logging_leaves_a_trace(store, monkeypatch):
    log, append = AuditLog(store), store.append
    calls = []

    def flaky(table, frame):
        calls.append(table)
        if len(calls) == 1:
            raise OSError("disk full")
        append(table, frame)

    monkeypatch.setattr(store, "append", flaky)
    log.write("LOAD_X", 5, "fine", "Success")
    assert rows(store.read("log_table"), "rows_affected", "log_message", "status") == [
        (-1, "Logging failed: disk full", "Error")]


def test_quality_checks_return_rows(spark):
    frame = spark.createDataFrame(
        [(1, "Y", "ab"), (1, "N", "abc"), (2, "Q", None), (None, None, "x"), (None, "Y", "x")],
        "id int, flag string, text string")
    assert rows(quality.duplicates(frame, ["id"])) == [(1, 2)]
    assert quality.duplicates(frame, ["id", "flag"]).count() == 0
    assert quality.missing(frame, ["id", "text"]).count() == 3
    assert rows(quality.outside_domain(frame, "flag", ("Y", "N")), "flag") == [("Q",)]
    assert rows(quality.too_long(frame, "text", 2), "text") == [("abc",)]
    parent = spark.createDataFrame([(1,)], "key int")
    assert rows(quality.orphans(frame, "id", parent, "key"), "id") == [(2,)]


def test_only_lookups_beyond_a_broadcast_are_sketched(spark, store, monkeypatch):
    feed, asked = feeds.feed(spark, OFFLINE_ROWS, ONLINE_ROWS), []

    class Listed(sales.HotKeys):
        def __init__(self, rows, keysets, *options):
            asked.append(set(keysets))
            super().__init__(rows, keysets, *options)

    monkeypatch.setattr(sales, "HotKeys", Listed)
    sales.load_sales(feed, store, DAY1)
    assert asked == [{"_sale"}]
    monkeypatch.setattr("lotbook.operators.lookup.BROADCAST_ROWS", 0)
    assert sales.load_sales(feed, store, DAY2) == {"Inserted": 0}
    assert asked[1] >= {"_sale", "loaded", "customer"}

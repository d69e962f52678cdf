import datetime as dt

import pytest
from pyspark.sql import functions as F

from lotbook.operators.insert_only import load_insert_only
from lotbook.operators.scd2 import (
    conflicting_keys,
    detect_versions,
    mirror_scd2,
    one_row_per_key,
    scd2_merge,
    tracked_digest,
)
from lotbook.operators.upsert import upsert_type1
from lotbook.schemas import TABLES
from lotbook.sources import store as stores
from lotbook.sources.store import Store, digest
from tests.conftest import rows
from tests.test_plans import scanned

DAY1, DAY2, DAY3 = dt.date(2024, 1, 10), dt.date(2024, 2, 10), dt.date(2024, 3, 10)
OPEN = dt.date(9999, 12, 31)
SCHEMA = ("customer_src_id string, customer_first_name string, customer_last_name string, customer_email string, "
          "customer_telephone_number string, address_id bigint, source_system string, source_entity string")


def snapshot(spark, **phones):
    data = [(key, key, "n. a.", f"{key}@x", phone, 1, "S", "E") for key, phone in phones.items()]
    return spark.createDataFrame(data, SCHEMA)


def merge(store, frame, day):
    return scd2_merge(store, "ce_customers_sdc", frame, day)


def versions(store):
    return rows(store.read("ce_customers_sdc").filter("customer_id > 0"), "customer_id", "customer_src_id",
                "customer_telephone_number", "start_dt", "end_dt", "is_active")


def test_scd2_over_three_snapshots(spark, store):
    assert merge(store, snapshot(spark, A="1", B="2"), DAY1) == {
        "New customers": 2, "SCD Old Updated": 0, "SCD New Versions": 0, "Default rows": 1}
    assert merge(store, snapshot(spark, A="9", B="2", C="3"), DAY2) == {
        "New customers": 1, "SCD Old Updated": 1, "SCD New Versions": 1, "Default rows": 0}
    assert versions(store) == [
        (1, "A", "1", DAY1, dt.date(2024, 2, 9), "N"), (2, "B", "2", DAY1, OPEN, "Y"),
        (3, "C", "3", DAY2, OPEN, "Y"), (4, "A", "9", DAY2, OPEN, "Y"),
    ]
    merge(store, snapshot(spark, A="9", C="4"), DAY3)
    assert versions(store)[4] == (5, "C", "4", DAY3, OPEN, "Y")
    assert versions(store)[2] == (3, "C", "3", DAY2, dt.date(2024, 3, 9), "N")
    assert merge(store, snapshot(spark, A="9", C="4"), DAY3)["New customers"] == 0
    assert len(versions(store)) == 5


def test_closing_leaves_the_update_date(spark, store):
    merge(store, snapshot(spark, A="1"), DAY1)
    merge(store, snapshot(spark, A="2"), DAY2)
    assert rows(store.read("ce_customers_sdc").filter("customer_id = 1"), "is_active", "update_dt") == [("N", DAY1)]


def test_closed_keys_are_not_opened_again(spark, store):
    merge(store, snapshot(spark, A="1", B="1"), DAY1)
    closed = store.read("ce_customers_sdc").withColumn(
        "is_active", F.when(F.col("customer_src_id") == "A", "N").otherwise(F.col("is_active")))
    store.replace("ce_customers_sdc", closed)
    merge(store, snapshot(spark, A="5"), DAY2)
    assert [v[1] for v in versions(store)] == ["A", "B"]


def test_untracked_address_makes_no_version(spark, store):
    merge(store, snapshot(spark, A="1"), DAY1)
    moved = snapshot(spark, A="1").withColumn("address_id", F.lit(2).cast("bigint"))
    assert merge(store, moved, DAY2)["SCD New Versions"] == 0


def test_one_row_per_key_and_conflicts(spark):
    frame = snapshot(spark, A="1").union(snapshot(spark, A="7")).union(snapshot(spark, A="3", B="1"))
    single = one_row_per_key(frame, "customer_src_id", ["customer_telephone_number"])
    assert rows(single, "customer_src_id", "customer_telephone_number") == [("A", "7"), ("B", "1")]
    assert rows(conflicting_keys(frame, "customer_src_id")) == [("A", 3)]


def flat(spark, *data):
    """Customer versions: id, phone, country, start, end, active."""
    attributes = ", ".join(f"{c} string" for c in TABLES["dim_customers_sdc"].tracked)
    schema = (f"customer_id bigint, customer_src_id string, {attributes}, start_dt date, end_dt date, "
              "is_active string, source_system string, source_entity string")
    return spark.createDataFrame(
        [(i, str(i), "F", "L", "E", phone, country, None, "C", "S", "B", "P", start, end, active, "BL_3NF", "X")
         for i, phone, country, start, end, active in data], schema)


def mirror(store, frame, day):
    return mirror_scd2(store, "dim_customers_sdc", frame, day, ["customer_id"])


def dim(store):
    return rows(store.read("dim_customers_sdc").filter("customer_surr_id > 0"), "customer_surr_id", "customer_src_id",
                "customer_country", "end_dt", "is_active", "update_dt")


def test_mirror_carries_closings_and_is_repeatable(spark, store):
    first = flat(spark, (1, "p", "NO", DAY1, OPEN, "Y"), (2, "q", "SE", DAY1, OPEN, "Y"))
    second = flat(spark, (1, "p", "NO", DAY1, DAY2, "N"), (2, "q", "SE", DAY1, OPEN, "Y"),
                  (3, "r", "NO", DAY2, OPEN, "Y"))
    assert mirror(store, first, DAY1) == {"Inserted": 2, "Closed": 0, "Default rows": 1}
    assert mirror(store, first, DAY2) == {"Inserted": 0, "Closed": 0, "Default rows": 0}  # NULL state is no change
    assert mirror(store, second, DAY2) == {"Inserted": 1, "Closed": 1, "Default rows": 0}
    expected = [(1, "1", "NO", DAY2, "N", DAY2), (2, "2", "SE", OPEN, "Y", DAY1), (3, "3", "NO", OPEN, "Y", DAY2)]
    assert dim(store) == expected
    mirror(store, second, DAY3)
    assert dim(store) == expected


def test_mirror_reopens_a_version_with_other_attributes(spark, store):
    mirror(store, flat(spark, (1, "p", "NO", DAY1, OPEN, "Y")), DAY1)
    changed = flat(spark, (1, "p", "DK", DAY1, OPEN, "Y"))
    assert mirror(store, changed, DAY2) == {"Inserted": 1, "Closed": 1, "Default rows": 0}
    expected = [(1, "1", "NO", dt.date(2024, 2, 9), "N", DAY2), (2, "1", "DK", OPEN, "Y", DAY2)]
    assert dim(store) == expected
    mirror(store, changed, DAY3)
    assert dim(store) == expected


def dealers(spark, **names):
    data = [(int(i[1:]), i[1:], name, "BL_3NF", "CE_DEALERS") for i, name in names.items()]
    return spark.createDataFrame(
        data, "dealer_id bigint, dealer_src_id string, dealer_name string, source_system string, source_entity string")


def upsert(store, frame, day):
    return upsert_type1(store, "dim_dealers", frame, day, ["dealer_id"])


def test_upsert_touches_changed_rows_only(spark, store):
    assert upsert(store, dealers(spark, d1="A", d2="B", d3=None), DAY1) == {
        "Inserted": 3, "Updated": 0, "Default rows": 1}
    assert upsert(store, dealers(spark, d1="A", d2="X", d3=None, d10="N"), DAY2) == {
        "Inserted": 1, "Updated": 1, "Default rows": 0}
    assert rows(store.read("dim_dealers").filter("dealer_surr_id > 0"), "dealer_surr_id", "dealer_src_id",
                "dealer_name", "insert_dt", "update_dt") == [
        (1, "1", "A", DAY1, DAY1), (2, "2", "X", DAY1, DAY2), (3, "3", None, DAY1, DAY1), (4, "10", "N", DAY2, DAY2)]
    assert upsert(store, dealers(spark, d1="A", d2="X", d10="N"), DAY3) == {
        "Inserted": 0, "Updated": 0, "Default rows": 0}


@pytest.mark.parametrize("known_rows", [None, 10])
def test_insert_only_never_changes_rows(spark, store, known_rows):
    def frame(*names):
        data = [(n, n.lower(), "S", "E") for n in names]
        return spark.createDataFrame(
            data, "country_src_id string, country_name string, source_system string, source_entity string")

    assert load_insert_only(store, "ce_countries", frame("B", "C"), DAY1, known_rows) == {
        "New rows": 2, "Default rows": 1}
    again = frame("B", "A", "C").withColumn("country_name", F.lit("other"))
    assert load_insert_only(store, "ce_countries", again, DAY2, known_rows) == {"New rows": 1, "Default rows": 0}
    assert rows(store.read("ce_countries"), "country_id", "country_src_id", "country_name", "insert_dt") == [
        (-1, "n. a.", "n. a.", DAY1), (1, "B", "b", DAY1), (2, "C", "c", DAY1), (3, "A", "other", DAY2)]
    files = len(store.read("ce_countries").inputFiles())
    load_insert_only(store, "ce_countries", again, DAY3, known_rows)
    assert len(store.read("ce_countries").inputFiles()) == files


def folders(store, table):
    """Data files by folder."""
    found = {}
    for file in store.read(table).inputFiles():
        folder, _, name = file.rpartition("/")
        found.setdefault(folder.partition("/data/")[2], set()).add(name)
    return found


@pytest.fixture
def bucketed(spark, monkeypatch):
    monkeypatch.setattr(stores, "BUCKET_ROWS", 4)
    return Store.temporary(spark)


def test_only_touched_buckets_are_written(spark, bucketed):
    """A closed version rewrites the active rows of its bucket; all other files stay as they are."""
    names = {f"K{i}": "1" for i in range(40)}
    merge(bucketed, snapshot(spark, **names), DAY1)
    before = folders(bucketed, "ce_customers_sdc")
    assert len(before) > 8
    assert merge(bucketed, snapshot(spark, K3="2", NEW="1"), DAY2)["SCD New Versions"] == 1
    after = folders(bucketed, "ce_customers_sdc")
    gone, added = set(before) - set(after), set(after) - set(before)
    assert len(gone) == 1 and 2 <= len(added) <= 3
    assert all(after[f] == before[f] for f in set(before) & set(after))
    assert {f.split("/")[1] for f in gone} == {"is_active=Y"}
    got = versions(bucketed)
    assert len(got) == 42 and [v[1:] for v in got if v[1] == "K3"] == [
        ("K3", "1", DAY1, dt.date(2024, 2, 9), "N"), ("K3", "2", DAY2, OPEN, "Y")]
    assert bucketed.rows("ce_customers_sdc") == bucketed.read("ce_customers_sdc").count() == 43


def test_mirror_and_upsert_leave_other_buckets_alone(spark, bucketed):
    data = [(i, "p", "NO", DAY1, OPEN, "Y") for i in range(1, 41)]
    mirror(bucketed, flat(spark, *data), DAY1)
    before = folders(bucketed, "dim_customers_sdc")
    data[6] = (7, "p", "NO", DAY1, DAY2, "N")
    assert mirror(bucketed, flat(spark, *data), DAY2) == {"Inserted": 0, "Closed": 1, "Default rows": 0}
    after = folders(bucketed, "dim_customers_sdc")
    assert len(set(before) - set(after)) == 1 and len(dim(bucketed)) == 40
    assert [d for d in dim(bucketed) if d[1] == "7"] == [(7, "7", "NO", DAY2, "N", DAY2)]

    upsert(bucketed, dealers(spark, **{f"d{i}": "A" for i in range(1, 41)}), DAY1)
    before = folders(bucketed, "dim_dealers")
    assert upsert(bucketed, dealers(spark, d5="B"), DAY2)["Updated"] == 1
    after = folders(bucketed, "dim_dealers")
    assert len(set(before) - set(after)) == len(set(after) - set(before)) == 1
    assert rows(bucketed.read("dim_dealers").filter("update_dt = '2024-02-10'"), "dealer_src_id", "dealer_name") == [
        ("5", "B")]


def test_growth_and_many_commits_keep_the_rows(spark, bucketed, monkeypatch):
    """Buckets are split as the table grows and their folders merged after many commits; a new store finds it all."""
    monkeypatch.setattr(stores, "MOST_FOLDERS", 3)
    for day in range(1, 9):
        merge(bucketed, snapshot(spark, **{f"K{i}": str(day % 3) for i in range(6 * day)}), dt.date(2024, 5, day))
    again = Store(spark, bucketed.root, "bucketed_again")
    for one in (bucketed, again):
        assert len(versions(one)) == sum(6 * day for day in range(1, 9))
        active = one.read("ce_customers_sdc").filter("is_active = 'Y' AND customer_id > 0")
        assert active.count() == active.select("customer_src_id").distinct().count() == 48
        assert {v[2] for v in versions(one) if v[5] == "Y"} == {str(8 % 3)}
    name = bucketed.name("ce_customers_sdc")
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == bucketed.rows("ce_customers_sdc")
    folders_of = folders(bucketed, "ce_customers_sdc")
    counts = {}
    for folder in folders_of:
        place = folder.partition("/")[2]
        counts[place] = counts.get(place, 0) + 1
    assert max(counts.values()) <= 4


def test_a_failed_commit_changes_nothing(spark, bucketed, monkeypatch):
    merge(bucketed, snapshot(spark, A="1", B="1"), DAY1)
    before = versions(bucketed)
    monkeypatch.setattr(bucketed, "_point", lambda table, folder: (_ for _ in ()).throw(RuntimeError("no")))
    with pytest.raises(RuntimeError):
        merge(bucketed, snapshot(spark, A="2"), DAY2)
    assert versions(bucketed) == before == versions(Store(spark, bucketed.root, "bucketed_after"))


def test_changes_are_found_by_key_and_digest(spark, bucketed):
    merge(bucketed, snapshot(spark, A="1", B="1"), DAY1)
    spec = TABLES["ce_customers_sdc"]
    found = detect_versions(bucketed.read_parts(spec.name), snapshot(spark, A="2", B="1"), spec.src_col,
                            tracked_digest(spec))
    assert rows(found, "customer_src_id", "change") == [("A", "version")]
    read = set().union(*scanned(found)) & set(spec.columns)
    assert read == {"customer_src_id"}  # the active flag is a folder's
    assert digest([F.lit(None), F.lit("a")])._jc.toString() != digest([F.lit("a"), F.lit(None)])._jc.toString()
    pairs = spark.createDataFrame([(None, "a"), ("a", None), ("", "a"), ("a", "")], "x string, y string")
    assert pairs.select(digest([F.col("x"), F.col("y")])).distinct().count() == 4

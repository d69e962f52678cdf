"""The sales fact of the entity layer and of the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.functions.casts import safe_date, safe_number
from lotbook.functions.text import cut, is_filled, key_part, prefixed
from lotbook.operators.audit import AuditLog
from lotbook.operators.insert_only import next_id, not_in_table, with_stamps
from lotbook.operators.lookup import HotKeys, beyond_broadcast, fits_broadcast, lookup_join, resolve
from lotbook.operators.measures import MONEY, percent_of
from lotbook.operators.merge import prefer_primary
from lotbook.operators.periods import DEFAULT_PERIODS, Period, check_periods, uncovered, within_periods
from lotbook.operators.surrogate import Numbered, assign_surrogate
from lotbook.plans import entities as e
from lotbook.schemas import DEFAULT_ID, TABLES
from lotbook.sources.feeds import LINEAGE, OFFLINE, ONLINE, is_offline
from lotbook.sources.scratch import passing, save_counted
from lotbook.sources.store import Store

# What decides a customer: the lookup chain over it runs once per distinct value, not once per sale.
CUSTOMER_PATH = tuple(c for c in e.CUSTOMERS.inputs if c != "phone")
LOADED_KEY = ["sale_src_id", "source_id"]
_SALE_IDS = ("customer_id", "employee_id", "car_id", "dealer_id", "date_id", "sales_channel_id",
             "payment_method_id")
_MEASURES = {
    "sale_price": ("price", MONEY),
    "commission_rate": ("commission_rate", "decimal(20,18)"),
    "commission_earned": ("commission_earned", MONEY),
    "reduction_percent": ("reduction_percent", "decimal(5,2)"),
    "income": ("income", MONEY),
}
# Sales are numbered by date first: the files are then clustered by date and range reads skip most of them.
SALE_ORDER = ("date_id", "sale_src_id", "source_id", *[c for c in _SALE_IDS if c != "date_id"], *_MEASURES)


def customer_ids(people: DataFrame, store: Store) -> DataFrame:
    """Customer id per distinct customer path, -1 where no active customer has that key.

    ``people`` is the feed, or a customer profile of it that may already have the address ids.
    """
    known = ["address_id"] if "address_id" in people.columns else []
    paths = e.with_parents(people.select(*CUSTOMER_PATH, *known).distinct(), store, e.CUSTOMERS)
    return e.resolve_entity(paths, store, e.CUSTOMERS, active_only=True).select(*CUSTOMER_PATH, "customer_id")


def path_mark() -> Column:
    """16 bytes of SHA-256 that stand for a customer path, NULLs included: sales are joined by it, not by the texts."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in CUSTOMER_PATH]
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def _sale_keys() -> list[Column]:
    """Id of a sale in its feed, and the id that also tells the feed."""
    source_id = F.when(is_offline(), prefixed(OFFLINE.sale_prefix, F.col("id"))).otherwise(
        prefixed(ONLINE.sale_prefix, F.col("id"))
    )
    return [cut(F.col("id"), 50).alias("sale_src_id"), cut(source_id, 100).alias("source_id")]


def sale_rows(feed: DataFrame, slash_format: str = "MM/dd/yyyy") -> DataFrame:
    """Sales with guarded measures and the texts their references are looked up by."""
    return feed.filter(is_filled(F.col("id"))).select(
        F.col("id").alias("_sale"),
        *_sale_keys(),
        path_mark().alias("_customer"),
        key_part(F.col("employee_id")).alias("_employee"),
        e.CARS.key().alias("_car"),
        F.col("dealer").alias("_dealer"),
        safe_date(F.col("sale_date"), slash_format).alias("_date"),
        F.col("channel").alias("_channel"),
        F.col("payment_method").alias("_payment"),
        *[safe_number(F.col(c), kind).alias(name) for name, (c, kind) in _MEASURES.items()],
        *LINEAGE,
    )


# Text of a sale -> the entity it refers to; None stands for the calendar.
_REFERENCES: dict[str, e.Entity | None] = {
    "_dealer": e.DEALERS, "_channel": e.SALES_CHANNELS, "_payment": e.PAYMENT_METHODS, "_car": e.CARS,
    "_employee": e.EMPLOYEES, "_date": None,
}


def _reference_table(text: str) -> str:
    entity = _REFERENCES[text]
    return "ce_dates" if entity is None else entity.table


def with_references(sales: DataFrame, store: Store, texts: Sequence[str], hot: HotKeys) -> DataFrame:
    """Sales with ids instead of the given texts."""
    for text in texts:
        table = _reference_table(text)
        members, key = store.read(table), TABLES[table].src_col
        if _REFERENCES[text] is not None:
            members = members.filter(F.col("source_system").isin(*e.FEED_SYSTEMS))
        sales = resolve(sales, members, F.col(text), key, TABLES[table].id_col, known_rows=store.rows(table),
                        hot=(hot, text)).drop(text)
    return sales


def resolved_sales(
    feed: DataFrame, store: Store, slash_format: str = "MM/dd/yyyy", people: DataFrame | None = None
) -> tuple[DataFrame, bool]:
    """The rows of :func:`sales_to_load`, of which equal ones may be left, and whether frequent ones are left out."""
    texts = sale_rows(feed, slash_format)
    # The chain of six lookups runs on the distinct customer paths; a sale needs one join.
    ids = customer_ids(feed if people is None else people, store).select(path_mark().alias("_customer"), "customer_id")
    customers, paths = save_counted(ids, "customer-ids", lean=True)
    # One pass finds the frequent keys of all joins that are too large for a broadcast, and of no others.
    tables = {text: _reference_table(text) for text in _REFERENCES} | {"loaded": "ce_sales"}
    keysets = {name: LOADED_KEY if name == "loaded" else [name] for name, table in tables.items()
               if beyond_broadcast(store.rows(table))}
    shuffled = beyond_broadcast(paths) or not fits_broadcast(customers, known_rows=paths, free_text=True)
    if shuffled:
        keysets["customer"] = ["_customer"]
    hot = HotKeys(texts, {"_sale": ["_sale"], **keysets})
    # Lookups by a broadcast come first: ids are narrower than texts where rows have to be shuffled. Rows that are not
    # wanted go next, by their id alone; where few keys decide that, the engine moves it in front of the lookups.
    near = with_references(texts, store, [text for text in _REFERENCES if text not in keysets], hot)
    offline_ids = feed.filter(is_offline()).select(F.col("id").alias("_sale"))
    wanted = prefer_primary(near.filter(is_offline()), near.filter(~is_offline()), offline_ids, "_sale",
                            hot=(hot, "_sale"), keys_first=True).drop("_sale")
    sales = not_in_table(wanted, store, "ce_sales", LOADED_KEY, hot=(hot, "loaded"), keys_first=True)
    sales = with_references(sales, store, [text for text in _REFERENCES if text in keysets], hot)
    sales = lookup_join(sales, customers, ["_customer"], known_rows=paths, hot=(hot, "customer"), free_text=True,
                        distinct=True)
    return sales.select("sale_src_id", "source_id", *_SALE_IDS, *_MEASURES, *LINEAGE), shuffled


def sales_to_load(
    feed: DataFrame, store: Store, slash_format: str = "MM/dd/yyyy", people: DataFrame | None = None
) -> DataFrame:
    """Distinct sales with all seven references resolved, without sales already loaded.

    ``people`` is a customer profile of the feed, if one is at hand. An online sale is left out if the offline
    feed has its id. An employee id with two spellings of the name
    gives one row per spelling.
    """
    return resolved_sales(feed, store, slash_format, people)[0].distinct()


def load_sales(
    feed: DataFrame, store: Store, load_dt: dt.date, slash_format: str = "MM/dd/yyyy",
    people: DataFrame | None = None,
) -> dict[str, int]:
    with passing(store.spark):
        fresh, spread = resolved_sales(feed, store, slash_format, people)
        # Equal rows meet in the shuffle that numbers them. One for them alone is only needed where a row may be so
        # frequent that it would burden a task.
        numbered = assign_surrogate(fresh if spread else fresh.distinct(), "sale_id", SALE_ORDER,
                                    start=next_id(store, "ce_sales"), once=True, distinct=spread, lean=True)
        if numbered.total:
            before = store.rows("ce_sales")
            store.append("ce_sales", with_stamps(numbered.rows, load_dt))
            store.set_rows("ce_sales", before + numbered.total)
    return {"Inserted": numbered.total}


MOST_RUNS = 100_000  # runs of sale ids that are broadcast at most
FIRST_SALE_NUMBER = 2  # fixed value: numbering starts here in every period
# Fact reference -> (dimension, its key, entity id on the sale).
STAR = {
    "customer_surr_id": ("dim_customers_sdc", "customer_src_id", "customer_id"),
    "employee_surr_id": ("dim_employees", "employee_src_id", "employee_id"),
    "car_surr_id": ("dim_cars", "car_src_id", "car_id"),
    "dealer_surr_id": ("dim_dealers", "dealer_src_id", "dealer_id"),
    "date_surr_id": ("dim_dates", "date_surr_id", "date_id"),
    "payment_method_surr_id": ("dim_payment_methods", "payment_method_src_id", "payment_method_id"),
    "sales_channel_surr_id": ("dim_sales_channels", "sales_channel_src_id", "sales_channel_id"),
}


def star_rows(sales: DataFrame, store: Store) -> DataFrame:
    """Sales with dimension surrogates instead of entity ids; references without a member become -1."""
    for surrogate, (table, key, entity_id) in STAR.items():
        members = store.read(table).select(F.col(key).cast("bigint").alias(entity_id),
                                           F.col(TABLES[table].id_col).alias(surrogate))
        if table == "dim_customers_sdc":  # a version that was reopened has an older, closed row as well
            members = members.groupBy(entity_id).agg(F.max(surrogate).alias(surrogate))
        sales = lookup_join(sales, members, [entity_id], known_rows=store.rows(table)).withColumn(
            surrogate, F.coalesce(F.col(surrogate), F.lit(DEFAULT_ID).cast("bigint"))
        )
    return sales.drop(*[entity_id for _, _, entity_id in STAR.values()])


def fact_rows(store: Store, periods: Sequence[Period], rate_is_fraction: bool = False) -> DataFrame:
    """Star rows of the periods with derived measures, before numbering."""
    sales = within_periods(store.read("ce_sales"), periods).drop("insert_dt", "update_dt", *LINEAGE)
    return (
        star_rows(sales, store)
        .withColumn("calc_discount_value",
                    percent_of(F.col("sale_price"), F.col("reduction_percent"), rate_is_fraction))
        .withColumn("calc_commission_check",
                    percent_of(F.col("sale_price"), F.col("commission_rate"), rate_is_fraction))
        .withColumn("source_system", F.lit("BL_3NF"))
        .withColumn("source_entity", F.lit("CE_SALES"))
    )


def sale_runs(store: Store, periods: Sequence[Period]) -> list[tuple[str, int, int, int]] | None:
    """Unbroken runs of sale ids within each period: period, first and last id, and the period's rows before the run.

    A load numbers its sales by date, so a period's sales of one load have neighbouring ids. One pass over two columns
    of ``ce_sales`` counts them per file; the driver joins files that go on from each other, which leaves about one run
    for each load. None if some file has gaps or files overlap.
    """
    sales = within_periods(store.read("ce_sales").select("*", F.col("_metadata.file_path").alias("_file")), periods)
    counted = sales.groupBy("sales_period", "_file").agg(
        F.min("sale_id").alias("first"), F.max("sale_id").alias("last"), F.count("*").alias("n")).collect()
    runs: list[tuple[str, int, int, int]] = []
    for row in sorted(counted, key=lambda r: (r["sales_period"], r["first"])):
        period, first, last, n = row["sales_period"], row["first"], row["last"], row["n"]
        before = runs[-1] if runs and runs[-1][0] == period else None
        if n != last - first + 1 or before and first <= before[2]:
            return None
        if before and first == before[2] + 1:
            runs[-1] = (period, before[1], last, before[3])
        else:
            runs.append((period, first, last, before[3] + before[2] - before[1] + 1 if before else 0))
    return runs


def numbered_fact(store: Store, periods: Sequence[Period], rate_is_fraction: bool = False) -> Numbered:
    """Fact rows numbered from ``FIRST_SALE_NUMBER`` by ascending sale id in each period.

    Where sale ids have few runs, a row's number follows from its sale id alone, without a sort; the list of runs is
    broadcast. Otherwise rows are sorted.
    """
    rows = fact_rows(store, periods, rate_is_fraction)
    runs = sale_runs(store, periods)
    if runs is None or len(runs) > MOST_RUNS:
        return assign_surrogate(rows, "sale_surr_id", ["sale_id"], start=FIRST_SALE_NUMBER, within=["sales_period"],
                                once=True, lean=True)
    counts = {}
    for period, first, last, before in runs:
        counts[period,] = before + last - first + 1
    listed = store.spark.createDataFrame(
        [(period, first, last, FIRST_SALE_NUMBER + before - first) for period, first, last, before in runs],
        "_period string, _first bigint, _last bigint, _shift bigint")
    own = (F.col("sales_period") == F.col("_period")) & F.col("sale_id").between(F.col("_first"), F.col("_last"))
    numbered = rows.join(F.broadcast(listed), own).withColumn("sale_surr_id", F.col("sale_id") + F.col("_shift"))
    return Numbered(numbered.drop("_period", "_first", "_last", "_shift"), counts)


def load_fact(
    store: Store, load_dt: dt.date, periods: Sequence[Period] = DEFAULT_PERIODS, rate_is_fraction: bool = False
) -> dict[str, int]:
    """Recompute the given periods in one job and replace them; rows per period."""
    check_periods(periods)
    with passing(store.spark):
        numbered = numbered_fact(store, periods, rate_is_fraction)
        counts = {name: n for (name,), n in numbered.counts.items()}
        store.overwrite_partitions(
            "fct_sales", with_stamps(numbered.rows, load_dt), [p.name for p in periods], counts
        )
    return {p.name: counts.get(p.name, 0) for p in periods}


def load_fact_logged(
    store: Store, load_dt: dt.date, periods: Sequence[Period] = DEFAULT_PERIODS, rate_is_fraction: bool = False
) -> dict[str, int]:
    """:func:`load_fact` with a log row for each period, which tells its bounds and rows; an error gives one each too."""
    log = AuditLog(store)
    with log.together():
        try:
            counts = load_fact(store, load_dt, periods, rate_is_fraction)
        except Exception as problem:
            for p in periods:
                log.write("LOAD_FCT_SALES", -1, f"Error: {p.name}: {problem}", "Error")
            raise
        for p in periods:
            log.write("LOAD_FCT_SALES", counts[p.name],
                      f"{p.name}: date ids {p.first_id} to {p.end_id - 1}, rows: {counts[p.name]}", "Success")
    return counts


def load_fact_period(store: Store, load_dt: dt.date, first_id: int, last_id: int, name: str) -> dict[str, int]:
    """Recompute one range of date ids, bounds included, and log it."""
    return load_fact_logged(store, load_dt, [Period(name, first_id, last_id + 1)])


def uncovered_sales(store: Store, periods: Sequence[Period] = DEFAULT_PERIODS) -> DataFrame:
    """Sales that no period takes."""
    return uncovered(store.read("ce_sales"), periods)

"""The driver queries: every operator over the provided tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import tpch_feed as tf
from lotbook.functions.casts import is_date_reject, safe_date, safe_number, safe_year
from lotbook.functions.text import attribute, joined, key_part, person_name, prefixed
from lotbook.operators import quality
from lotbook.operators.audit import AuditLog, log_history
from lotbook.operators.measures import MONEY
from lotbook.operators.periods import DEFAULT_PERIODS, Period
from lotbook.operators.scd2 import conflicting_keys
from lotbook.operators.upsert import upsert_type1
from lotbook.plans import dimensions, entities, sales
from lotbook.plans.warehouse import EntityLayer, load_dimensions, run_warehouse
from lotbook.schemas import ENTITIES
from lotbook.sources.feeds import CANONICAL, LINEAGE, OFFLINE, ONLINE, Feed, conform, is_offline, read_csv
from lotbook.sources.feeds import csv_rejects as read_rejects
from lotbook.sources.inbox import Inbox
from lotbook.sources.scratch import new_folder, save
from lotbook.sources.store import Store

Query = Callable[[SparkSession, str], DataFrame]
CHECKED_TABLES = (*[t.name for t in ENTITIES], "fct_sales")


# ---- feeds and scalar rules --------------------------------------------------------------------------------


def _csv_round_trip(spark: SparkSession, rows: DataFrame, feed: Feed) -> DataFrame:
    folder = new_folder(spark, "csv")
    rows.drop("order_day").write.mode("overwrite").options(
        sep=";", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(folder)
    return read_csv(spark, folder, feed)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offline feed written as delimited text and scanned back."""
    return _csv_round_trip(spark, tf.offline_feed(tf.sale_lines(spark, sf_dir)), OFFLINE)


def csv_scan_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The online feed written as delimited text and scanned back."""
    return _csv_round_trip(spark, tf.online_feed(tf.sale_lines(spark, sf_dir)), ONLINE)


def _rejects(spark: SparkSession, rows: DataFrame, feed: Feed) -> DataFrame:
    folder = new_folder(spark, "csv")
    tf.csv_lines(rows.drop("order_day")).write.mode("overwrite").text(folder)
    rejects = read_rejects(spark, folder, feed).select("problem")
    sound = read_csv(spark, folder, feed).select(F.lit("none").alias("problem"))
    return sound.unionByName(rejects).groupBy("problem").agg(F.count("*").alias("n_lines"))


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the offline feed, some of them broken: sound records and rejects by kind."""
    return _rejects(spark, tf.offline_feed(tf.sale_lines(spark, sf_dir)), OFFLINE)


def csv_rejects_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the online feed."""
    return _rejects(spark, tf.online_feed(tf.sale_lines(spark, sf_dir)), ONLINE)


def staged_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files of both feeds, staged one after the other: each run takes the new files only."""
    lines, found = tf.sale_lines(spark, sf_dir), []
    for feed, rows in ((OFFLINE, tf.offline_feed(lines)), (ONLINE, tf.online_feed(lines))):
        path = new_folder(spark, "inbox")
        inbox = Inbox(spark, path, feed, new_folder(spark, "staged"))
        for drop, condition in enumerate((F.col("order_day") < F.lit(tf.CUT_DATE), F.col("order_day") >= F.lit(tf.CUT_DATE)), 1):
            lines_of_drop = tf.as_text(rows.filter(condition).drop("order_day"))
            lines_of_drop.write.mode("append").option("compression", "snappy").text(path)
            inbox.stage()
            new = inbox.waiting()
            found.append(conform(inbox.rows(new), feed).withColumn("drop", F.lit(drop).cast("long")))
            inbox.done(new)
    return reduce(DataFrame.unionByName, found)


def staging_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.staged_feed(spark, sf_dir).select(*CANONICAL, *LINEAGE)


def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.unstaged(spark, sf_dir).feed.select(
        "id", "source_system",
        safe_number(F.col("price"), MONEY).alias("sale_price"),
        safe_number(F.col("commission_rate"), "decimal(20,18)").alias("commission_rate"),
        safe_number(F.col("commission_earned"), MONEY).alias("commission_earned"),
        safe_number(F.col("reduction_percent"), "decimal(5,2)").alias("reduction_percent"),
        safe_number(F.col("income"), MONEY).alias("income"),
        safe_year(F.col("year")).alias("car_year"),
        safe_date(F.col("sale_date")).alias("sale_day"),
    )


def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tf.unstaged(spark, sf_dir).feed.groupBy("source_system").agg(
        F.count("*").alias("n_sales"),
        F.count_if(is_date_reject(F.col("sale_date"))).alias("bad_dates"),
        F.count_if(safe_number(F.col("price"), MONEY).isNull()).alias("no_price"),
    )


def name_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = person_name(F.col("customer_name"))
    employee_first, employee_last = person_name(F.col("employee_name"))
    return tf.unstaged(spark, sf_dir).feed.select(
        "id", "source_system", first.alias("customer_first_name"), last.alias("customer_last_name"),
        employee_first.alias("employee_first_name"), employee_last.alias("employee_last_name"),
    )


def name_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that are missing, blank, of one word, with a double space, or of three words, by order number."""
    feed = tf.unstaged(spark, sf_dir).feed
    kind = F.split("id", "-")[0].cast("long") % 5
    name = (
        F.when(kind == 1, F.col("country")).when(kind == 2, F.lit(""))
        .when(kind == 3, F.concat("country", F.lit("  "), "brand"))
        .when(kind == 4, F.concat_ws(" ", "country", "model", "brand"))
    )
    first, last = person_name(F.col("_name"))
    return feed.withColumn("_name", name).select(
        "id", "source_system", first.alias("first_name"), last.alias("last_name"))


def long_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, street and model as one key, stored in 30 characters."""
    feed = tf.unstaged(spark, sf_dir).feed
    return quality.cut_keys(feed, joined("customer_name", "street", "model"), 30)


def key_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    building, postal = key_part(F.col("building")), key_part(F.col("postal"))
    return tf.unstaged(spark, sf_dir).feed.select(
        "id", "source_system",
        joined("state", F.lit(-1)).alias("state_key"),
        joined("street", F.lit(-1), building, postal).alias("address_key"),
        entities.CARS.key().alias("car_key"),
        attribute(F.col("building")).alias("building_number"),
        prefixed("S_", F.col("state")).alias("state_tag"),
    )


# ---- entity loads ------------------------------------------------------------------------------------------


def entity_load(entity: entities.Entity) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = Store.temporary(spark)
        entities.load_hierarchy(tf.unstaged(spark, sf_dir).feed, store, (*entity.parents, entity), tf.LOAD_DT)
        return store.read(entity.table)

    return query


def _customers(spark: SparkSession, sf_dir: str, *snapshots) -> Store:
    """Places from the whole feed, then one customer load per snapshot (a part of the feed, its load date)."""
    store = Store.temporary(spark)
    staged = tf.staged(spark, sf_dir)
    entities.load_hierarchy(staged.feed, store, entities.HIERARCHIES["location"], tf.LOAD_DT)
    for part, load_dt, after in snapshots:
        entities.load_customers(part(staged), store, load_dt)
        after(store, load_dt)
    return store


def _nothing(store: Store, load_dt) -> None:
    pass


def load_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _customers(spark, sf_dir, (lambda s: s.feed, tf.LOAD_DT, _nothing))
    return store.read("ce_customers_sdc")


_TWO_SNAPSHOTS = (
    (lambda s: s.before(tf.CUT_DATE), tf.LOAD_DT),
    (lambda s: s.since(tf.CUT_DATE), tf.NEXT_LOAD_DT),
)


def customers_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _customers(spark, sf_dir, *[(*snapshot, _nothing) for snapshot in _TWO_SNAPSHOTS])
    return store.read("ce_customers_sdc")


def dim_customers_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = [(*snapshot, dimensions.load_dim_customers) for snapshot in _TWO_SNAPSHOTS]
    return _customers(spark, sf_dir, *snapshots).read("dim_customers_sdc")


def customer_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store.temporary(spark)
    feed = tf.staged(spark, sf_dir).feed
    entities.load_hierarchy(feed, store, entities.HIERARCHIES["location"], tf.LOAD_DT)
    return conflicting_keys(entities.to_load(feed, store, entities.CUSTOMERS), "customer_src_id")


def incremental_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cars of the earlier sales first, then of the whole feed."""
    store = Store.temporary(spark)
    feeds = tf.unstaged(spark, sf_dir)
    levels = entities.HIERARCHIES["car"]
    entities.load_hierarchy(feeds.before(tf.CUT_DATE), store, levels, tf.LOAD_DT)
    entities.load_hierarchy(feeds.feed, store, levels, tf.NEXT_LOAD_DT)
    return store.read("ce_cars")


# ---- calendar ----------------------------------------------------------------------------------------------


def _calendar(spark: SparkSession, sf_dir: str) -> tuple[Store, DataFrame]:
    """The days the orders span, in two loads, and the number of sales per day."""
    orders = tf.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    first, last = orders.agg(F.min("day"), F.max("day")).first()
    store = Store.temporary(spark)
    entities.load_dates(store, tf.LOAD_DT, first, tf.CUT_DATE)
    entities.load_dates(store, tf.NEXT_LOAD_DT, first, last)
    per_day = (
        tf.sale_lines(spark, sf_dir).groupBy(F.col("order_day").alias("date"))
        .agg(F.count("*").alias("n_sales"))
    )
    return store, per_day


def _with_sales(dates: DataFrame, per_day: DataFrame) -> DataFrame:
    return dates.join(per_day, "date", "left").fillna(0, ["n_sales"])


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, per_day = _calendar(spark, sf_dir)
    return _with_sales(store.read("ce_dates"), per_day)


def dim_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, per_day = _calendar(spark, sf_dir)
    dimensions.load_dim_dates(store, tf.NEXT_LOAD_DT)
    return _with_sales(store.read("dim_dates"), per_day)


# ---- dimensions --------------------------------------------------------------------------------------------


def dimension_load(table: str, entity: entities.Entity) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = Store.temporary(spark)
        entities.load_hierarchy(tf.unstaged(spark, sf_dir).feed, store, (*entity.parents, entity), tf.LOAD_DT)
        dimensions.load_dimension(store, table, tf.LOAD_DT)
        return store.read(table)

    return query


def dim_cars_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store.temporary(spark)
    entities.load_hierarchy(tf.unstaged(spark, sf_dir).feed, store, entities.HIERARCHIES["car"], tf.LOAD_DT)
    return dimensions.cars(store)


def dim_upsert_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as dealers: some of them first, then all, with changed names for those in debt."""
    suppliers = tf.table(spark, sf_dir, "supplier")

    def members(name):
        return [F.col("s_suppkey"), F.col("s_suppkey").cast("string").alias("dealer_src_id"),
                name.alias("dealer_name"), F.lit("BL_3NF").alias("source_system"),
                F.lit("CE_DEALERS").alias("source_entity")]

    name = F.col("s_name")
    closed = F.when(F.col("s_acctbal") < 0, F.concat(name, F.lit(" (CLOSED)"))).otherwise(name)
    store = Store.temporary(spark)
    known = suppliers.filter("s_nationkey < 20").select(*members(name))
    upsert_type1(store, "dim_dealers", known, tf.LOAD_DT, ["s_suppkey"])
    upsert_type1(store, "dim_dealers", suppliers.select(*members(closed)), tf.NEXT_LOAD_DT, ["s_suppkey"])
    return store.read("dim_dealers")


# ---- sales -------------------------------------------------------------------------------------------------


def _entities(spark: SparkSession, sf_dir: str) -> tuple[Store, tf.Staged]:
    store, staged = Store.temporary(spark), tf.staged(spark, sf_dir)
    layer = EntityLayer(staged.feed, store, tf.LOAD_DT)
    layer.load_tables(tf.CALENDAR)
    layer.close()
    return store, staged


def _sales(spark: SparkSession, sf_dir: str) -> Store:
    store = Store.temporary(spark)
    layer = EntityLayer(tf.staged(spark, sf_dir).feed, store, tf.LOAD_DT)
    layer.load_tables(tf.CALENDAR)
    layer.load_sales()
    layer.close()
    return store


def _star(spark: SparkSession, sf_dir: str) -> Store:
    store = _sales(spark, sf_dir)
    load_dimensions(store, tf.LOAD_DT)
    sales.load_fact(store, tf.LOAD_DT)
    return store


def sales_3nf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir).read("ce_sales")


def incremental_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier sales first, then the whole feed: sales already there are left out."""
    store, staged = _entities(spark, sf_dir)
    sales.load_sales(staged.before(tf.CUT_DATE), store, tf.LOAD_DT)
    sales.load_sales(staged.feed, store, tf.NEXT_LOAD_DT)
    return store.read("ce_sales")


def fct_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).read("fct_sales")


def fct_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One period recomputed, one emptied by a range without sales, the others untouched."""
    store = _star(spark, sf_dir)
    sales.load_fact_period(store, tf.NEXT_LOAD_DT, 4594, 4686, "2022_Q3")
    sales.load_fact_period(store, tf.NEXT_LOAD_DT, 9000, 9010, "2022_Q2")
    return store.read("fct_sales")


def run_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full run, and the same feed again a month later: the fact is replaced by equal rows."""
    store, feed = Store.temporary(spark), tf.staged(spark, sf_dir).feed
    for day in (tf.LOAD_DT, tf.NEXT_LOAD_DT):
        run_warehouse(feed, store, day, calendar=tf.CALENDAR)
    return store.read("fct_sales")


def reopened_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity layer loaded, and loaded again through a second store over the same files: nothing is added."""
    store, staged = Store.temporary(spark), tf.staged(spark, sf_dir)
    for opened in (store, Store(spark, store.root, f"{store.database}_again")):
        layer = EntityLayer(staged.feed, opened, tf.LOAD_DT)
        layer.load_tables(tf.CALENDAR)
        layer.load_sales()
        layer.close()
    return opened.read("ce_sales")


def ordered_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store.temporary(spark)
    levels = (*entities.CITIES.parents, entities.CITIES)
    entities.load_hierarchy(tf.unstaged(spark, sf_dir).feed, store, levels, tf.LOAD_DT)
    return entities.listing(store, "ce_cities", "city_name")


def fct_uncovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.uncovered_sales(_sales(spark, sf_dir))


# ---- reports -----------------------------------------------------------------------------------------------


def city_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = entity_load(entities.CITIES)(spark, sf_dir)
    return cities.groupBy("city_name").agg(F.count("*").alias("n_rows"))


def entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, _ = _entities(spark, sf_dir)
    tables = [*entities.INSERT_ONLY, "ce_customers_sdc", "ce_dates"]
    counts = [store.read(t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
              for t in tables]
    return reduce(DataFrame.unionByName, counts)


def log_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the dealers and a failed one, as their log rows tell."""
    store = Store.temporary(spark)
    feed = tf.unstaged(spark, sf_dir).feed
    log = AuditLog(store)
    for _ in range(2):
        with log.loading("LOAD_CE_DEALERS") as note:
            note.report("dealers", entities.load_entity(feed, store, entities.DEALERS, tf.LOAD_DT))
    try:
        with log.loading("LOAD_CE_DEALERS"):
            raise RuntimeError("the feed is gone")
    except RuntimeError:
        pass
    return log_history(store, "LOAD_CE_DEALERS").select("procedure_name", "rows_affected", "log_message", "status")


def log_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log rows of a fact load, one for each period."""
    store = _sales(spark, sf_dir)
    load_dimensions(store, tf.LOAD_DT)
    sales.load_fact_logged(store, tf.LOAD_DT)
    return log_history(store, "LOAD_FCT_SALES").select("procedure_name", "rows_affected", "log_message", "status")


def log_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads: whether each one's time lies within the run, and how many were logged by then."""
    store, feed = Store.temporary(spark), tf.unstaged(spark, sf_dir).feed
    log = AuditLog(store)
    begin = spark.sql("SELECT current_timestamp()").first()[0]
    for entity in (entities.DEALERS, entities.PAYMENT_METHODS, entities.SALES_CHANNELS):
        with log.loading("LOAD") as note:
            note.report(entity.table, entities.load_entity(feed, store, entity, tf.LOAD_DT))
    end = spark.sql("SELECT current_timestamp()").first()[0]
    place = F.row_number().over(Window.partitionBy("procedure_name").orderBy("execution_time"))
    return log_history(store, "LOAD").select(
        "rows_affected", F.col("execution_time").between(F.lit(begin), F.lit(end)).alias("in_run"),
        place.cast("long").alias("place"))


# ---- data quality ------------------------------------------------------------------------------------------


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicates(tf.unstaged(spark, sf_dir).feed, ["id", "source_system"])


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["state", "building", "email"]
    return quality.missing(tf.unstaged(spark, sf_dir).feed, columns).select("id", "source_system", *columns)


def dq_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Online sales of a car at a dealer that the offline feed does not know."""
    rows = save(tf.unstaged(spark, sf_dir).feed.select(
        "id", "source_system", joined("dealer", "brand", "model").alias("dealer_car")
    ), "dealer-cars")
    known = rows.filter(is_offline())
    return quality.orphans(rows.filter(~is_offline()), "dealer_car", known, "dealer_car").select("id", "dealer_car")


def dq_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = tf.unstaged(spark, sf_dir).feed
    return quality.outside_domain(feed, "channel", ("F", "O")).select("id", "source_system", "channel")


def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.too_long(tf.unstaged(spark, sf_dir).feed, "street", 9).select("id", "source_system", "street")


def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared rule of the entity layer and the fact, with the fact's periods a week later."""
    later = [Period(p.name, p.first_id + 7, p.end_id + 7) for p in DEFAULT_PERIODS]
    return quality.check_store(_star(spark, sf_dir), CHECKED_TABLES, later)


def dq_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows outside their period, if all periods were a week later."""
    later = [Period(p.name, p.first_id + 7, p.end_id + 7) for p in DEFAULT_PERIODS]
    rows = quality.outside_period(_star(spark, sf_dir).read("fct_sales"), later)
    return rows.select("sale_src_id", "source_id", "sales_period", "date_surr_id")


def all_queries() -> dict[str, Query]:
    e = entities
    return {
        "csv_scan": csv_scan,
        "csv_scan_online": csv_scan_online,
        "csv_rejects": csv_rejects,
        "staged_drops": staged_drops,
        "staging_union": staging_union,
        "safe_casts": safe_casts,
        "cast_rejects": cast_rejects,
        "name_split": name_split,
        "key_concat": key_concat,
        "name_edges": name_edges,
        "long_keys": long_keys,
        "load_dealers": entity_load(e.DEALERS),
        "load_payment_methods": entity_load(e.PAYMENT_METHODS),
        "load_sales_channels": entity_load(e.SALES_CHANNELS),
        "load_brands": entity_load(e.BRANDS),
        "load_countries": entity_load(e.COUNTRIES),
        "load_employees": entity_load(e.EMPLOYEES),
        "load_states": entity_load(e.STATES),
        "load_cities": entity_load(e.CITIES),
        "load_streets": entity_load(e.STREETS),
        "load_addresses": entity_load(e.ADDRESSES),
        "load_models": entity_load(e.MODELS),
        "load_cars": entity_load(e.CARS),
        "load_customers": load_customers,
        "incremental_insert": incremental_insert,
        "incremental_sales": incremental_sales,
        "calendar": calendar,
        "dim_dates": dim_dates,
        "customers_scd2": customers_scd2,
        "customer_conflicts": customer_conflicts,
        "dim_customers_scd2": dim_customers_scd2,
        "dim_cars_flat": dim_cars_flat,
        "dim_cars": dimension_load("dim_cars", e.CARS),
        "dim_employees": dimension_load("dim_employees", e.EMPLOYEES),
        "dim_dealers": dimension_load("dim_dealers", e.DEALERS),
        "dim_payment_methods": dimension_load("dim_payment_methods", e.PAYMENT_METHODS),
        "dim_sales_channels": dimension_load("dim_sales_channels", e.SALES_CHANNELS),
        "dim_upsert_type1": dim_upsert_type1,
        "sales_3nf": sales_3nf,
        "fct_sales": fct_sales,
        "fct_partition_overwrite": fct_partition_overwrite,
        "fct_uncovered": fct_uncovered,
        "run_twice": run_twice,
        "reopened_store": reopened_store,
        "ordered_cities": ordered_cities,
        "city_counts": city_counts,
        "entity_counts": entity_counts,
        "log_history": log_report,
        "dq_unique": dq_unique,
        "dq_not_null": dq_not_null,
        "dq_fk": dq_fk,
        "dq_domain": dq_domain,
        "dq_length": dq_length,
        "dq_bounds": dq_bounds,
        "check_report": check_report,
        "log_periods": log_periods,
        "log_times": log_times,
        "csv_rejects_online": csv_rejects_online,
    }

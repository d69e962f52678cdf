"""The entity layer: which rows each entity takes from the feeds, and its loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.functions.casts import safe_year
from lotbook.functions.text import attribute, cut, is_filled, joined, key_part, person_name
from lotbook.operators.calendar import FIRST_DAY, LAST_DAY, build_calendar
from lotbook.operators.insert_only import append_new, load_insert_only, not_in_table
from lotbook.operators.lookup import resolve
from lotbook.operators.merge import union_with_priority
from lotbook.operators.scd2 import one_row_per_key, scd2_merge
from lotbook.operators.surrogate import is_small
from lotbook.schemas import TABLES
from lotbook.sources.feeds import FEED_SYSTEMS, LINEAGE
from lotbook.sources.scratch import discard, passing, save, save_counted
from lotbook.sources.store import Store

Expression = Callable[[], Column]


@dataclass(frozen=True)
class Entity:
    """How an entity is made of the conformed feed.

    ``key`` is the natural key as lookups build it; the stored key is cut to the declared length. ``filled``
    columns must hold text, ``present`` ones may be blank. ``parents`` are resolved one after the other, each
    adding its id column.
    """

    table: str
    key: Expression
    inputs: tuple[str, ...]
    attributes: dict[str, Expression]
    filled: tuple[str, ...] = ()
    present: tuple[str, ...] = ()
    parents: tuple[Entity, ...] = ()
    stored_key_length: int = 200

    def qualifies(self) -> Column:
        rules = [is_filled(F.col(c)) for c in self.filled] + [F.col(c).isNotNull() for c in self.present]
        return reduce(lambda a, b: a & b, rules)


def _simple(table: str, column: str, name: str) -> Entity:
    return Entity(
        table, lambda: F.col(column), (column,), {name: lambda: cut(F.col(column), 100)}, filled=(column,),
        stored_key_length=100,
    )


def _level(table: str, column: str, name: str, parent: Entity, also_filled: tuple[str, ...]) -> Entity:
    parent_id = TABLES[parent.table].id_col
    return Entity(
        table,
        lambda: joined(column, parent_id),
        (column, *parent.inputs),
        {parent_id: lambda: F.col(parent_id), name: lambda: cut(F.col(column), 100)},
        filled=(column, *also_filled),
        parents=(*parent.parents, parent),
    )


COUNTRIES = _simple("ce_countries", "country", "country_name")
STATES = _level("ce_states", "state", "state_name", COUNTRIES, ("country",))
CITIES = _level("ce_cities", "city", "city_name", STATES, ("state", "country"))
STREETS = _level("ce_streets", "street", "street_name", CITIES, ("city", "state", "country"))
ADDRESSES = Entity(
    "ce_addresses",
    lambda: joined("street", "street_id", key_part(F.col("building")), key_part(F.col("postal"))),
    ("building", "postal", *STREETS.inputs),
    {
        "street_id": lambda: F.col("street_id"),
        "building_number": lambda: cut(attribute(F.col("building")), 20),
        "postal_code": lambda: cut(attribute(F.col("postal")), 20),
    },
    present=("street",),
    parents=(*STREETS.parents, STREETS),
    stored_key_length=300,
)
BRANDS = _simple("ce_car_brands", "brand", "brand_name")
MODELS = _level("ce_car_models", "model", "model_name", BRANDS, ("brand",))
CARS = Entity(
    "ce_cars",
    lambda: joined("brand", "model", key_part(F.col("year"))),
    ("brand", "model", "year"),
    {"car_model_id": lambda: F.col("car_model_id"), "year": lambda: safe_year(F.col("year"))},
    present=("brand", "model"),
    parents=(BRANDS, MODELS),
    stored_key_length=300,
)
EMPLOYEES = Entity(
    "ce_employees",
    lambda: key_part(F.col("employee_id")),
    ("employee_id", "employee_name"),
    {
        "employee_first_name": lambda: cut(person_name(F.col("employee_name"))[0], 100),
        "employee_last_name": lambda: cut(person_name(F.col("employee_name"))[1], 100),
    },
    filled=("employee_id", "employee_name"),
    stored_key_length=100,
)
DEALERS = _simple("ce_dealers", "dealer", "dealer_name")
PAYMENT_METHODS = _simple("ce_payment_methods", "payment_method", "method_name")
SALES_CHANNELS = _simple("ce_sales_channels", "channel", "channel_name")
CUSTOMERS = Entity(
    "ce_customers_sdc",
    lambda: joined(key_part(F.col("customer_name")), key_part(F.col("email")), "address_id"),
    ("customer_name", "email", "phone", *ADDRESSES.inputs),
    {
        "customer_first_name": lambda: cut(person_name(F.col("customer_name"))[0], 100),
        "customer_last_name": lambda: cut(person_name(F.col("customer_name"))[1], 100),
        "customer_email": lambda: cut(attribute(F.col("email")), 100),
        "customer_telephone_number": lambda: cut(attribute(F.col("phone")), 30),
        "address_id": lambda: F.col("address_id"),
    },
    filled=("customer_name",),
    parents=(*ADDRESSES.parents, ADDRESSES),
    stored_key_length=300,
)
HIERARCHIES: dict[str, tuple[Entity, ...]] = {
    "location": (COUNTRIES, STATES, CITIES, STREETS, ADDRESSES),
    "car": (BRANDS, MODELS, CARS),
}
INSERT_ONLY = {
    e.table: e
    for e in (*HIERARCHIES["location"], *HIERARCHIES["car"], EMPLOYEES, DEALERS, PAYMENT_METHODS,
              SALES_CHANNELS)
}


def profile(feed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values of some feed columns per source: all an entity needs to know of the feed."""
    return feed.select(*LINEAGE, *columns).distinct()


def resolve_entity(rows: DataFrame, store: Store, entity: Entity, *, active_only: bool = False,
                   default: int | None = -1) -> DataFrame:
    """Add the entity's id by its natural key. Only members that came from a feed can be found."""
    spec = TABLES[entity.table]
    members = store.read(entity.table).filter(F.col("source_system").isin(*FEED_SYSTEMS))
    if active_only:
        members = members.filter(F.col("is_active") == "Y")
    return resolve(rows, members, entity.key(), spec.src_col, spec.id_col,
                   known_rows=store.rows(entity.table), default=default)


def with_parents(rows: DataFrame, store: Store, entity: Entity) -> DataFrame:
    """Resolve the parents of an entity, unless the rows already carry the id of the nearest one."""
    if entity.parents and TABLES[entity.parents[-1].table].id_col not in rows.columns:
        for parent in entity.parents:
            rows = resolve_entity(rows, store, parent)
    return rows


def to_load(feed: DataFrame, store: Store, entity: Entity, known_rows: int | None = None) -> DataFrame:
    """Candidates of an entity: natural key, attributes and lineage, online rows only where offline has none.

    ``feed`` is the conformed feed or any frame with the entity's input columns, such as a profile, with or
    without the parent's id; ``known_rows`` an upper bound of its distinct rows.
    """
    spec = TABLES[entity.table]
    parent_id = [TABLES[p.table].id_col for p in entity.parents[-1:]]
    rows = profile(feed, [*entity.inputs, *[c for c in parent_id if c in feed.columns]])
    if known_rows is None:  # the feed itself: read once, and its rows are read more than once below
        rows = save(with_parents(save(rows, "profile", lean=True), store, entity), "profile", lean=True)
    rows = with_parents(rows, store, entity).withColumn("_key", entity.key())
    candidates = rows.filter(entity.qualifies()).select(
        "_key", *[value().alias(name) for name, value in entity.attributes.items()], *LINEAGE
    )
    merged = union_with_priority(candidates, rows, "_key", known_rows=known_rows)
    stored = cut(F.col("_key"), entity.stored_key_length).alias(spec.src_col)
    return merged.select(stored, *entity.attributes, *LINEAGE).distinct()


def load_entity(
    feed: DataFrame, store: Store, entity: Entity, load_dt: dt.date, known_rows: int | None = None
) -> dict[str, int]:
    """Insert-only load of one entity.

    Unless ``feed`` is known to be small, the distinct values the entity needs are written and counted first:
    the rest of the load works on them alone, and their number decides how.
    """
    with passing(store.spark):
        if not is_small(known_rows):
            parent_id = [TABLES[p.table].id_col for p in entity.parents[-1:]]
            known = [c for c in parent_id if c in feed.columns]
            rows = with_parents(profile(feed, [*entity.inputs, *known]), store, entity)
            feed, known_rows = save_counted(rows, "profile", lean=True)
        return load_insert_only(store, entity.table, to_load(feed, store, entity, known_rows), load_dt, known_rows)


def add_ids(rows: DataFrame, store: Store, entity: Entity) -> DataFrame:
    """The rows of a profile with the id of one more level, written so that later levels build on it."""
    return save(resolve_entity(rows, store, entity), "resolved", lean=True)


def load_hierarchy(
    feed: DataFrame, store: Store, levels: Sequence[Entity], load_dt: dt.date
) -> dict[str, dict[str, int]]:
    """Load levels from the top down; each finds its parents among the levels before it.

    Every level is looked up once: its ids stay with the rows for the next level.
    """
    rows, count = save_counted(profile(feed, levels[-1].inputs), "profile", lean=True)
    done = {}
    for level in levels:
        done[level.table], last = load_entity(rows, store, level, load_dt, count), rows
        if level is not levels[-1]:
            rows = add_ids(rows, store, level)
        discard(last)
    return done


def customer_snapshot(feed: DataFrame, store: Store, known_rows: int | None = None) -> DataFrame:
    """One row per customer key; if a feed holds several phones of a customer, the largest one."""
    order = ("customer_telephone_number", "customer_email", "customer_first_name", "customer_last_name",
             "address_id", *LINEAGE)
    return one_row_per_key(to_load(feed, store, CUSTOMERS, known_rows), "customer_src_id", order)


def load_customers(feed: DataFrame, store: Store, load_dt: dt.date) -> dict[str, int]:
    """Type-2 load of the customers; only the tracked attributes open a new version."""
    known = [c for c in ("address_id",) if c in feed.columns]
    with passing(store.spark):
        rows, count = save_counted(profile(feed, [*CUSTOMERS.inputs, *known]), "profile", lean=True)
        if not known:  # the lookups read the profile more than once
            bare = rows
            rows, count = save_counted(with_parents(bare, store, CUSTOMERS), "profile", lean=True)
            discard(bare)
        snapshot = customer_snapshot(rows, store, count)
        return scd2_merge(store, CUSTOMERS.table, snapshot, load_dt, count)


def load_dates(
    store: Store, load_dt: dt.date, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY,
    anchor: dt.date | None = None,
) -> dict[str, int]:
    """Add the days the calendar does not have yet."""
    days = build_calendar(store.spark, first, last, anchor)
    missing = not_in_table(days, store, "ce_dates", ["date"]).repartition(1)
    added, default_rows = append_new(store, "ce_dates", missing, load_dt)
    return {"New rows": added, "Default rows": default_rows}


def listing(store: Store, table: str, *by: str) -> DataFrame:
    """The rows of an entity in ascending order of the given columns, then of its id."""
    return store.read(table).orderBy(*[F.asc(c) for c in (*by, TABLES[table].id_col)])

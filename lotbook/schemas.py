"""Declared tables: columns, keys, references, lengths and the default member of each."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column

from lotbook.functions.text import attribute

DEFAULT_ID = -1
OPEN_END = dt.date(9999, 12, 31)  # fixed value: end of validity of a current version
_LINEAGE = "source_system string, source_entity string"
_STAMPS = "insert_dt date, update_dt date"
_TAIL = f"{_LINEAGE}, {_STAMPS}"


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    id_col: str
    src_col: str
    unique: tuple[tuple[str, ...], ...] = ()
    not_null: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    default: dict[str, object] | None = None
    partition_by: str | None = None
    #: Of tables whose rows change: the key that rows are bucketed by, and the columns in which changes are looked for.
    bucket_by: str | None = None
    tracked: tuple[str, ...] = ()
    null_is_text: bool = False  # when tracked columns are compared, NULL equals the text stored for a missing value

    @property
    def has_history(self) -> bool:
        return self.bucket_by is not None and "is_active" in self.columns

    def compared(self, value: Column) -> Column:
        """A tracked column in the form in which it is compared."""
        return attribute(value) if self.null_is_text else value

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split(", ")]


_YES_NO = {"is_active": ("Y", "N")}
_DEFAULT_ENTITY = {"source_system": "MANUAL", "source_entity": "DEFAULT_ROW"}


def _entity(name, id_col, src_col, body, default, *, src_length=100, **kw) -> Table:
    kw.setdefault("lengths", {})
    return Table(
        name,
        f"{id_col} bigint, {src_col} string, {body}, {_TAIL}",
        id_col,
        src_col,
        unique=((id_col,), *kw.pop("unique", ())),
        not_null=(id_col, src_col, *kw.pop("not_null", ()), "source_system", "source_entity"),
        default={id_col: DEFAULT_ID, src_col: "n. a.", **default, **_DEFAULT_ENTITY},
        lengths={src_col: src_length, **kw.pop("lengths")},
        **kw,
    )


def _named(name, id_col, src_col, name_col, unique_name=True) -> Table:
    return _entity(
        name, id_col, src_col, f"{name_col} string", {name_col: "n. a."},
        unique=((name_col,),) if unique_name else (), not_null=(name_col,), lengths={name_col: 100},
    )


def _level(name, id_col, src_col, parent, parent_id, name_col) -> Table:
    return _entity(
        name, id_col, src_col, f"{parent_id} bigint, {name_col} string",
        {parent_id: DEFAULT_ID, name_col: "n. a."},
        unique=((parent_id, name_col),), not_null=(parent_id, name_col),
        references={parent_id: (parent, parent_id)}, lengths={name_col: 100},
    )


_SALE_MEASURES = (
    "sale_price decimal(12,2), commission_rate decimal(20,18), commission_earned decimal(12,2), "
    "reduction_percent decimal(5,2), income decimal(12,2)"
)

# Fixed values, here and below: names, types, lengths and defaults of the declared tables' columns.
ENTITIES = [
    _named("ce_countries", "country_id", "country_src_id", "country_name", unique_name=False),
    _level("ce_states", "state_id", "state_src_id", "ce_countries", "country_id", "state_name"),
    _level("ce_cities", "city_id", "city_src_id", "ce_states", "state_id", "city_name"),
    _level("ce_streets", "street_id", "street_src_id", "ce_cities", "city_id", "street_name"),
    _entity(
        "ce_addresses", "address_id", "address_src_id",
        "street_id bigint, building_number string, postal_code string",
        {"street_id": DEFAULT_ID, "building_number": "n. a.", "postal_code": "n. a."},
        unique=(("street_id", "building_number", "postal_code"),), not_null=("street_id",),
        references={"street_id": ("ce_streets", "street_id")},
        lengths={"building_number": 20, "postal_code": 20},
    ),
    _named("ce_car_brands", "car_brand_id", "brand_src_id", "brand_name"),
    _level("ce_car_models", "car_model_id", "model_src_id", "ce_car_brands", "car_brand_id", "model_name"),
    _entity(
        "ce_cars", "car_id", "car_src_id", "car_model_id bigint, year int",
        {"car_model_id": DEFAULT_ID, "year": -1}, src_length=200,
        unique=(("car_src_id",),), not_null=("car_model_id",),
        references={"car_model_id": ("ce_car_models", "car_model_id")},
    ),
    _entity(
        "ce_employees", "employee_id", "employee_src_id",
        "employee_first_name string, employee_last_name string",
        {"employee_first_name": "n. a.", "employee_last_name": "n. a."},
        lengths={"employee_first_name": 100, "employee_last_name": 100},
    ),
    _named("ce_dealers", "dealer_id", "dealer_src_id", "dealer_name"),
    _named("ce_payment_methods", "payment_method_id", "payment_method_src_id", "method_name"),
    _named("ce_sales_channels", "sales_channel_id", "sales_channel_src_id", "channel_name"),
    Table(
        "ce_dates", f"date_id bigint, date date, day int, month int, year int, quarter int, {_TAIL}",
        "date_id", "date", unique=(("date_id",), ("date",)),
        not_null=("date_id", "date", "source_system", "source_entity"),
        default={"date_id": DEFAULT_ID, "date": dt.date(1900, 1, 1), "day": 1, "month": 1, "year": 1900,
                 "quarter": 1, **_DEFAULT_ENTITY},
    ),
    Table(
        "ce_customers_sdc",
        "customer_id bigint, customer_src_id string, customer_first_name string, customer_last_name string, "
        "customer_email string, customer_telephone_number string, address_id bigint, start_dt date, "
        f"end_dt date, is_active string, {_TAIL}",
        "customer_id", "customer_src_id", unique=(("customer_id",),),
        not_null=("customer_id", "customer_src_id", "start_dt", "source_system", "source_entity"),
        references={"address_id": ("ce_addresses", "address_id")}, domains=_YES_NO,
        lengths={"customer_src_id": 300, "customer_first_name": 100, "customer_last_name": 100,
                 "customer_email": 100, "customer_telephone_number": 30},
        default={"customer_id": DEFAULT_ID, "customer_src_id": "n. a.", "customer_first_name": "n. a.",
                 "customer_last_name": "n. a.", "customer_email": "n. a.",
                 "customer_telephone_number": "n. a.", "address_id": DEFAULT_ID, "end_dt": OPEN_END,
                 "is_active": "Y", **_DEFAULT_ENTITY},
        bucket_by="customer_src_id", null_is_text=True,
        tracked=("customer_first_name", "customer_last_name", "customer_email", "customer_telephone_number"),
    ),
    Table(
        "ce_sales",
        "sale_id bigint, sale_src_id string, source_id string, customer_id bigint, employee_id bigint, "
        "car_id bigint, dealer_id bigint, date_id bigint, sales_channel_id bigint, payment_method_id bigint, "
        f"{_SALE_MEASURES}, {_TAIL}",
        "sale_id", "sale_src_id", unique=(("sale_id",),),
        not_null=("sale_id", "sale_src_id", "source_id", "source_system", "source_entity"),
        references={
            "customer_id": ("ce_customers_sdc", "customer_id"), "employee_id": ("ce_employees", "employee_id"),
            "car_id": ("ce_cars", "car_id"), "dealer_id": ("ce_dealers", "dealer_id"),
            "date_id": ("ce_dates", "date_id"),
            "sales_channel_id": ("ce_sales_channels", "sales_channel_id"),
            "payment_method_id": ("ce_payment_methods", "payment_method_id"),
        },
        lengths={"sale_src_id": 50, "source_id": 100},
    ),
]


def _dimension(name, id_col, src_col, body, default, *, src_length=255, unique_src=True, **kw) -> Table:
    return Table(
        name, f"{id_col} bigint, {src_col} string, {body}, {_TAIL}", id_col, src_col,
        unique=((id_col,), (src_col,)) if unique_src else ((id_col,),),
        not_null=(id_col, src_col, *kw.pop("not_null", ())),
        lengths={src_col: src_length, **kw.pop("lengths", {})},
        default={id_col: DEFAULT_ID, src_col: "-1", **default, **_DEFAULT_ENTITY}, bucket_by=src_col,
        tracked=kw.pop("tracked", (*default, "source_system", "source_entity")), **kw,
    )


_CUSTOMER_PLACE = {
    "customer_country": 100, "customer_state": 100, "customer_city": 100, "customer_street_name": 100,
    "customer_building_number": 20, "customer_postal_code": 20,
}
_CUSTOMER_PERSON = {
    "customer_first_name": 100, "customer_last_name": 100, "customer_email": 100,
    "customer_telephone_number": 30,
}

DIMENSIONS = [
    Table(
        "dim_dates",
        "date_surr_id bigint, date date, day int, month int, year int, quarter int, is_weekend string, "
        f"month_name string, day_of_week string, {_TAIL}",
        "date_surr_id", "date", unique=(("date_surr_id",), ("date",)), not_null=("date_surr_id", "date"),
        lengths={"month_name": 20, "day_of_week": 20}, domains={"is_weekend": ("Y", "N")},
        default={"date_surr_id": DEFAULT_ID, "date": dt.date(1900, 1, 1), "day": -1, "month": -1, "year": -1,
                 "quarter": -1, "is_weekend": "N", "month_name": "n. a.", "day_of_week": "n. a.",
                 **_DEFAULT_ENTITY},
        bucket_by="date", tracked=("day", "month", "year", "quarter", "is_weekend", "month_name", "day_of_week",
                                   "source_system", "source_entity"),
    ),
    _dimension(
        "dim_employees", "employee_surr_id", "employee_src_id",
        "employee_first_name string, employee_last_name string",
        {"employee_first_name": "n. a.", "employee_last_name": "n. a."}, src_length=100,
        lengths={"employee_first_name": 100, "employee_last_name": 100},
    ),
    _dimension("dim_dealers", "dealer_surr_id", "dealer_src_id", "dealer_name string",
               {"dealer_name": "n. a."}, not_null=("dealer_name",)),
    _dimension("dim_cars", "car_surr_id", "car_src_id", "brand_name string, model_name string, year int",
               {"brand_name": "n. a.", "model_name": "n. a.", "year": -1}, src_length=200,
               lengths={"brand_name": 100, "model_name": 100}),
    _dimension(
        "dim_customers_sdc", "customer_surr_id", "customer_src_id",
        ", ".join(f"{c} string" for c in [*_CUSTOMER_PERSON, *_CUSTOMER_PLACE])
        + ", start_dt date, end_dt date, is_active string",
        {**dict.fromkeys([*_CUSTOMER_PERSON, *_CUSTOMER_PLACE], "n. a."), "is_active": "Y"},
        src_length=300, unique_src=False, not_null=("start_dt",), domains=_YES_NO,
        tracked=(*_CUSTOMER_PERSON, *_CUSTOMER_PLACE),
        lengths={**_CUSTOMER_PERSON, **_CUSTOMER_PLACE},
    ),
    _dimension("dim_payment_methods", "payment_method_surr_id", "payment_method_src_id", "method_name string",
               {"method_name": "n. a."}, not_null=("method_name",)),
    _dimension("dim_sales_channels", "sales_channel_surr_id", "sales_channel_src_id", "channel_name string",
               {"channel_name": "n. a."}, not_null=("channel_name",)),
]

FACT = Table(
    "fct_sales",
    "sale_surr_id bigint, sale_src_id string, customer_surr_id bigint, employee_surr_id bigint, "
    "car_surr_id bigint, dealer_surr_id bigint, date_surr_id bigint, payment_method_surr_id bigint, "
    f"sales_channel_surr_id bigint, {_SALE_MEASURES}, calc_discount_value decimal(12,2), "
    f"calc_commission_check decimal(12,2), insert_dt date, update_dt date, source_id string, {_LINEAGE}, "
    "sales_period string",
    "sale_surr_id", "sale_src_id", not_null=("sale_src_id", "source_id"),
    lengths={"sale_src_id": 50, "source_id": 100}, partition_by="sales_period",
)

AUDIT = Table(
    "log_table",
    "log_id bigint, procedure_name string, execution_time timestamp, rows_affected bigint, log_message string, "
    "status string",
    "log_id", "procedure_name", unique=(("log_id",),), not_null=("log_id", "procedure_name", "execution_time"),
    lengths={"procedure_name": 255, "status": 50},
)

TABLES: dict[str, Table] = {t.name: t for t in [*ENTITIES, *DIMENSIONS, FACT, AUDIT]}

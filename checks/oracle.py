"""SQL counterparts of the driver queries, written against the provided tables.

Every statement is a WITH chain of the named steps below; a step lists the steps it reads.
"""

from __future__ import annotations

import re

from lotbook.schemas import ENTITIES, TABLES

OFFLINE, ONLINE = "SA_CAR_SALES_OFFLINE", "SA_CAR_SALES_ONLINE"
DAY1, DAY2, CUT = "DATE '2024-07-01'", "DATE '2024-08-01'", "DATE '1998-06-15'"
CANONICAL = (
    "id sale_date employee_id employee_name customer_name country state postal city street building phone email "
    "brand model year price commission_rate commission_earned payment_method channel dealer reduction_percent income"
).split()
PLACE = "country state city street building postal".split()
PATH = ["customer_name", "email", *PLACE]
OFFLINE_LACKS, ONLINE_LACKS = ("reduction_percent", "income"), ("commission_rate", "commission_earned")

STEPS: dict[str, str] = {}


def step(name: str, sql: str) -> None:
    STEPS[name] = sql.strip()


def statement(final: str, kind: str = "") -> str:
    """The final query with all steps it needs in front of it; ``kind`` is what a step is to be, such as MATERIALIZED."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(STEPS[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS {kind}(\n{STEPS[n]}\n)" for n in needed) + "\n" + final.strip()


def cols(names, alias: str = "") -> str:
    return ", ".join(f'{alias}."{n}"' if alias else f'"{n}"' for n in names)


# ---- feeds -------------------------------------------------------------------------------------------------

step("sale_lines", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
  CASE WHEN l_orderkey % 97 = 0 THEN ' ' || strftime(o_orderdate, '%Y-%m-%d')
       WHEN l_orderkey % 89 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
       WHEN l_orderkey % 101 = 0 THEN strftime(o_orderdate, '%Y') || '-13-45'
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sale_date,
  replace(p_name, ' ', '') AS employee_id, p_name AS employee_name,
  c_name || ' ' || c_mktsegment AS customer_name, r_name AS country,
  CASE WHEN c_custkey % 53 <> 0 THEN n_name END AS state,
  'P' || CAST(c_custkey % 100 AS VARCHAR) AS postal,
  CASE WHEN c_custkey % 31 = 0 THEN ' ' ELSE c_mktsegment END AS city,
  'Street ' || CAST(c_custkey // 10 AS VARCHAR) AS street,
  CASE WHEN c_custkey % 37 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS building,
  o_orderpriority AS phone,
  CASE WHEN c_custkey % 41 <> 0 THEN 'c' || CAST(c_custkey AS VARCHAR) || '@mail.test' END AS email,
  p_brand AS brand, p_type AS model,
  CASE WHEN p_size = 13 THEN '99' ELSE CAST(p_size + 1990 AS VARCHAR) END AS year,
  CASE WHEN l_linenumber = 7 THEN 'N/A'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
  CAST(CAST(l_tax AS DECIMAL(12,2)) AS VARCHAR) AS commission_rate,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS VARCHAR)
    AS commission_earned,
  CAST(CAST(CAST(l_discount AS DECIMAL(12,2)) * 100 AS DECIMAL(12,2)) AS VARCHAR) AS reduction_percent,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS VARCHAR)
    AS income,
  o_orderpriority AS payment_method, o_orderstatus AS channel, s_name AS dealer,
  l_returnflag AS return_flag, CAST(o_orderdate AS DATE) AS order_day
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
""")


def _feed(system: str, lacks: tuple[str, ...], text: str, condition: str) -> str:
    items = []
    for name in CANONICAL:
        if name in lacks:
            items.append(f"CAST(NULL AS VARCHAR) AS {name}")
        elif name == "sale_date":
            items.append(name)
        else:
            items.append(f"upper(trim({text.format(name)})) AS {name}")
    entity = system.replace("SA_", "SRC_", 1)
    return (f"SELECT {', '.join(items)}, '{system}' AS source_system, '{entity}' AS source_entity, order_day "
            f"FROM sale_lines WHERE {condition}")


step("feed", _feed(OFFLINE, OFFLINE_LACKS, "{}", "return_flag <> 'R'") + "\nUNION ALL\n"
     + _feed(ONLINE, ONLINE_LACKS, "' ' || lower({}) || '  '", "return_flag = 'R'"))
step("feed_before", f"SELECT * FROM feed WHERE order_day < {CUT}")
step("feed_since", f"SELECT * FROM feed WHERE order_day >= {CUT}")

# ---- insert-only entities ----------------------------------------------------------------------------------


def _first(name: str) -> str:
    return f"coalesce(nullif(trim(split_part(coalesce({name}, 'N. A.'), ' ', 1)), ''), 'n. a.')"


def _last(name: str) -> str:
    return f"coalesce(nullif(trim(split_part(coalesce({name}, 'N. A.'), ' ', 2)), ''), 'n. a.')"


YEAR = ("CASE WHEN regexp_full_match(year, '\\d{4}') AND CAST(TRY_CAST(year AS INTEGER) AS INTEGER) "
        "BETWEEN 1900 AND 2100 THEN TRY_CAST(year AS INTEGER) ELSE -1 END")


def entity(table: str, id_col: str, src_col: str, rows: str, key: str, attributes: dict[str, str], condition: str,
           default: str, *, day: str = DAY1, suffix: str = "") -> None:
    """Steps for the candidates of an entity and for its table after the first load."""
    names = ", ".join(attributes)
    picks = ", ".join(f"{sql} AS {name}" for name, sql in attributes.items())
    step(f"{table}_candidates{suffix}", f"""
SELECT DISTINCT _key AS {src_col}, {names}, source_system, source_entity
FROM (SELECT {key} AS _key, {picks}, ({condition}) AS _ok, source_system, source_entity FROM {rows}) AS c
WHERE _ok AND (source_system = '{OFFLINE}' OR NOT EXISTS (
  SELECT 1 FROM (SELECT {key} AS _taken FROM {rows} WHERE source_system = '{OFFLINE}') AS o
  WHERE o._taken = c._key))""")
    step(f"{table}{suffix}", f"""
SELECT CAST(-1 AS BIGINT) AS {id_col}, 'n. a.' AS {src_col}, {default}, 'MANUAL' AS source_system,
  'DEFAULT_ROW' AS source_entity, {day} AS insert_dt, {day} AS update_dt
UNION ALL
SELECT row_number() OVER (ORDER BY {src_col}, {names}, source_system, source_entity), {src_col}, {names},
  source_system, source_entity, {day}, {day}
FROM {table}_candidates{suffix}""")


def simple(table: str, id_col: str, src_col: str, name: str, column: str, suffix: str = "", rows: str = "feed") -> None:
    entity(table, id_col, src_col, rows, column, {name: column}, f"{column} <> ''", f"'n. a.' AS {name}",
           suffix=suffix)


simple("ce_countries", "country_id", "country_src_id", "country_name", "country")
simple("ce_car_brands", "car_brand_id", "brand_src_id", "brand_name", "brand")
simple("ce_dealers", "dealer_id", "dealer_src_id", "dealer_name", "dealer")
simple("ce_payment_methods", "payment_method_id", "payment_method_src_id", "method_name", "payment_method")
simple("ce_sales_channels", "sales_channel_id", "sales_channel_src_id", "channel_name", "channel")
entity("ce_employees", "employee_id", "employee_src_id", "feed", "coalesce(employee_id, 'N. A.')",
       {"employee_first_name": _first("employee_name"), "employee_last_name": _last("employee_name")},
       "employee_id <> '' AND employee_name <> ''", "'n. a.' AS employee_first_name, 'n. a.' AS employee_last_name")


def level(rows: str, previous: str, table: str, id_col: str, src_col: str, key: str) -> None:
    """The rows of the level above with the id of one more parent."""
    step(rows, f"""
SELECT r.*, coalesce(p.{id_col}, -1) AS {id_col}
FROM {previous} AS r LEFT JOIN {table} AS p ON p.{src_col} = {key} AND p.source_system <> 'MANUAL'""")


step("place0", f"SELECT DISTINCT {', '.join(PLACE)}, source_system, source_entity FROM feed")
level("place1", "place0", "ce_countries", "country_id", "country_src_id", "r.country")
entity("ce_states", "state_id", "state_src_id", "place1", "concat(state, '_', country_id)",
       {"country_id": "country_id", "state_name": "state"}, "state <> '' AND country <> ''",
       "CAST(-1 AS BIGINT) AS country_id, 'n. a.' AS state_name")
level("place2", "place1", "ce_states", "state_id", "state_src_id", "concat(r.state, '_', r.country_id)")
entity("ce_cities", "city_id", "city_src_id", "place2", "concat(city, '_', state_id)",
       {"state_id": "state_id", "city_name": "city"}, "city <> '' AND state <> '' AND country <> ''",
       "CAST(-1 AS BIGINT) AS state_id, 'n. a.' AS city_name")
level("place3", "place2", "ce_cities", "city_id", "city_src_id", "concat(r.city, '_', r.state_id)")
entity("ce_streets", "street_id", "street_src_id", "place3", "concat(street, '_', city_id)",
       {"city_id": "city_id", "street_name": "street"},
       "street <> '' AND city <> '' AND state <> '' AND country <> ''",
       "CAST(-1 AS BIGINT) AS city_id, 'n. a.' AS street_name")
level("place4", "place3", "ce_streets", "street_id", "street_src_id", "concat(r.street, '_', r.city_id)")
_ADDRESS_KEY = "concat({0}street, '_', {0}street_id, '_', coalesce({0}building, 'N. A.'), '_', coalesce({0}postal, 'N. A.'))"
entity("ce_addresses", "address_id", "address_src_id", "place4", _ADDRESS_KEY.format(""),
       {"street_id": "street_id", "building_number": "coalesce(building, 'n. a.')",
        "postal_code": "coalesce(postal, 'n. a.')"}, "street IS NOT NULL",
       "CAST(-1 AS BIGINT) AS street_id, 'n. a.' AS building_number, 'n. a.' AS postal_code")
level("place5", "place4", "ce_addresses", "address_id", "address_src_id", _ADDRESS_KEY.format("r."))


def car_steps(suffix: str, rows: str) -> None:
    if suffix:
        simple("ce_car_brands", "car_brand_id", "brand_src_id", "brand_name", "brand", suffix, rows)
    step(f"car0{suffix}", f"SELECT DISTINCT brand, model, year, source_system, source_entity FROM {rows}")
    level(f"car1{suffix}", f"car0{suffix}", f"ce_car_brands{suffix}", "car_brand_id", "brand_src_id", "r.brand")
    entity("ce_car_models", "car_model_id", "model_src_id", f"car1{suffix}", "concat(model, '_', car_brand_id)",
           {"car_brand_id": "car_brand_id", "model_name": "model"}, "model <> '' AND brand <> ''",
           "CAST(-1 AS BIGINT) AS car_brand_id, 'n. a.' AS model_name", suffix=suffix)
    level(f"car2{suffix}", f"car1{suffix}", f"ce_car_models{suffix}", "car_model_id", "model_src_id",
          "concat(r.model, '_', r.car_brand_id)")
    entity("ce_cars", "car_id", "car_src_id", f"car2{suffix}",
           "concat(brand, '_', model, '_', coalesce(year, 'N. A.'))",
           {"car_model_id": "car_model_id", "year": YEAR}, "brand IS NOT NULL AND model IS NOT NULL",
           "CAST(-1 AS BIGINT) AS car_model_id, -1 AS year", suffix=suffix)


car_steps("", "feed")
car_steps("_before", "feed_before")

# Second load of the car hierarchy, from the whole feed, after a first one from the earlier sales.


def second(table: str, id_col: str, src_col: str, columns: list[str], candidates: str) -> None:
    names = ", ".join(columns)
    step(f"{table}_second", f"""
SELECT * FROM {table}_before
UNION ALL
SELECT (SELECT max({id_col}) FROM {table}_before) + row_number() OVER (
    ORDER BY {src_col}, {names}, source_system, source_entity),
  {src_col}, {names}, source_system, source_entity, {DAY2}, {DAY2}
FROM {candidates} WHERE {src_col} NOT IN (SELECT {src_col} FROM {table}_before)""")


second("ce_car_brands", "car_brand_id", "brand_src_id", ["brand_name"], "ce_car_brands_candidates")
level("car1_again", "car0", "ce_car_brands_second", "car_brand_id", "brand_src_id", "r.brand")
entity("ce_car_models", "car_model_id", "model_src_id", "car1_again", "concat(model, '_', car_brand_id)",
       {"car_brand_id": "car_brand_id", "model_name": "model"}, "model <> '' AND brand <> ''",
       "CAST(-1 AS BIGINT) AS car_brand_id, 'n. a.' AS model_name", suffix="_again")
second("ce_car_models", "car_model_id", "model_src_id", ["car_brand_id", "model_name"], "ce_car_models_candidates_again")
level("car2_again", "car1_again", "ce_car_models_second", "car_model_id", "model_src_id",
      "concat(r.model, '_', r.car_brand_id)")
entity("ce_cars", "car_id", "car_src_id", "car2_again", "concat(brand, '_', model, '_', coalesce(year, 'N. A.'))",
       {"car_model_id": "car_model_id", "year": YEAR}, "brand IS NOT NULL AND model IS NOT NULL",
       "CAST(-1 AS BIGINT) AS car_model_id, -1 AS year", suffix="_again")
second("ce_cars", "car_id", "car_src_id", ["car_model_id", "year"], "ce_cars_candidates_again")

# ---- calendar ----------------------------------------------------------------------------------------------


def days(first: str, last: str) -> str:
    return (f"SELECT CAST(d AS DATE) AS \"date\" FROM (SELECT unnest(generate_series({first}, {last}, "
            "INTERVAL 1 DAY)) AS d) AS g")


def dates(source: str, anchor: str, day: str) -> str:
    return f"""
SELECT CAST(date_diff('day', {anchor}, "date") + 1 AS BIGINT) AS date_id, "date",
  CAST(day("date") AS INTEGER) AS "day", CAST(month("date") AS INTEGER) AS "month",
  CAST(year("date") AS INTEGER) AS "year", CAST(quarter("date") AS INTEGER) AS "quarter",
  'MANUAL' AS source_system, 'CALENDAR_GENERATION' AS source_entity, {day} AS insert_dt, {day} AS update_dt
FROM {source}"""


def default_date(day: str) -> str:
    return f"""
SELECT CAST(-1 AS BIGINT) AS date_id, DATE '1900-01-01' AS "date", 1 AS "day", 1 AS "month", 1900 AS "year",
  1 AS "quarter", 'MANUAL' AS source_system, 'DEFAULT_ROW' AS source_entity, {day} AS insert_dt, {day} AS update_dt"""


step("calendar_days", days("DATE '1984-01-01'", "DATE '2004-12-31'"))
step("ce_dates", default_date(DAY1) + "\nUNION ALL" + dates("calendar_days", "DATE '1984-01-01'", DAY1))
step("order_span", "SELECT CAST(min(o_orderdate) AS DATE) AS d1, CAST(max(o_orderdate) AS DATE) AS d2 FROM orders")
step("order_days", days("(SELECT d1 FROM order_span)", "(SELECT d2 FROM order_span)"))
step("sales_per_day", 'SELECT order_day AS "date", count(*) AS n_sales FROM feed GROUP BY order_day')
step("loaded_days", f"""{default_date(DAY1)}
UNION ALL
SELECT * FROM ({dates('order_days', '(SELECT d1 FROM order_span)', DAY1)}) AS a WHERE "date" <= {CUT}
UNION ALL
SELECT * FROM ({dates('order_days', '(SELECT d1 FROM order_span)', DAY2)}) AS b WHERE "date" > {CUT}""")


def date_dimension(source: str) -> str:
    return f"""
SELECT CAST(-1 AS BIGINT) AS date_surr_id, DATE '1900-01-01' AS "date", -1 AS "day", -1 AS "month", -1 AS "year",
  -1 AS "quarter", 'N' AS is_weekend, 'n. a.' AS month_name, 'n. a.' AS day_of_week, 'MANUAL' AS source_system,
  'DEFAULT_ROW' AS source_entity, {DAY2} AS insert_dt, {DAY2} AS update_dt
UNION ALL
SELECT date_id, "date", "day", "month", "year", "quarter",
  CASE WHEN dayofweek("date") IN (0, 6) THEN 'Y' ELSE 'N' END, rpad(monthname("date"), 9, ' '),
  rpad(dayname("date"), 9, ' '), 'BL_3NF', 'CE_DATES', {DAY2}, {DAY2}
FROM {source} WHERE date_id > 0"""


# ---- customers ---------------------------------------------------------------------------------------------

_SAME_PLACE = " AND ".join(f"p.{c} IS NOT DISTINCT FROM f.{c}" for c in PLACE)
_TRACKED = ["customer_first_name", "customer_last_name", "customer_email", "customer_telephone_number"]
_CUSTOMER = ["customer_src_id", *_TRACKED, "address_id"]


def customer_snapshot(name: str, rows: str) -> None:
    step(f"{name}_paths", f"""
SELECT DISTINCT f.customer_name, f.email, f.phone, f.source_system, f.source_entity, p.address_id,
  concat(coalesce(f.customer_name, 'N. A.'), '_', coalesce(f.email, 'N. A.'), '_', p.address_id) AS customer_src_id
FROM {rows} AS f JOIN (SELECT DISTINCT {', '.join(PLACE)}, address_id FROM place5) AS p ON {_SAME_PLACE}""")
    step(f"{name}_all", f"""
SELECT DISTINCT customer_src_id, {_first('customer_name')} AS customer_first_name,
  {_last('customer_name')} AS customer_last_name, coalesce(email, 'n. a.') AS customer_email,
  coalesce(phone, 'n. a.') AS customer_telephone_number, address_id, source_system, source_entity
FROM {name}_paths AS c
WHERE customer_name <> '' AND (source_system = '{OFFLINE}' OR NOT EXISTS (
  SELECT 1 FROM {name}_paths AS o WHERE o.source_system = '{OFFLINE}' AND o.customer_src_id = c.customer_src_id))""")
    step(name, f"""
SELECT * EXCLUDE (_rank) FROM (SELECT *, row_number() OVER (PARTITION BY customer_src_id ORDER BY
    customer_telephone_number DESC, customer_email DESC, customer_first_name DESC, customer_last_name DESC,
    address_id DESC, source_system DESC, source_entity DESC) AS _rank FROM {name}_all) AS r
WHERE _rank = 1""")


def first_customers(name: str, snapshot: str) -> None:
    step(name, f"""
SELECT CAST(-1 AS BIGINT) AS customer_id, 'n. a.' AS customer_src_id, 'n. a.' AS customer_first_name,
  'n. a.' AS customer_last_name, 'n. a.' AS customer_email, 'n. a.' AS customer_telephone_number,
  CAST(-1 AS BIGINT) AS address_id, {DAY1} AS start_dt, DATE '9999-12-31' AS end_dt, 'Y' AS is_active,
  'MANUAL' AS source_system, 'DEFAULT_ROW' AS source_entity, {DAY1} AS insert_dt, {DAY1} AS update_dt
UNION ALL
SELECT row_number() OVER (ORDER BY customer_src_id), {', '.join(_CUSTOMER)}, {DAY1}, DATE '9999-12-31', 'Y',
  source_system, source_entity, {DAY1}, {DAY1}
FROM {snapshot}""")


customer_snapshot("customers_full", "feed")
customer_snapshot("customers_before", "feed_before")
customer_snapshot("customers_since", "feed_since")
first_customers("ce_customers_sdc", "customers_full")
first_customers("ce_customers_first", "customers_before")
step("customer_changes", f"""
SELECT s.*, CASE WHEN c.customer_src_id IS NULL THEN 0 ELSE 1 END AS is_version
FROM customers_since AS s LEFT JOIN ce_customers_first AS c ON c.customer_src_id = s.customer_src_id
WHERE c.customer_src_id IS NULL
  OR {' OR '.join(f's.{c} IS DISTINCT FROM c.{c}' for c in _TRACKED)}""")
step("ce_customers_second", f"""
SELECT customer_id, {', '.join(_CUSTOMER)}, start_dt,
  CASE WHEN replaced THEN {DAY2} - 1 ELSE end_dt END AS end_dt,
  CASE WHEN replaced THEN 'N' ELSE is_active END AS is_active, source_system, source_entity, insert_dt, update_dt
FROM (SELECT *, customer_src_id IN (SELECT customer_src_id FROM customer_changes WHERE is_version = 1) AS replaced
      FROM ce_customers_first) AS c
UNION ALL
SELECT (SELECT max(customer_id) FROM ce_customers_first)
    + row_number() OVER (ORDER BY is_version, customer_src_id), {', '.join(_CUSTOMER)}, {DAY2},
  DATE '9999-12-31', 'Y', source_system, source_entity, {DAY2}, {DAY2}
FROM customer_changes""")

_DIM_CUSTOMER = [*_TRACKED, "customer_country", "customer_state", "customer_city", "customer_street_name",
                 "customer_building_number", "customer_postal_code"]


def flat_customers(source: str) -> str:
    return f"""
SELECT c.customer_id, CAST(c.customer_id AS VARCHAR) AS customer_src_id, {cols(_TRACKED, 'c')},
  co.country_name AS customer_country, s.state_name AS customer_state, ci.city_name AS customer_city,
  st.street_name AS customer_street_name, a.building_number AS customer_building_number,
  a.postal_code AS customer_postal_code, c.start_dt, c.end_dt, c.is_active,
  'BL_3NF' AS source_system, 'CE_CUSTOMERS_SDC' AS source_entity
FROM {source} AS c LEFT JOIN ce_addresses AS a ON c.address_id = a.address_id
  LEFT JOIN ce_streets AS st ON a.street_id = st.street_id LEFT JOIN ce_cities AS ci ON st.city_id = ci.city_id
  LEFT JOIN ce_states AS s ON ci.state_id = s.state_id LEFT JOIN ce_countries AS co ON s.country_id = co.country_id
WHERE c.customer_id > 0"""


_DIM_CUSTOMER_DEFAULT = f"""
SELECT CAST(-1 AS BIGINT) AS customer_surr_id, '-1' AS customer_src_id,
  {', '.join(f"'n. a.' AS {c}" for c in _DIM_CUSTOMER)}, {DAY1} AS start_dt, CAST(NULL AS DATE) AS end_dt,
  'Y' AS is_active, 'MANUAL' AS source_system, 'DEFAULT_ROW' AS source_entity, {DAY1} AS insert_dt,
  {DAY1} AS update_dt"""
_VERSION = ", ".join(["customer_src_id", *_DIM_CUSTOMER, "start_dt", "end_dt", "is_active", "source_system",
                      "source_entity"])
step("flat_customers_full", flat_customers("ce_customers_sdc"))
step("flat_customers_first", flat_customers("ce_customers_first"))
step("flat_customers_second", flat_customers("ce_customers_second"))
step("dim_customers_sdc", f"""{_DIM_CUSTOMER_DEFAULT}
UNION ALL
SELECT row_number() OVER (ORDER BY customer_id), {_VERSION}, {DAY1}, {DAY1} FROM flat_customers_full""")
step("dim_customers_first", f"""{_DIM_CUSTOMER_DEFAULT}
UNION ALL
SELECT row_number() OVER (ORDER BY customer_id), {_VERSION}, {DAY1}, {DAY1} FROM flat_customers_first""")
step("dim_customers_second", f"""
SELECT d.customer_surr_id, d.customer_src_id, {cols(_DIM_CUSTOMER, 'd')}, d.start_dt,
  coalesce(f.end_dt, d.end_dt) AS end_dt, coalesce(f.is_active, d.is_active) AS is_active, d.source_system,
  d.source_entity, d.insert_dt,
  CASE WHEN f.is_active <> d.is_active THEN {DAY2} ELSE d.update_dt END AS update_dt
FROM dim_customers_first AS d LEFT JOIN flat_customers_second AS f ON f.customer_src_id = d.customer_src_id
UNION ALL
SELECT (SELECT max(customer_surr_id) FROM dim_customers_first) + row_number() OVER (ORDER BY customer_id), {_VERSION},
  {DAY2}, {DAY2}
FROM flat_customers_second WHERE customer_src_id NOT IN (SELECT customer_src_id FROM dim_customers_first)""")

# ---- type-1 dimensions -------------------------------------------------------------------------------------


def dimension(table: str, surr: str, src: str, id_col: str, names: dict[str, str], entity_table: str, source: str,
              default: str) -> None:
    step(table, f"""
SELECT CAST(-1 AS BIGINT) AS {surr}, '-1' AS {src}, {default}, 'MANUAL' AS source_system,
  'DEFAULT_ROW' AS source_entity, {DAY1} AS insert_dt, {DAY1} AS update_dt
UNION ALL
SELECT row_number() OVER (ORDER BY {id_col}), CAST({id_col} AS VARCHAR), {', '.join(names)}, 'BL_3NF',
  '{entity_table}', {DAY1}, {DAY1}
FROM {source} WHERE {id_col} > 0""")


for _t, _s, _k, _i, _n in (
    ("dealers", "dealer_surr_id", "dealer_src_id", "dealer_id", "dealer_name"),
    ("payment_methods", "payment_method_surr_id", "payment_method_src_id", "payment_method_id", "method_name"),
    ("sales_channels", "sales_channel_surr_id", "sales_channel_src_id", "sales_channel_id", "channel_name"),
):
    dimension(f"dim_{_t}", _s, _k, _i, {_n: _n}, f"CE_{_t.upper()}", f"ce_{_t}", f"'n. a.' AS {_n}")
dimension("dim_employees", "employee_surr_id", "employee_src_id", "employee_id",
          dict.fromkeys(["employee_first_name", "employee_last_name"], ""), "CE_EMPLOYEES", "ce_employees",
          "'n. a.' AS employee_first_name, 'n. a.' AS employee_last_name")
step("flat_cars", """
SELECT c.car_id, CAST(c.car_id AS VARCHAR) AS car_src_id, b.brand_name, m.model_name, c.year,
  'BL_3NF' AS source_system, 'CE_CARS' AS source_entity
FROM ce_cars AS c JOIN ce_car_models AS m ON c.car_model_id = m.car_model_id
  JOIN ce_car_brands AS b ON m.car_brand_id = b.car_brand_id
WHERE c.car_id > 0""")
dimension("dim_cars", "car_surr_id", "car_src_id", "car_id", dict.fromkeys(["brand_name", "model_name", "year"], ""),
          "CE_CARS", "flat_cars", "'n. a.' AS brand_name, 'n. a.' AS model_name, -1 AS year")

# ---- sales -------------------------------------------------------------------------------------------------


def number(column: str, kind: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '\\d+(\\.\\d+)?') THEN TRY_CAST({column} AS {kind}) END"


DATE = """coalesce(CASE WHEN regexp_full_match(sale_date, '\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(sale_date AS DATE)
    WHEN regexp_full_match(sale_date, '\\d{2}/\\d{2}/\\d{4}') THEN CAST(try_strptime(sale_date, '%m/%d/%Y') AS DATE) END,
    DATE '1900-01-01')"""
MEASURES = {
    "sale_price": ("price", "DECIMAL(12,2)"), "commission_rate": ("commission_rate", "DECIMAL(20,18)"),
    "commission_earned": ("commission_earned", "DECIMAL(12,2)"),
    "reduction_percent": ("reduction_percent", "DECIMAL(5,2)"), "income": ("income", "DECIMAL(12,2)"),
}
SALE_IDS = "customer_id employee_id car_id dealer_id date_id sales_channel_id payment_method_id".split()
_PREFIX = f"CASE WHEN source_system = '{OFFLINE}' THEN 'OFFLINE_' ELSE 'ONLINE_' END || id"


def sales_found(name: str, rows: str) -> None:
    step(name, f"""
SELECT DISTINCT f.id AS sale_src_id, {_PREFIX.replace('source_system', 'f.source_system').replace('|| id', '|| f.id')}
    AS source_id,
  coalesce(cu.customer_id, -1) AS customer_id, coalesce(em.employee_id, -1) AS employee_id,
  coalesce(ca.car_id, -1) AS car_id, coalesce(de.dealer_id, -1) AS dealer_id, coalesce(da.date_id, -1) AS date_id,
  coalesce(sc.sales_channel_id, -1) AS sales_channel_id, coalesce(pm.payment_method_id, -1) AS payment_method_id,
  {', '.join(f"{number('f.' + c, kind)} AS {m}" for m, (c, kind) in MEASURES.items())},
  f.source_system, f.source_entity
FROM {rows} AS f
  LEFT JOIN ce_countries AS co ON co.country_src_id = f.country AND co.source_system <> 'MANUAL'
  LEFT JOIN ce_states AS st ON st.state_src_id = concat(f.state, '_', coalesce(co.country_id, -1))
  LEFT JOIN ce_cities AS ci ON ci.city_src_id = concat(f.city, '_', coalesce(st.state_id, -1))
  LEFT JOIN ce_streets AS sr ON sr.street_src_id = concat(f.street, '_', coalesce(ci.city_id, -1))
  LEFT JOIN ce_addresses AS ad ON ad.address_src_id = concat(f.street, '_', coalesce(sr.street_id, -1), '_',
    coalesce(f.building, 'N. A.'), '_', coalesce(f.postal, 'N. A.'))
  LEFT JOIN ce_customers_sdc AS cu ON cu.is_active = 'Y' AND cu.customer_src_id = concat(
    coalesce(f.customer_name, 'N. A.'), '_', coalesce(f.email, 'N. A.'), '_', coalesce(ad.address_id, -1))
  LEFT JOIN ce_employees AS em ON em.employee_src_id = coalesce(f.employee_id, 'N. A.')
  LEFT JOIN ce_cars AS ca ON ca.car_src_id = concat(f.brand, '_', f.model, '_', coalesce(f.year, 'N. A.'))
  LEFT JOIN ce_dealers AS de ON de.dealer_src_id = f.dealer
  LEFT JOIN ce_dates AS da ON da."date" = {DATE.replace('sale_date', 'f.sale_date')}
  LEFT JOIN ce_sales_channels AS sc ON sc.sales_channel_src_id = f.channel
  LEFT JOIN ce_payment_methods AS pm ON pm.payment_method_src_id = f.payment_method
WHERE f.id <> '' AND (f.source_system = '{OFFLINE}'
  OR f.id NOT IN (SELECT id FROM {rows} WHERE source_system = '{OFFLINE}' AND id IS NOT NULL))""")


_SALE_COLUMNS = ", ".join(["sale_src_id", "source_id", *SALE_IDS, *MEASURES, "source_system", "source_entity"])
_SALE_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in ["date_id", "sale_src_id", "source_id",
                                 *[i for i in SALE_IDS if i != "date_id"], *MEASURES]
)
sales_found("sales_full", "feed")
sales_found("sales_before", "feed_before")
step("ce_sales", f"""
SELECT row_number() OVER (ORDER BY {_SALE_ORDER}) AS sale_id, {_SALE_COLUMNS}, {DAY1} AS insert_dt, {DAY1} AS update_dt
FROM sales_full""")
step("ce_sales_twice", f"""
SELECT row_number() OVER (ORDER BY {_SALE_ORDER}) AS sale_id, {_SALE_COLUMNS}, {DAY1} AS insert_dt, {DAY1} AS update_dt
FROM sales_before
UNION ALL
SELECT (SELECT count(*) FROM sales_before) + row_number() OVER (ORDER BY {_SALE_ORDER}), {_SALE_COLUMNS}, {DAY2}, {DAY2}
FROM sales_full AS s WHERE NOT EXISTS (
  SELECT 1 FROM sales_before AS b WHERE b.sale_src_id = s.sale_src_id AND b.source_id = s.source_id)""")

PERIODS = {
    "2022_Q2": (4500, 4594), "2022_Q3": (4594, 4687), "2022_Q4": (4687, 4777), "2023_Q1": (4777, 4868),
    "2023_Q2": (4868, 4959), "2023_Q3": (4959, 5051), "2023_Q4": (5051, 5143), "2024_Q1": (5143, 5235),
    "2024_Q2": (5235, 5300),
}


def period(column: str, shift: int = 0) -> str:
    cases = " ".join(f"WHEN {column} >= {a + shift} AND {column} < {b + shift} THEN '{n}'"
                     for n, (a, b) in PERIODS.items())
    return f"CASE {cases} END"


_MEASURE_NAMES = ", ".join(MEASURES)
step("fct_sales", f"""
SELECT 1 + row_number() OVER (PARTITION BY sales_period ORDER BY sale_id) AS sale_surr_id, sale_src_id,
  coalesce(dc.customer_surr_id, -1) AS customer_surr_id, coalesce(de.employee_surr_id, -1) AS employee_surr_id,
  coalesce(dr.car_surr_id, -1) AS car_surr_id, coalesce(dd.dealer_surr_id, -1) AS dealer_surr_id,
  coalesce(dt.date_id, -1) AS date_surr_id, coalesce(dp.payment_method_surr_id, -1) AS payment_method_surr_id,
  coalesce(ds.sales_channel_surr_id, -1) AS sales_channel_surr_id, {_MEASURE_NAMES},
  CAST(CASE WHEN sale_price IS NOT NULL AND reduction_percent IS NOT NULL
       THEN sale_price * (reduction_percent * 0.01) ELSE 0 END AS DECIMAL(12,2)) AS calc_discount_value,
  CAST(CASE WHEN sale_price IS NOT NULL AND commission_rate IS NOT NULL
       THEN sale_price * (commission_rate * 0.01) ELSE 0 END AS DECIMAL(12,2)) AS calc_commission_check,
  {DAY1} AS insert_dt, {DAY1} AS update_dt, source_id, 'BL_3NF' AS source_system, 'CE_SALES' AS source_entity,
  sales_period
FROM (SELECT * EXCLUDE (source_system, source_entity, insert_dt, update_dt), {period('date_id')} AS sales_period
      FROM ce_sales) AS s
  LEFT JOIN (SELECT customer_surr_id, customer_src_id FROM dim_customers_sdc) AS dc
    ON s.customer_id = CAST(dc.customer_src_id AS BIGINT)
  LEFT JOIN (SELECT employee_surr_id, employee_src_id FROM dim_employees) AS de
    ON s.employee_id = CAST(de.employee_src_id AS BIGINT)
  LEFT JOIN (SELECT car_surr_id, car_src_id FROM dim_cars) AS dr ON s.car_id = CAST(dr.car_src_id AS BIGINT)
  LEFT JOIN (SELECT dealer_surr_id, dealer_src_id FROM dim_dealers) AS dd
    ON s.dealer_id = CAST(dd.dealer_src_id AS BIGINT)
  LEFT JOIN (SELECT date_id FROM ce_dates) AS dt ON s.date_id = dt.date_id
  LEFT JOIN (SELECT payment_method_surr_id, payment_method_src_id FROM dim_payment_methods) AS dp
    ON s.payment_method_id = CAST(dp.payment_method_src_id AS BIGINT)
  LEFT JOIN (SELECT sales_channel_surr_id, sales_channel_src_id FROM dim_sales_channels) AS ds
    ON s.sales_channel_id = CAST(ds.sales_channel_src_id AS BIGINT)
WHERE sales_period IS NOT NULL""")

# ---- upsert over the suppliers -----------------------------------------------------------------------------

step("supplier_dim_first", f"""
SELECT CAST(-1 AS BIGINT) AS dealer_surr_id, '-1' AS dealer_src_id, 'n. a.' AS dealer_name, 'MANUAL' AS source_system,
  'DEFAULT_ROW' AS source_entity, {DAY1} AS insert_dt, {DAY1} AS update_dt
UNION ALL
SELECT row_number() OVER (ORDER BY s_suppkey), CAST(s_suppkey AS VARCHAR), s_name, 'BL_3NF', 'CE_DEALERS', {DAY1}, {DAY1}
FROM supplier WHERE s_nationkey < 20""")
step("supplier_second", """
SELECT CAST(s_suppkey AS VARCHAR) AS dealer_src_id, s_suppkey,
  CASE WHEN s_acctbal < 0 THEN s_name || ' (CLOSED)' ELSE s_name END AS dealer_name
FROM supplier""")

# The feed is read once, and the known keys are distinct: the join has one match at most.
step("dealer_cars", "SELECT id, concat(dealer, '_', brand, '_', model) AS dealer_car, source_system FROM feed")
step("known_dealer_cars", f"SELECT DISTINCT dealer_car FROM dealer_cars WHERE source_system = '{OFFLINE}'")


def _violations(table: str) -> list[str]:
    """A statement for each declared rule of a table."""
    spec, out = TABLES[table], []

    def line(rule: str, columns: tuple[str, ...], counted: str) -> None:
        out.append(f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{','.join(columns)}' AS columns, "
                   f"({counted}) AS violations")

    for keys in spec.unique:
        names = ", ".join(f'"{k}"' for k in keys)
        filled = " AND ".join(f'"{k}" IS NOT NULL' for k in keys)
        line("unique", keys, f"SELECT count(*) FROM (SELECT {names} FROM {table} WHERE {filled} GROUP BY {names} "
                             "HAVING count(*) > 1)")
    for c, (parent, key) in spec.references.items():
        line("foreign key", (c,), f"SELECT count(*) FROM {table} AS c LEFT JOIN (SELECT DISTINCT {key} AS k FROM {parent}) "
                                  f"AS p ON p.k = c.{c} WHERE c.{c} IS NOT NULL AND p.k IS NULL")
    rows = [("not null", c, f'"{c}" IS NULL') for c in spec.not_null]
    rows += [("domain", c, f"{c} NOT IN ({', '.join(map(repr, allowed))})") for c, allowed in spec.domains.items()]
    rows += [("length", c, f"length({c}) > {n}") for c, n in spec.lengths.items()]
    if spec.partition_by:
        rows.append(("period", "date_surr_id", f"({period('date_surr_id', 7)}) IS DISTINCT FROM {spec.partition_by}"))
    for rule, c, broken in rows:
        line(rule, (c,), f"SELECT count(*) FROM {table} WHERE {broken}")
    return out


_MEMBERS = ("ce_countries ce_states ce_cities ce_streets ce_addresses ce_car_brands ce_car_models ce_cars "
            "ce_employees ce_dealers ce_payment_methods ce_sales_channels ce_customers_sdc ce_dates").split()


def oracle_statements() -> dict[str, str]:
    found = {
        "csv_scan": f"""
SELECT {', '.join(f'{c} AS {n}' for c, n in _OFFLINE_NAMES.items())} FROM sale_lines WHERE return_flag <> 'R'""",
        "csv_scan_online": f"""
SELECT {', '.join(f"{c if c == 'sale_date' else f"' ' || lower({c}) || '  '"} AS {n}" for c, n in _ONLINE_NAMES.items())}
FROM sale_lines WHERE return_flag = 'R'""",
        "csv_rejects": """
SELECT problem, count(*) AS n_lines FROM (
  SELECT CASE WHEN o % 11 = 0 THEN 'missing columns' WHEN o % 13 = 0 THEN 'surplus columns'
    WHEN o % 17 = 0 THEN 'open quote' ELSE 'none' END AS problem
  FROM (SELECT CAST(split_part(id, '-', 1) AS BIGINT) AS o FROM sale_lines WHERE return_flag <> 'R') AS l) AS p
GROUP BY problem""",
        "staging_union": f"SELECT {', '.join(CANONICAL)}, source_system, source_entity FROM feed",
        "staged_drops": f"""
SELECT {', '.join(CANONICAL)}, source_system, source_entity,
  CAST(CASE WHEN order_day < {CUT} THEN 1 ELSE 2 END AS BIGINT) AS "drop" FROM feed""",
        "safe_casts": f"""
SELECT id, source_system, {', '.join(f"{number(c, kind)} AS {m}" for m, (c, kind) in MEASURES.items())},
  {YEAR} AS car_year, {DATE} AS sale_day FROM feed""",
        "cast_rejects": f"""
SELECT source_system, count(*) AS n_sales,
  CAST(sum(CASE WHEN (regexp_full_match(sale_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
      OR regexp_full_match(sale_date, '\\d{{2}}/\\d{{2}}/\\d{{4}}')) AND {DATE} = DATE '1900-01-01'
      THEN 1 ELSE 0 END) AS BIGINT) AS bad_dates,
  CAST(sum(CASE WHEN {number('price', 'DECIMAL(12,2)')} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_price
FROM feed GROUP BY source_system""",
        "name_split": f"""
SELECT id, source_system, {_first('customer_name')} AS customer_first_name, {_last('customer_name')}
  AS customer_last_name, {_first('employee_name')} AS employee_first_name, {_last('employee_name')}
  AS employee_last_name FROM feed""",
        "name_edges": f"""
SELECT id, source_system, {_first('name')} AS first_name, {_last('name')} AS last_name FROM (
  SELECT id, source_system, CASE CAST(split_part(id, '-', 1) AS BIGINT) % 5 WHEN 1 THEN country WHEN 2 THEN ''
    WHEN 3 THEN country || '  ' || brand WHEN 4 THEN country || ' ' || model || ' ' || brand END AS name
  FROM feed) AS f""",
        "long_keys": """
SELECT substr(k, 1, 30) AS stored, count(*) AS n_keys, count(*) FILTER (WHERE length(k) > 30) AS n_cut
FROM (SELECT DISTINCT concat(customer_name, '_', street, '_', model) AS k FROM feed) AS f
GROUP BY substr(k, 1, 30) HAVING count(*) FILTER (WHERE length(k) > 30) > 0""",
        "key_concat": """
SELECT id, source_system, concat(state, '_', -1) AS state_key,
  concat(street, '_', -1, '_', coalesce(building, 'N. A.'), '_', coalesce(postal, 'N. A.')) AS address_key,
  concat(brand, '_', model, '_', coalesce(year, 'N. A.')) AS car_key,
  coalesce(building, 'n. a.') AS building_number, 'S_' || state AS state_tag FROM feed""",
        "load_dealers": "SELECT * FROM ce_dealers",
        "load_payment_methods": "SELECT * FROM ce_payment_methods",
        "load_sales_channels": "SELECT * FROM ce_sales_channels",
        "load_brands": "SELECT * FROM ce_car_brands",
        "load_countries": "SELECT * FROM ce_countries",
        "load_employees": "SELECT * FROM ce_employees",
        "load_states": "SELECT * FROM ce_states",
        "load_cities": "SELECT * FROM ce_cities",
        "load_streets": "SELECT * FROM ce_streets",
        "load_addresses": "SELECT * FROM ce_addresses",
        "load_models": "SELECT * FROM ce_car_models",
        "load_cars": "SELECT * FROM ce_cars",
        "load_customers": "SELECT * FROM ce_customers_sdc",
        "incremental_insert": "SELECT * FROM ce_cars_second",
        "incremental_sales": "SELECT * FROM ce_sales_twice",
        "calendar": 'SELECT d.*, coalesce(n_sales, 0) AS n_sales FROM loaded_days AS d '
                    'LEFT JOIN sales_per_day AS n ON n."date" = d."date"',
        "dim_dates": f'SELECT d.*, coalesce(n_sales, 0) AS n_sales FROM ({date_dimension("loaded_days")}) AS d '
                     'LEFT JOIN sales_per_day AS n ON n."date" = d."date"',
        "customers_scd2": "SELECT * FROM ce_customers_second",
        "customer_conflicts": """
SELECT customer_src_id, count(*) AS variants FROM customers_full_all GROUP BY customer_src_id HAVING count(*) > 1""",
        "dim_customers_scd2": "SELECT * FROM dim_customers_second",
        "dim_cars_flat": "SELECT * FROM flat_cars",
        "dim_cars": "SELECT * FROM dim_cars",
        "dim_employees": "SELECT * FROM dim_employees",
        "dim_dealers": "SELECT * FROM dim_dealers",
        "dim_payment_methods": "SELECT * FROM dim_payment_methods",
        "dim_sales_channels": "SELECT * FROM dim_sales_channels",
        "dim_upsert_type1": f"""
SELECT d.dealer_surr_id, d.dealer_src_id, coalesce(s.dealer_name, d.dealer_name) AS dealer_name, d.source_system,
  d.source_entity, d.insert_dt,
  CASE WHEN s.dealer_name <> d.dealer_name THEN {DAY2} ELSE d.update_dt END AS update_dt
FROM supplier_dim_first AS d LEFT JOIN supplier_second AS s ON s.dealer_src_id = d.dealer_src_id
UNION ALL
SELECT (SELECT max(dealer_surr_id) FROM supplier_dim_first) + row_number() OVER (ORDER BY s_suppkey), dealer_src_id,
  dealer_name, 'BL_3NF', 'CE_DEALERS', {DAY2}, {DAY2}
FROM supplier_second WHERE dealer_src_id NOT IN (SELECT dealer_src_id FROM supplier_dim_first)""",
        "sales_3nf": "SELECT * FROM ce_sales",
        "fct_sales": "SELECT * FROM fct_sales",
        "fct_partition_overwrite": f"""
SELECT * REPLACE (CASE WHEN sales_period = '2022_Q3' THEN {DAY2} ELSE insert_dt END AS insert_dt,
  CASE WHEN sales_period = '2022_Q3' THEN {DAY2} ELSE update_dt END AS update_dt)
FROM fct_sales WHERE sales_period <> '2022_Q2'""",
        "run_twice": f"SELECT * REPLACE ({DAY2} AS insert_dt, {DAY2} AS update_dt) FROM fct_sales",
        "reopened_store": "SELECT * FROM ce_sales",
        "ordered_cities": "SELECT * FROM ce_cities ORDER BY city_name, city_id",
        "fct_uncovered": f"SELECT * FROM ce_sales WHERE {period('date_id')} IS NULL",
        "city_counts": "SELECT city_name, count(*) AS n_rows FROM ce_cities GROUP BY city_name",
        "entity_counts": "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _MEMBERS),
        "log_history": """
SELECT 'LOAD_CE_DEALERS' AS procedure_name, CAST(-1 AS BIGINT) AS rows_affected,
  'Error: the feed is gone' AS log_message, 'Error' AS status
UNION ALL
SELECT 'LOAD_CE_DEALERS', 0, 'Successfully loaded dealers. New rows: 0, Default rows: 0', 'Success'
UNION ALL
SELECT 'LOAD_CE_DEALERS', count(*), 'Successfully loaded dealers. New rows: ' || CAST(count(*) - 1 AS VARCHAR)
  || ', Default rows: 1', 'Success' FROM ce_dealers""",
        "dq_unique": """
SELECT id, source_system, count(*) AS copies FROM feed WHERE id IS NOT NULL GROUP BY id, source_system
HAVING count(*) > 1""",
        "dq_not_null": "SELECT id, source_system, state, building, email FROM feed "
                       "WHERE state IS NULL OR building IS NULL OR email IS NULL",
        "dq_fk": f"""
SELECT f.id, f.dealer_car FROM dealer_cars AS f LEFT JOIN known_dealer_cars AS k ON k.dealer_car = f.dealer_car
WHERE f.source_system = '{ONLINE}' AND k.dealer_car IS NULL""",
        "dq_domain": "SELECT id, source_system, channel FROM feed WHERE channel NOT IN ('F', 'O')",
        "dq_length": "SELECT id, source_system, street FROM feed WHERE length(street) > 9",
        "dq_bounds": f"""
SELECT sale_src_id, source_id, sales_period, date_surr_id FROM fct_sales
WHERE ({period('date_surr_id', 7)}) IS DISTINCT FROM sales_period""",
        "log_periods": "\nUNION ALL\n".join(f"""
SELECT 'LOAD_FCT_SALES' AS procedure_name, count(*) AS rows_affected,
  '{name}: date ids {first} to {end - 1}, rows: ' || CAST(count(*) AS VARCHAR) AS log_message, 'Success' AS status
FROM fct_sales WHERE sales_period = '{name}'""" for name, (first, end) in PERIODS.items()),
        "log_times": "\nUNION ALL\n".join(
            f"SELECT count(*) AS rows_affected, TRUE AS in_run, CAST({i} AS BIGINT) AS place FROM {t}"
            for i, t in enumerate(("ce_dealers", "ce_payment_methods", "ce_sales_channels"), 1)),
        "csv_rejects_online": """
SELECT problem, count(*) AS n_lines FROM (
  SELECT CASE WHEN o % 11 = 0 THEN 'missing columns' WHEN o % 13 = 0 THEN 'surplus columns'
    WHEN o % 17 = 0 THEN 'open quote' ELSE 'none' END AS problem
  FROM (SELECT CAST(split_part(id, '-', 1) AS BIGINT) AS o FROM sale_lines WHERE return_flag = 'R') AS l) AS p
GROUP BY problem""",
    }
    once = {"check_report": "\nUNION ALL\n".join(
        line for table in (*[t.name for t in ENTITIES], "fct_sales") for line in _violations(table)),
        "dq_fk": found.pop("dq_fk")}
    return {**{name: statement(sql) for name, sql in found.items()},
            **{name: statement(sql, "MATERIALIZED ") for name, sql in once.items()}}


# Column of a sale line -> its name in the offline feed.
_OFFLINE_NAMES = {
    "id": "id", "sale_date": '"date"', "employee_id": "salespersonid", "employee_name": "salesperson",
    "customer_name": "customername", "country": "customercountry", "state": "customerstate",
    "postal": "customerpostalcode", "city": "customercity", "street": "customerstreetname",
    "building": "customerbuildingnumber", "phone": "customertelephonenumber", "email": "customeremail",
    "brand": "carmake", "model": "carmodel", "year": "caryear", "price": "saleprice",
    "commission_rate": "commissionrate", "commission_earned": "commissionearned",
    "payment_method": "paymentmethod", "channel": "saleschannel", "dealer": "cardelername",
}

# Column of a sale line -> its name in the online feed.
_ONLINE_NAMES = {
    "id": "id", "sale_date": "date_of_transaction", "employee_id": "employee_id", "employee_name": "employee",
    "customer_name": "customer_name_and_surname", "country": "customer_country", "state": "customer_state",
    "postal": "customer_postal_code", "city": "customer_city", "street": "customer_street_name",
    "building": "customer_building_number", "phone": "customer_telephone_number", "email": "customer_email",
    "brand": "brand", "model": "car_model", "year": "car_year", "price": "car_price",
    "reduction_percent": "reduction_percent", "income": "income", "payment_method": "payment_method",
    "channel": "sales_channel", "dealer": "car_dealer_name",
}

"""The two delimited sales feeds: scan, staging copy, and one conformed shape for both."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.functions.text import CLEAN_SQL
from lotbook.sources.scratch import dropped_shuffles

# Canonical column -> column of the feed, in the column order of the feed files.
_OFFLINE_COLUMNS = {
    "id": "id",
    "sale_date": "date",
    "employee_id": "salespersonid",
    "employee_name": "salesperson",
    "customer_name": "customername",
    "country": "customercountry",
    "state": "customerstate",
    "postal": "customerpostalcode",
    "city": "customercity",
    "street": "customerstreetname",
    "building": "customerbuildingnumber",
    "phone": "customertelephonenumber",
    "email": "customeremail",
    "brand": "carmake",
    "model": "carmodel",
    "year": "caryear",
    "price": "saleprice",
    "commission_rate": "commissionrate",
    "commission_earned": "commissionearned",
    "payment_method": "paymentmethod",
    "channel": "saleschannel",
    "dealer": "cardelername",
}
_ONLINE_COLUMNS = {
    "id": "id",
    "sale_date": "date_of_transaction",
    "employee_id": "employee_id",
    "employee_name": "employee",
    "customer_name": "customer_name_and_surname",
    "country": "customer_country",
    "state": "customer_state",
    "postal": "customer_postal_code",
    "city": "customer_city",
    "street": "customer_street_name",
    "building": "customer_building_number",
    "phone": "customer_telephone_number",
    "email": "customer_email",
    "brand": "brand",
    "model": "car_model",
    "year": "car_year",
    "price": "car_price",
    "reduction_percent": "reduction_percent",
    "income": "income",
    "payment_method": "payment_method",
    "channel": "sales_channel",
    "dealer": "car_dealer_name",
}


@dataclass(frozen=True)
class Feed:
    system: str
    entity: str
    sale_prefix: str
    columns: dict[str, str]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, T.StringType()) for name in self.columns.values()])


OFFLINE = Feed("SA_CAR_SALES_OFFLINE", "SRC_CAR_SALES_OFFLINE", "OFFLINE_", _OFFLINE_COLUMNS)
ONLINE = Feed("SA_CAR_SALES_ONLINE", "SRC_CAR_SALES_ONLINE", "ONLINE_", _ONLINE_COLUMNS)
FEED_SYSTEMS = (OFFLINE.system, ONLINE.system)

# Every column either feed has, in the order of the conformed shape.
CANONICAL = tuple(dict.fromkeys([*_OFFLINE_COLUMNS, *_ONLINE_COLUMNS]))
LINEAGE = ("source_system", "source_entity")


_CSV = {"sep": ";", "quote": '"', "escape": '"', "nullValue": "\u0000"}
_CORRUPT = "_corrupt_record"


def _problem(line: Column, feed: Feed) -> Column:
    """What is wrong with a line, or NULL: an open quote, or missing or surplus columns."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    # The pattern is costly, and most lines hold no quote.
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"(?:[^"]|"")*"', "")).otherwise(line)
    n_columns = F.length(bare) - F.length(F.replace(bare, F.lit(";"), F.lit(""))) + 1
    # Told by the sign, so that the columns are counted once.
    told = F.array(F.lit("missing columns"), F.lit(None).cast("string"), F.lit("surplus columns"))
    return F.when(quotes % 2 == 1, "open quote").otherwise(
        F.element_at(told, (F.signum(n_columns - len(feed.columns)) + 2).cast("int")))


def judged_lines(lines: DataFrame, feed: Feed) -> DataFrame:
    """Lines with their ``problem``. Header lines, the column names in any case, and empty lines are left out."""
    lines = lines.withColumnRenamed("value", "line")
    plain = F.lower(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    rows = lines.filter((plain != ";".join(feed.columns.values()).lower()) & (F.col("line") != ""))
    return rows.select("line", _problem(F.col("line"), feed).alias("problem"))


def _multi_line(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    schema = T.StructType([*feed.schema, T.StructField(_CORRUPT, T.StringType())])
    return spark.read.schema(schema).options(
        **_CSV, header=True, multiLine=True, columnNameOfCorruptRecord=_CORRUPT).csv(path)


def parsed(feed: Feed) -> Column:
    """The record of a sound ``line``."""
    return F.from_csv("line", ", ".join(f"`{name}` STRING" for name in feed.columns.values()), _CSV)


def read_csv(spark: SparkSession, path: str, feed: Feed, multi_line: bool = False) -> DataFrame:
    """All-text scan of the sound records. Unquoted empty is NULL, quoted empty stays ``''``.

    Records with missing or surplus columns or an open quote are no sales; :func:`csv_rejects` gives them. Without
    ``multi_line`` a line end inside quotes makes two such records; with it, it belongs to the value, at the price of
    one task per file.
    """
    if multi_line:
        return _multi_line(spark, path, feed).filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    sound = judged_lines(spark.read.text(path), feed).filter("problem IS NULL")
    return sound.select(parsed(feed).alias("r")).select("r.*")


def csv_rejects(spark: SparkSession, path: str, feed: Feed, multi_line: bool = False) -> DataFrame:
    """Records that :func:`read_csv` puts aside: ``problem`` and ``line``."""
    if multi_line:
        # The reader refuses to give the corrupt record alone, so a real column is asked for as well.
        some = F.length(F.coalesce(F.col(f"`{next(iter(feed.columns.values()))}`"), F.lit(""))) >= 0
        broken = _multi_line(spark, path, feed).filter(F.col(_CORRUPT).isNotNull() & some)
        line = F.col(_CORRUPT)
        return broken.select(F.coalesce(_problem(line, feed), F.lit("unreadable")).alias("problem"), line.alias("line"))
    return judged_lines(spark.read.text(path), feed).filter("problem IS NOT NULL").select("problem", "line")


def stage(feed_rows: DataFrame, path: str) -> DataFrame:
    """Columnar copy of a feed; running it again replaces the copy."""
    with dropped_shuffles(feed_rows.sparkSession):
        feed_rows.write.mode("overwrite").parquet(path)
    return feed_rows.sparkSession.read.schema(feed_rows.schema).parquet(path)


def conform(staged: DataFrame, feed: Feed) -> DataFrame:
    """One feed in the canonical columns, cleaned, with lineage and NULL for columns it lacks.

    The sale date stays as it came: its shape is tested on the untrimmed text.
    """

    def canonical(name: str) -> str:
        if name not in feed.columns:
            return f"CAST(NULL AS STRING) AS `{name}`"
        raw = f"`{feed.columns[name]}`"
        return f"{raw} AS `{name}`" if name == "sale_date" else f"{CLEAN_SQL.format(raw)} AS `{name}`"

    return staged.selectExpr(
        *[canonical(name) for name in CANONICAL],
        f"'{feed.system}' AS source_system",
        f"'{feed.entity}' AS source_entity",
    )


def conformed_union(offline: DataFrame, online: DataFrame) -> DataFrame:
    return conform(offline, OFFLINE).unionByName(conform(online, ONLINE))


def is_offline() -> Column:
    return F.col("source_system") == OFFLINE.system

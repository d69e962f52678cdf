"""The two sales feeds, derived from the provided star-schema tables.

Lines that were not returned make up the offline feed, returned ones the online feed. The online texts are
padded and lower-cased, some texts are missing, and some prices and dates are malformed.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotbook.sources.feeds import OFFLINE, ONLINE, conformed_union, stage
from lotbook.sources.scratch import LEAN_CODEC, dropped_shuffles, new_folder

LOAD_DT = dt.date(2024, 7, 1)
NEXT_LOAD_DT = dt.date(2024, 8, 1)
CUT_DATE = dt.date(1998, 6, 15)
# The tables hold sales of 1995 to 2001. A calendar of the default length that starts in 1984 puts them on both
# sides of the default periods.
CALENDAR = (dt.date(1984, 1, 1), dt.date(2004, 12, 31))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPREAD_ROWS = 5_000_000  # tables up to this size are dealt to all cores first


def spread(rows: DataFrame) -> DataFrame:
    """Give small tables to all cores.

    A provided table is one file with one row group, which a single task reads. Tables of more than a few
    million rows have enough row groups and are left as they are.
    """
    total = rows.count()  # from the file footer
    if total > SPREAD_ROWS:
        return rows
    tasks = min(rows.sparkSession.sparkContext.defaultParallelism, total // 25_000 + 1)
    return rows.repartition(tasks) if tasks > 1 else rows


LINE_ROWS = 1_000_000  # lines that one task of the last join should hold at most


def dealt_by_order(lines: DataFrame, total: int) -> DataFrame:
    """Lines of a large table, dealt by their order over tasks whose number follows from the rows.

    Left to itself, the engine packs lines of a few bytes into tasks of 64 MB, so that a task holds millions of them, and
    what follows the join in the task, such as grouping, takes memory for all of them.
    """
    if total <= SPREAD_ROWS:
        return lines
    tasks = max(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // LINE_ROWS + 1)
    return lines.repartition(tasks, "l_orderkey")


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)").cast("string")


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with everything a feed row is made of, as clean text."""

    def t(name):
        return table(spark, sf_dir, name)

    # Each join is made where its rows are fewest: what an order has is joined to it, and its date written, before the
    # lines are; the lines have only a few columns when they are dealt by part, and are dealt by order last.
    customers = (
        t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    order, line, customer = F.col("l_orderkey"), F.col("l_linenumber"), F.col("c_custkey")
    number, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    sale_date = (
        F.when(number % 97 == 0, F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd")))
        .when(number % 89 == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(number % 101 == 0, F.concat(F.date_format(day, "yyyy"), F.lit("-13-45")))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    orders = t("orders").join(customers, F.col("o_custkey") == customer).select(
        "*", sale_date.alias("sale_date"), day.alias("order_day"))
    items = t("lineitem")
    total = items.count()  # from the file footer
    lines = (
        dealt_by_order(
            spread(items).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")), total)
        .join(orders if total <= SPREAD_ROWS else orders.hint("merge"), order == number)  # dealt lines stay in place
    )
    return lines.select(
        F.concat(order.cast("string"), F.lit("-"), line.cast("string")).alias("id"),
        "sale_date",
        F.replace(F.col("p_name"), F.lit(" "), F.lit("")).alias("employee_id"),
        F.col("p_name").alias("employee_name"),
        F.concat(F.col("c_name"), F.lit(" "), F.col("c_mktsegment")).alias("customer_name"),
        F.col("r_name").alias("country"),
        F.when(customer % 53 != 0, F.col("n_name")).alias("state"),
        F.concat(F.lit("P"), (customer % 100).cast("string")).alias("postal"),
        F.when(customer % 31 == 0, F.lit(" ")).otherwise(F.col("c_mktsegment")).alias("city"),
        F.concat(F.lit("Street "), F.floor(customer / 10).cast("string")).alias("street"),
        F.when(customer % 37 != 0, customer.cast("string")).alias("building"),
        F.col("o_orderpriority").alias("phone"),
        F.when(customer % 41 != 0, F.concat(F.lit("c"), customer.cast("string"), F.lit("@mail.test")))
        .alias("email"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("model"),
        F.when(F.col("p_size") == 13, F.lit("99")).otherwise((F.col("p_size") + 1990).cast("string"))
        .alias("year"),
        F.when(line == 7, F.lit("N/A")).otherwise(_money("l_extendedprice")).alias("price"),
        F.col("l_tax").cast("decimal(12,2)").cast("string").alias("commission_rate"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_tax").cast("decimal(12,2)"))
        .cast("decimal(12,2)").cast("string").alias("commission_earned"),
        (F.col("l_discount").cast("decimal(12,2)") * 100).cast("decimal(12,2)").cast("string")
        .alias("reduction_percent"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(12,2)"))
        .cast("decimal(12,2)").cast("string").alias("income"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("channel"),
        F.col("s_name").alias("dealer"),
        F.col("l_returnflag").alias("return_flag"),
        "order_day",
    )


def offline_feed(lines: DataFrame) -> DataFrame:
    rows = lines.filter("return_flag <> 'R'")
    return rows.selectExpr(*[f"`{c}` AS `{name}`" for c, name in OFFLINE.columns.items()], "order_day")


def online_feed(lines: DataFrame) -> DataFrame:
    rows = lines.filter("return_flag = 'R'")

    def text(name: str) -> str:
        return f"`{name}`" if name == "sale_date" else f"concat(' ', lower(`{name}`), '  ')"

    return rows.selectExpr(*[f"{text(c)} AS `{name}`" for c, name in ONLINE.columns.items()], "order_day")


@dataclass(frozen=True)
class Staged:
    """Both feeds and their conformed union."""

    offline: DataFrame
    online: DataFrame

    @cached_property
    def feed(self) -> DataFrame:
        return conformed_union(self.offline, self.online)

    def before(self, day: dt.date) -> DataFrame:
        return self._where(F.col("order_day") < F.lit(day))

    def since(self, day: dt.date) -> DataFrame:
        return self._where(F.col("order_day") >= F.lit(day))

    def _where(self, condition: Column) -> DataFrame:
        return conformed_union(self.offline.filter(condition), self.online.filter(condition))


def unstaged(spark: SparkSession, sf_dir: str) -> Staged:
    """Both feeds without a staging copy, for queries that read them only once or twice."""
    lines = sale_lines(spark, sf_dir)
    return Staged(offline_feed(lines), online_feed(lines))


def as_text(rows: DataFrame) -> DataFrame:
    """Rows of a feed as delimited lines in the column ``value``."""
    return rows.select(F.concat_ws(";", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in rows.columns]).alias("value"))


def csv_lines(rows: DataFrame) -> DataFrame:
    """Rows of the offline feed as delimited lines, some of them broken, in the column ``value``.

    By order number: the last column missing, one too many, a quote that is not closed.
    """
    order = F.split("id", "-")[0].cast("long")
    cells = [F.coalesce(F.col(c), F.lit("")) for c in rows.columns]
    whole = F.concat_ws(";", *cells)
    line = (
        F.when(order % 11 == 0, F.concat_ws(";", *cells[:-1])).when(order % 13 == 0, F.concat(whole, F.lit(";more")))
        .when(order % 17 == 0, F.concat_ws(";", *cells[:-1], F.concat(F.lit('"'), cells[-1]))).otherwise(whole)
    )
    return rows.select(line.alias("value"))


def staged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds through their staging copies to the conformed union."""
    lines = sale_lines(spark, sf_dir)
    return conformed_union(
        stage(offline_feed(lines).drop("order_day"), new_folder(spark, "offline")),
        stage(online_feed(lines).drop("order_day"), new_folder(spark, "online")))


def staged(spark: SparkSession, sf_dir: str) -> Staged:
    """Both feeds over one columnar copy, written in a single pass with a folder per return flag."""
    lines = sale_lines(spark, sf_dir)
    folder = new_folder(spark, "staging")
    with dropped_shuffles(spark):
        lines.write.option("compression", LEAN_CODEC).partitionBy("return_flag").parquet(folder)
    copy = spark.read.schema(lines.schema).parquet(folder)
    return Staged(offline_feed(copy), online_feed(copy))

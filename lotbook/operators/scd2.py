"""Type-2 history: versions of a natural key with validity dates and an active flag."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotbook.operators.insert_only import append_new, next_id, with_stamps
from lotbook.operators.lookup import lookup_join, touched_rows, unique_join
from lotbook.operators.surrogate import assign_surrogate
from lotbook.schemas import OPEN_END, TABLES, Table
from lotbook.sources.store import ACTIVE, DIGEST, Store, digest

NEW, VERSION = "new", "version"


def one_row_per_key(snapshot: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row with the largest ``order`` columns of each key; pre-aggregated before the shuffle."""
    rest = [c for c in snapshot.columns if c != key]
    ranked = [*order, *[c for c in rest if c not in order]]
    best = snapshot.groupBy(key).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])


def conflicting_keys(snapshot: DataFrame, key: str) -> DataFrame:
    """Keys a snapshot holds with more than one set of attributes, and how many."""
    variants = snapshot.distinct().groupBy(key).agg(F.count("*").alias("variants"))
    return variants.filter(F.col("variants") > 1)


def differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when any pair of columns differs; two NULLs are equal."""
    changed = F.lit(False)
    for one, other in zip(left, right, strict=True):
        changed = changed | ~one.eqNullSafe(other)
    return changed


def tracked_digest(spec: Table) -> Column:
    """Digest of a row's tracked columns, as the store keeps it."""
    return digest([spec.compared(F.col(c)) for c in spec.tracked])


def detect_versions(stored: DataFrame, snapshot: DataFrame, key: str, tracked: Column,
                    known_rows: int | None = None) -> DataFrame:
    """Snapshot rows that need a row in the table, with ``change``: a new key, or a changed active version.

    ``tracked`` is the digest of a snapshot row. A key whose versions are all closed stays closed. Of the stored rows only key, flag and digest are read; they are
    reduced to the keys of a small snapshot, of which ``known_rows`` is an upper bound, and then to one state per key,
    so both sides of the join are unique.
    """
    rows = touched_rows(stored.select(key, ACTIVE, DIGEST), snapshot, [key], known_rows)
    state = rows.groupBy(key).agg(
        F.max(F.when(F.col(ACTIVE) == "Y", F.col(DIGEST))).alias("_active"), F.lit(True).alias("_known"))
    joined = unique_join(snapshot, state, key, known_rows)
    change = F.when(F.col("_known").isNull(), F.lit(NEW)).when(
        F.col("_active").isNotNull() & (F.col("_active") != tracked), F.lit(VERSION)
    )
    return joined.withColumn("change", change).filter("change IS NOT NULL").drop("_active", "_known")


def opened_versions(rows: DataFrame, load_dt: dt.date) -> DataFrame:
    return (
        rows.withColumn("start_dt", F.lit(load_dt).cast("date"))
        .withColumn("end_dt", F.lit(OPEN_END).cast("date"))
        .withColumn("is_active", F.lit("Y"))
    )


def scd2_merge(
    store: Store, table: str, snapshot: DataFrame, load_dt: dt.date, known_rows: int | None = None,
) -> dict[str, int]:
    """Open versions for new and changed keys and close the versions they replace.

    ``snapshot`` holds the natural key, the attributes and the lineage, one row per key; ``known_rows`` is an
    upper bound of its rows. Where versions are closed, the active rows of their buckets are written anew; closed
    versions and new rows are added beside what is there.
    """
    spec = TABLES[table]
    key = spec.src_col
    first, before = next_id(store, table), store.rows(table)
    if before:
        changes = detect_versions(store.read_parts(table), snapshot, key, tracked_digest(spec), known_rows)
    else:
        changes = snapshot.withColumn("change", F.lit(NEW))
    numbered = assign_surrogate(changes, "_number", [key], within=["change"], known_rows=known_rows,
                                once=True, lean=True)
    new_keys, versions = numbered.counts.get((NEW,), 0), numbered.counts.get((VERSION,), 0)
    shift = F.when(F.col("change") == VERSION, F.lit(new_keys)).otherwise(F.lit(0))
    opened = opened_versions(
        numbered.rows.withColumn(spec.id_col, F.col("_number") + shift + F.lit(first - 1)), load_dt
    )
    default_rows = 0
    if versions:
        replaced = numbered.rows.filter(F.col("change") == VERSION).select(key, F.lit(True).alias("_replaced"))
        touched = touched_parts(store, table, replaced.withColumn(ACTIVE, F.lit("Y")))
        current = lookup_join(store.read_parts(table, touched), replaced, [key], known_rows=versions)
        ends = F.col("_replaced").isNotNull()
        kept = (
            current.withColumn("end_dt", F.when(ends, F.date_sub(F.lit(load_dt), 1)).otherwise(F.col("end_dt")))
            .withColumn(ACTIVE, F.when(ends, F.lit("N")).otherwise(F.col(ACTIVE)))
        )
        added = with_stamps(opened, load_dt).select(*spec.columns)
        store.commit(table, kept.select(*spec.columns).unionByName(added), touched, before + new_keys + versions)
    else:
        _, default_rows = append_new(store, table, opened, load_dt, known_rows=new_keys)
    # The labels of the log message.
    return {"New customers": new_keys, "SCD Old Updated": versions, "SCD New Versions": versions,
            "Default rows": default_rows}


def touched_parts(store: Store, table: str, rows: DataFrame) -> set[tuple[str, int]]:
    """The (active flag, bucket) pairs in which rows given by key and flag lie; as many as there are buckets at most."""
    spec = TABLES[table]
    flag = F.col(ACTIVE) if spec.has_history else F.lit("")
    pairs = rows.select(flag.alias("flag"), store.bucket(table, F.col(spec.bucket_by)).alias("bucket")).distinct()
    return {(r["flag"], r["bucket"]) for r in pairs.collect()}


INSERT, CARRY, REOPEN = "insert", "carry", "reopen"


def latest_rows(dimension: DataFrame, key: str, id_col: str) -> DataFrame:
    """The row with the largest surrogate of each key."""
    rest = [c for c in dimension.columns if c not in (key, id_col)]
    best = dimension.groupBy(key).agg(F.max(F.struct(id_col, *rest)).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in (id_col, *rest)])


def detect_mirror_changes(
    stored: DataFrame, source: DataFrame, key: str, id_col: str, tracked: Column, validity: Sequence[str],
    known_rows: int | None = None,
) -> DataFrame:
    """Source versions the dimension lacks or holds differently, with ``change``, the row to touch and its flag.

    ``insert``: unknown version. ``carry``: same attributes, other validity. ``reopen``: other attributes. Of the
    stored rows only number, key, validity and digest are read; ``tracked`` is the digest of a source row.
    """
    rows = touched_rows(stored.select(key, id_col, *validity, DIGEST), source, [key], known_rows)
    latest = latest_rows(rows, key, id_col).select(
        key, F.col(id_col).alias("_row"), F.col(DIGEST).alias("_old"), *[F.col(c).alias(f"_old_{c}") for c in validity])
    joined = unique_join(source, latest, key, known_rows)
    change = (
        F.when(F.col("_row").isNull(), F.lit(INSERT))
        .when(F.col("_old") != tracked, F.lit(REOPEN))
        .when(differs([F.col(c) for c in validity], [F.col(f"_old_{c}") for c in validity]), F.lit(CARRY))
    )
    return (
        joined.withColumn("change", change).filter("change IS NOT NULL")
        .withColumnRenamed(f"_old_{ACTIVE}", "_flag").drop("_old", *[f"_old_{c}" for c in validity])
    )


def mirror_scd2(
    store: Store, table: str, source: DataFrame, load_dt: dt.date, order_by: Sequence[str],
    known_rows: int | None = None,
) -> dict[str, int]:
    """Bring a type-2 dimension in step with the versions of the entity layer.

    Closings are carried over. A version whose attributes changed without a new version closes its row and gets
    another one. Comparisons treat NULLs as equal, so a second run changes nothing. Only the parts of the table are
    written anew in which rows are touched.
    """
    spec = TABLES[table]
    id_col = spec.id_col
    validity = ("start_dt", "end_dt", ACTIVE)
    first, before = next_id(store, table), store.rows(table)
    if before:
        changes = detect_mirror_changes(store.read_parts(table), source, spec.src_col, id_col, tracked_digest(spec),
                                        validity, known_rows)
    else:
        changes = source.withColumn("_row", F.lit(None).cast("bigint")).withColumn("change", F.lit(INSERT))
    numbered = assign_surrogate(changes, "_number", order_by, within=["change"], known_rows=known_rows,
                                once=True, lean=True)
    inserts, carries, reopened = (numbered.counts.get((kind,), 0) for kind in (INSERT, CARRY, REOPEN))
    shift = F.when(F.col("change") == REOPEN, F.lit(inserts)).otherwise(F.lit(0))
    opened = numbered.rows.filter(F.col("change") != CARRY).withColumn(
        id_col, F.col("_number") + shift + F.lit(first - 1)
    )
    default_rows = 0
    if carries or reopened:
        found = numbered.rows.filter(F.col("_row").isNotNull())
        parts = touched_parts(store, table, found.select(spec.bucket_by, F.col("_flag").alias(ACTIVE)))
        touched = found.select(
            F.col("_row").alias(id_col), F.col("change").alias("_change"),
            F.col("end_dt").alias("_end_dt"), F.col(ACTIVE).alias("_is_active"),
        )
        current = lookup_join(store.read_parts(table, parts), touched, [id_col], known_rows=carries + reopened)
        carried = F.col("_change") == CARRY
        ends = (F.col("_change") == REOPEN) & (F.col(ACTIVE) == "Y")
        kept = current.select(
            *[F.col(c) for c in spec.columns if c not in ("end_dt", ACTIVE, "update_dt")],
            F.when(carried, F.col("_end_dt")).when(ends, F.date_sub(F.lit(load_dt), 1))
            .otherwise(F.col("end_dt")).alias("end_dt"),
            F.when(carried, F.col("_is_active")).when(ends, F.lit("N"))
            .otherwise(F.col(ACTIVE)).alias(ACTIVE),
            F.when(carried | ends, F.lit(load_dt).cast("date")).otherwise(F.col("update_dt")).alias("update_dt"),
        )
        added = with_stamps(opened, load_dt).select(*spec.columns)
        store.commit(table, kept.select(*spec.columns).unionByName(added), parts, before + inserts + reopened)
    else:
        _, default_rows = append_new(store, table, opened, load_dt, known_rows=inserts)
    return {"Inserted": inserts + reopened, "Closed": carries + reopened, "Default rows": default_rows}

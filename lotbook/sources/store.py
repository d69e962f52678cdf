"""The warehouse tables: external Parquet tables in one catalog database.

Tables whose rows change after they were written are bucketed by their key, and histories by their active flag as well. A
commit writes new folders for the buckets it touches and leaves the files of all others alone; which folders make up the
table is one list, written after the data. Each row carries a digest of the columns that changes are looked for in, so a
change is found by key and digest alone.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotbook.schemas import TABLES, Table
from lotbook.sources.scratch import dropped_shuffles, new_folder


BUCKET_ROWS = 250_000  # rows a bucket starts with at most; with four times as many, the table gets more buckets
MOST_FOLDERS = 8  # folders of one bucket, beyond which the next commit to it merges them
DIGEST, BUCKET, COMMIT, ACTIVE = "_digest", "_bucket", "_commit", "is_active"
Part = tuple[str, int, str]  # active flag (empty where the table has none), bucket, commit


@dataclass(frozen=True)
class Layout:
    """The folders of a bucketed table."""

    buckets: int
    parts: tuple[Part, ...] = ()


def digest(columns: Sequence[Column]) -> Column:
    """16 bytes that tell rows apart that differ in any of the columns; two NULLs are equal."""
    return F.unhex(F.md5(F.to_json(F.struct(*[c.cast("string").alias(f"c{i}") for i, c in enumerate(columns)]),
                                   {"ignoreNullFields": "false"})))


def one_row(spark: SparkSession, schema: T.StructType, values: dict[str, object]) -> DataFrame:
    """A single row of constants; columns without a value are NULL."""
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema]
    )


class Store:
    """Reads and writes the tables of :mod:`lotbook.schemas`.

    A table that has to be rewritten is written to a new folder first and the catalog entry is then pointed
    at it, so readers see the old or the new rows, never a mix, and a failed write changes nothing.

    The files are the truth, not the catalog: which folder a table lives in is kept next to its data, in numbered
    pointer files written after the data, of which the last counts. A store that is opened again, in another session
    or under another database name, finds the tables, rows and partitions that are there. One store writes at a time;
    a second writer that replaces the same table fails at the pointer.
    """

    def __init__(self, spark: SparkSession, root: str, database: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self._rows: dict[str, int] = {}
        self._ensured: set[str] = set()
        self._layouts: dict[str, Layout] = {}
        # Two jobs must not commit into one folder at a time; loads that run side by side share the log table.
        self._writing: dict[str, threading.Lock] = defaultdict(threading.Lock)
        self._creating: dict[str, threading.Lock] = defaultdict(threading.Lock)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/_catalog'")

    @classmethod
    def temporary(cls, spark: SparkSession) -> Store:
        """A store of its own in the scratch folder."""
        return cls(spark, new_folder(spark, "store"), f"lotbook_{uuid.uuid4().hex[:12]}")

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def _files(self, path: str):
        """A path and the file system it lies on."""
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _pointers(self, table: str) -> list[str]:
        """Names of the pointer files, oldest first; each is a number and the folder it points to."""
        place, files = self._files(f"{self.root}/{table}/_pointers")
        return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []

    def _point(self, table: str, folder: str) -> None:
        """Make ``folder`` the table's folder from now on."""
        number = len(self._pointers(table))
        place, files = self._files(f"{self.root}/{table}/_pointers/{number:09d}={folder}")
        if number != len(self._pointers(table)) or not files.createNewFile(place):
            raise RuntimeError(f"{table} was replaced by another writer")

    def location(self, table: str) -> str:
        pointers = self._pointers(table)
        return f"{self.root}/{table}/{pointers[-1].partition('=')[2] if pointers else 'base'}"

    def ensure(self, table: str) -> None:
        """Register the table at its current folder, with the partitions found there."""
        with self._creating[table]:
            if table in self._ensured:
                return
            spec: Table = TABLES[table]
            if spec.bucket_by:
                self._layouts[table] = self._stored_layout(table)
                self._register(table)
                self._ensured.add(table)
                return
            location = self.location(table)
            place, files = self._files(location)
            filled = files.exists(place)
            if self.spark.catalog.tableExists(self.name(table)):
                self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{location}'")
            else:
                columns = ", ".join("`{}` {}".format(*part.split()) for part in spec.ddl.split(", "))
                partition = f" PARTITIONED BY (`{spec.partition_by}`)" if spec.partition_by else ""
                self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet{partition} "
                               f"LOCATION '{location}'")
            if filled and spec.partition_by:
                self.spark.catalog.recoverPartitions(self.name(table))
            if not filled:
                self._rows[table] = 0
            self._ensured.add(table)

    def read(self, table: str) -> DataFrame:
        self.ensure(table)
        if TABLES[table].bucket_by:
            return self.read_parts(table).select(*TABLES[table].columns)
        return self.spark.table(self.name(table))

    def bucket(self, table: str, key: Column) -> Column:
        """The bucket of a key."""
        self.ensure(table)
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self._layouts[table].buckets)).cast("int")

    def read_parts(self, table: str, wanted: Iterable[tuple[str, int]] | None = None) -> DataFrame:
        """A bucketed table with the digests of its rows; of some (active flag, bucket) pairs only, if they are given."""
        self.ensure(table)
        spec = TABLES[table]
        wanted = None if wanted is None else set(wanted)
        paths = [self._folder(table, p) for p in self._layouts[table].parts if wanted is None or p[:2] in wanted]
        if not paths:
            return self.spark.createDataFrame([], f"{spec.ddl}, {DIGEST} binary")
        inner = [part for part in spec.ddl.split(", ") if part.split()[0] != ACTIVE or not spec.has_history]
        flag = [f"{ACTIVE} string"] if spec.has_history else []
        schema = ", ".join([*inner, f"{DIGEST} binary", f"{COMMIT} string", *flag, f"{BUCKET} int"])
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}/data").parquet(*paths)
        return rows.select(*spec.columns, DIGEST)

    def _folder(self, table: str, part: Part) -> str:
        active, bucket, commit = part
        flag = f"{ACTIVE}={active}/" if active else ""
        return f"{self.root}/{table}/data/{COMMIT}={commit}/{flag}{BUCKET}={bucket}"

    def _stored_layout(self, table: str) -> Layout:
        pointers = self._pointers(table)
        if not pointers:
            self._rows[table] = 0
            return Layout(1)
        place, files = self._files(f"{self.root}/{table}/_layouts/{pointers[-1].partition('=')[2]}")
        stream = files.open(place)
        try:
            found = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Layout(found["buckets"], tuple(tuple(p) for p in found["parts"]))

    def _register(self, table: str) -> None:
        """Bring the catalog's partitions in step with the folders, for queries that go past the store."""
        spec, layout, name = TABLES[table], self._layouts[table], self.name(table)
        flag = [ACTIVE] if spec.has_history else []
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join("`{}` {}".format(*part.split()) for part in spec.ddl.split(", "))
            by = ", ".join(f"`{c}`" for c in (COMMIT, *flag, BUCKET))
            self.spark.sql(f"CREATE TABLE {name} ({columns}, `{DIGEST}` binary, `{COMMIT}` string, `{BUCKET}` int) "
                           f"USING parquet PARTITIONED BY ({by}) LOCATION '{self.root}/{table}/data'")
        # Commit, flag and bucket, as in the paths of the folders.
        known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        data = f"{self.root}/{table}/data/"
        wanted = {self._folder(table, p).removeprefix(data) for p in layout.parts}

        def listed(paths: set[str]) -> list[str]:
            pairs = [[step.split("=") for step in path.split("/")] for path in sorted(paths)]
            return ["PARTITION (" + ", ".join(f"`{c}`='{v}'" for c, v in path) + ")" for path in pairs]

        if wanted - known:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(listed(wanted - known)))
        if known - wanted:
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(listed(known - wanted)))

    def commit(self, table: str, rows: DataFrame, replaced: Iterable[tuple[str, int]] = (),
               n_rows: int | None = None) -> None:
        """Add rows to a bucketed table and drop what the (active flag, bucket) pairs of ``replaced`` held before.

        Only buckets that get rows or are replaced are written. Readers see the table before or after the commit, and
        a commit that fails changes nothing. ``n_rows`` are the table's rows afterwards, if the caller knows them.
        """
        self.ensure(table)
        spec, replaced = TABLES[table], set(replaced)
        with self._writing[table]:
            layout = self._layouts[table]
            buckets = layout.buckets
            while n_rows is not None and n_rows > (4 if layout.parts else 1) * buckets * BUCKET_ROWS:
                buckets *= 2
            folders: dict[tuple[str, int], int] = defaultdict(int)
            for active, bucket, _ in layout.parts:
                folders[active, bucket] += 1
            if buckets != layout.buckets:
                merged = set(folders) - replaced
            else:
                merged = {p for p, n in folders.items() if n >= MOST_FOLDERS} - replaced
            rows = rows.select(*spec.columns)
            if merged:
                rows = rows.unionByName(self.read_parts(table, merged).select(*spec.columns))
            commit, path = uuid.uuid4().hex, f"{self.root}/{table}/data"
            key = F.col(spec.bucket_by).cast("string")
            placed = rows.withColumn(DIGEST, digest([spec.compared(F.col(c)) for c in spec.tracked])).withColumn(
                BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
            by = [ACTIVE, BUCKET] if spec.has_history else [BUCKET]
            with dropped_shuffles(self.spark):
                placed.repartition(BUCKET).write.partitionBy(*by).parquet(f"{path}/{COMMIT}={commit}")
            gone = replaced | merged
            parts = [p for p in layout.parts if p[:2] not in gone] + self._written(table, commit)
            self._layouts[table] = Layout(buckets, tuple(parts))
            try:
                self._write_layout(table, commit)
            except BaseException:
                self._layouts[table] = layout
                raise
            self._register(table)
            self.spark.catalog.refreshTable(self.name(table))
        self._rows.pop(table, None)
        if n_rows is not None:
            self._rows[table] = n_rows

    def _written(self, table: str, commit: str) -> list[Part]:
        """The folders a commit has made."""
        root, files = self._files(f"{self.root}/{table}/data/{COMMIT}={commit}")

        def below(place):
            return [(f.getPath(), f.getPath().getName()) for f in files.listStatus(place)
                    if f.isDirectory() and "=" in f.getPath().getName()]

        levels = [("", root)]
        if TABLES[table].has_history:
            levels = [(name.partition("=")[2], path) for path, name in below(root)]
        return [(active, int(name.partition("=")[2]), commit) for active, top in levels for _, name in below(top)]

    def _write_layout(self, table: str, commit: str) -> None:
        layout = self._layouts[table]
        place, files = self._files(f"{self.root}/{table}/_layouts/{commit}")
        stream = files.create(place)
        try:
            stream.write(bytearray(json.dumps({"buckets": layout.buckets, "parts": layout.parts}), "utf-8"))
        finally:
            stream.close()
        self._point(table, commit)

    def rows(self, table: str) -> int:
        """Row count, from the file footers unless the last writer left it."""
        self.ensure(table)
        if table not in self._rows:
            self._rows[table] = self.read(table).count()
        return self._rows[table]

    def set_rows(self, table: str, count: int) -> None:
        self._rows[table] = count

    def append(self, table: str, rows: DataFrame, n_rows: int | None = None) -> None:
        """``n_rows`` are the rows to append at most, if known; they decide on the buckets of a new table."""
        self.ensure(table)
        if TABLES[table].bucket_by:
            self.commit(table, rows, n_rows=None if n_rows is None else self.rows(table) + n_rows)
            self._rows.pop(table, None)
            return
        self._rows.pop(table, None)
        with self._writing[table], dropped_shuffles(self.spark):
            rows.select(*TABLES[table].columns).write.insertInto(self.name(table))

    def replace(self, table: str, rows: DataFrame) -> None:
        """Exchange all rows."""
        self.ensure(table)
        if TABLES[table].bucket_by:
            self.commit(table, rows, {p[:2] for p in self._layouts[table].parts})
            return
        self._rows.pop(table, None)
        folder = uuid.uuid4().hex
        with dropped_shuffles(self.spark):
            rows.select(*TABLES[table].columns).write.parquet(f"{self.root}/{table}/{folder}")
        self._point(table, folder)
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{self.root}/{table}/{folder}'")
        self.spark.catalog.refreshTable(self.name(table))

    def overwrite_partitions(self, table: str, rows: DataFrame, requested: Iterable[str],
                             filled: Iterable[str]) -> None:
        """Replace the requested partitions in one job; requested ones without rows end up empty."""
        self.ensure(table)
        self._rows.pop(table, None)
        spec = TABLES[table]
        requested, filled = list(requested), set(filled)
        if filled:
            with dropped_shuffles(self.spark):
                (
                    rows.select(*spec.columns)
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy(spec.partition_by)
                    .parquet(self.location(table))
                )
        nothing = ", ".join(
            "CAST(NULL AS {1}) AS `{0}`".format(*part.split())
            for part in spec.ddl.split(", ") if part.split()[0] != spec.partition_by
        )
        for value in requested:
            partition = f"PARTITION (`{spec.partition_by}` = '{value}')"
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS {partition}")
            if value not in filled:
                # A dynamic overwrite leaves partitions without new rows alone, a static one empties them.
                self.spark.sql(
                    f"INSERT OVERWRITE TABLE {self.name(table)} {partition} "
                    f"SELECT {nothing} WHERE false"
                )
        self.spark.catalog.refreshTable(self.name(table))

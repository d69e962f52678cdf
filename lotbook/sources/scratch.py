"""Intermediate tables that cut lineage and outlive lost executors."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_RUN_FOLDERS: dict[str, str] = {}
_SAVED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_OPEN = threading.local()  # the folders of each `passing` block that is open in a thread
LEAN_CODEC = "zstd"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITING: dict[SparkSession, tuple[int, str]] = {}  # writes under way, and the setting to go back to
_WRITING_LOCK = threading.Lock()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; where it is unset, a folder in the warehouse directory.

    Both are folders that every executor reaches; no machine-local temporary folder is used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def _files(spark: SparkSession, path: str):
    """A path and the file system it lies on."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _run_folder(spark: SparkSession) -> str:
    """The scratch folder of this application, which is removed when its JVM ends in good order."""
    app = spark.sparkContext.applicationId
    if app not in _RUN_FOLDERS:
        path = f"{scratch_root(spark)}/lotbook-{uuid.uuid4().hex}"
        folder, files = _files(spark, path)
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _RUN_FOLDERS[app] = path
    return _RUN_FOLDERS[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the scratch folder that does not exist yet."""
    return f"{_run_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes in the block go as soon as each is done.

    A write's plan is not run again, so nothing reads them; left to the engine they stay until the driver happens to
    collect its garbage, which on a large run is after the disks are full. A frame that another thread makes meanwhile
    is worked out anew if it is run twice.
    """
    with _WRITING_LOCK:
        n, before = _WRITING.get(spark, (0, None))
        if not n:
            before = spark.conf.get(CLEANUP, "false")
            spark.conf.set(CLEANUP, "true")
        _WRITING[spark] = n + 1, before
    try:
        yield
    finally:
        with _WRITING_LOCK:
            n, before = _WRITING.pop(spark)
            if n > 1:
                _WRITING[spark] = n - 1, before
            else:
                spark.conf.set(CLEANUP, before)


def save(df: DataFrame, label: str = "saved", lean: bool = False) -> DataFrame:
    """Write once and return the written table, so later steps do not recompute its lineage.

    ``lean`` is for rows as many as the feed's: they are written smaller, the shuffle files behind them go at once, and
    the rows themselves go with :func:`discard` or at the end of a :func:`passing` block.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    if not lean:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    for block in getattr(_OPEN, "blocks", [])[-1:]:
        block.append(path)
    with dropped_shuffles(spark):
        df.write.option("compression", LEAN_CODEC).parquet(path)
    saved = spark.read.schema(df.schema).parquet(path)
    _SAVED[saved] = path
    return saved


def save_counted(df: DataFrame, label: str = "saved", lean: bool = False) -> tuple[DataFrame, int]:
    """Like :func:`save`, with the number of rows as the writing job saw it."""
    seen = Observation()
    saved = save(df.observe(seen, F.count(F.lit(1)).alias("n")), label, lean)
    return saved, seen.get["n"]


def _remove(spark: SparkSession, path: str) -> None:
    folder, files = _files(spark, path)
    files.delete(folder, True)


def discard(saved: DataFrame) -> None:
    """Remove what a lean :func:`save` wrote, when nothing that is still to be run reads it."""
    path = _SAVED.pop(saved, None)
    if path is not None:
        _remove(saved.sparkSession, path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Lean saves of this thread in the block are removed at its end: a load's intermediates, once its rows are stored."""
    blocks = _OPEN.__dict__.setdefault("blocks", [])
    blocks.append([])
    try:
        yield
    finally:
        for path in blocks.pop():
            _remove(spark, path)

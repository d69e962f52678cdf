"""Staging of the files that were not staged before.

Files of a feed arrive in a folder and are never changed. A ledger, the checkpoint of a file stream that takes what is
available and ends, knows which ones were staged; each run reads the new ones alone and writes them as one or more
numbered batches. A batch is overwritten if its run failed before the ledger knew it, so no file is staged twice or left
out. Batches wait until their load is reported done, also across sessions, so a load that failed is made up for.

The stream reads lines: a line end inside quotes makes two broken records, as in :func:`lotbook.sources.feeds.read_csv`
without ``multi_line``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotbook.sources.feeds import Feed, judged_lines, parsed


class Inbox:
    """One feed's folder of arriving files, and the folder it is staged in."""

    def __init__(self, spark: SparkSession, path: str, feed: Feed, staged: str, files_per_batch: int = 100_000):
        self.spark, self.path, self.feed, self.root = spark, path, feed, staged.rstrip("/")
        self.files_per_batch = files_per_batch

    def stage(self) -> list[int]:
        """Stage the new files; the numbers of the batches written."""
        written: list[int] = []

        def write(batch: DataFrame, number: int) -> None:
            record = F.when(F.col("problem").isNull(), parsed(self.feed))
            line = F.when(F.col("problem").isNotNull(), F.col("line"))
            rows = judged_lines(batch, self.feed).select(record.alias("record"), "problem", line.alias("line"))
            rows.write.mode("overwrite").parquet(self._batch(number))
            written.append(number)

        stream = self.spark.readStream.option("maxFilesPerTrigger", self.files_per_batch).text(self.path)
        query = (
            stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{self.root}/_ledger")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return written

    def _batch(self, number: int) -> str:
        return f"{self.root}/data/batch={number}"

    def _numbers(self, folder: str) -> set[int]:
        """Numbers that the names in a folder end with."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        return {int(name.rpartition("=")[2]) for name in names if name.startswith("batch=")}

    def waiting(self) -> list[int]:
        """Batches that are staged and not yet reported done, oldest first."""
        return sorted((self._numbers("data") & self._numbers_known()) - self._numbers("_done"))

    def _numbers_known(self) -> set[int]:
        """Batches that the ledger has as finished; a later folder is left of a run that failed."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_ledger/commits")
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []
        last = max((int(name) for name in names if name.isdigit()), default=-1)
        return set(range(last + 1))

    def _read(self, numbers: list[int]) -> DataFrame:
        schema = f"record struct<{', '.join(f'`{c}`: string' for c in self.feed.columns.values())}>, problem string, line string"
        if not numbers:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self._batch(n) for n in numbers])

    def rows(self, numbers: list[int] | None = None) -> DataFrame:
        """Sound records of the given batches, or of all that are staged."""
        numbers = sorted(self._numbers("data") & self._numbers_known()) if numbers is None else numbers
        return self._read(numbers).filter("problem IS NULL").select("record.*")

    def rejects(self, numbers: list[int] | None = None) -> DataFrame:
        """Records put aside: ``problem`` and ``line``."""
        numbers = sorted(self._numbers("data") & self._numbers_known()) if numbers is None else numbers
        return self._read(numbers).filter("problem IS NOT NULL").select("problem", "line")

    def done(self, numbers: list[int]) -> None:
        """Report batches as loaded."""
        for number in numbers:
            place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_done/batch={number}")
            files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            files.mkdirs(place)

"""A table of micro-batches whose small files are merged while readers go on.

Every batch is a run: a folder of its own that counts once its marker exists, so
a batch that dies half-way is not seen and a replayed one is written once.
``compact`` packs neighbouring runs into files of a target size: the merged run
gets its marker after it is whole, and from then on holds for the runs within
it.  A reader opens the runs that hold at that moment and is not disturbed: the
folders of superseded runs stay until ``vacuum``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.sources.files import create_marker, delete_path, folder_bytes, list_names

TARGET_BYTES = 256 << 20
#: Rows that one task sorts at most, about: stored files of few bytes may hold rows that take many times as much in memory.
SORT_ROWS = 2_000_000
_TIE = "__tie"


@dataclass(frozen=True, order=True)
class BatchRun:
    """The rows of the batches ``first`` to ``last``; ``level`` 0 is a batch as it was appended."""

    first: int
    last: int
    level: int
    size: int

    @property
    def folder(self) -> str:
        return f"run={self.first}-{self.last}-{self.level}"

    @property
    def marker(self) -> str:
        return f"{self.first}-{self.last}-{self.level}-{self.size}"


class BatchTable:
    """``foreachBatch`` handler and reader of the table at ``path`` (markers at ``<path>_runs``)."""

    def __init__(self, path: str, sort_by: Sequence[str] = ()):
        self.path, self.sort_by = path, list(sort_by)

    def _marked(self, spark: SparkSession) -> list[BatchRun]:
        return sorted(BatchRun(*map(int, name.split("-"))) for name in list_names(spark, f"{self.path}_runs"))

    def runs(self, spark: SparkSession) -> list[BatchRun]:
        """The runs that hold now, in order of their batches."""
        marked = self._marked(spark)
        within = lambda r: any(o.level > r.level and o.first <= r.first and r.last <= o.last for o in marked)
        return [r for r in marked if not within(r)]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if any(r.first <= batch_id <= r.last for r in self._marked(spark)):
            return
        self._store(spark, batch, BatchRun(batch_id, batch_id, 0, 0))

    def _store(self, spark: SparkSession, rows: DataFrame, run: BatchRun) -> None:
        folder = f"{self.path}/{run.folder}"
        rows.write.mode("overwrite").parquet(folder)
        done = BatchRun(run.first, run.last, run.level, folder_bytes(spark, folder))
        create_marker(spark, f"{self.path}_runs/{done.marker}")

    def compact(self, spark: SparkSession, target_bytes: int = TARGET_BYTES) -> int:
        """Merge neighbouring runs below ``target_bytes`` until a file has about that size; the number of runs merged.

        First fit in the order of the batches: a run that is large enough already is left as it is and
        parts the others.  One pass rewrites every small run once.  A sorted file holds about ``SORT_ROWS`` rows at
        most, so that the memory of a task does not grow with the runs, also where one key has most of their rows."""
        packs, pack = [], []
        for run in self.runs(spark):
            if run.size >= target_bytes:
                packs, pack = [*packs, pack], []
                continue
            pack.append(run)
            if sum(r.size for r in pack) >= target_bytes:
                packs, pack = [*packs, pack], []
        merged = 0
        for pack in [*packs, pack]:
            if len(pack) < 2:
                continue
            whole = BatchRun(pack[0].first, pack[-1].last, max(r.level for r in pack) + 1, 0)
            rows = spark.read.option("mergeSchema", "true").parquet(*[f"{self.path}/{r.folder}" for r in pack])
            files = max(1, math.ceil(sum(r.size for r in pack) / target_bytes))
            if self.sort_by:
                files = max(files, math.ceil(rows.count() / SORT_ROWS))
                # Rows of one key may fill several files: they are told apart by their place.
                rows = rows.withColumn(_TIE, F.monotonically_increasing_id()).repartitionByRange(files, *self.sort_by, _TIE)
                rows = rows.sortWithinPartitions(*self.sort_by).drop(_TIE)
            else:
                rows = rows.coalesce(files)
            self._store(spark, rows, whole)
            merged += len(pack)
        return merged

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of all batches, pinned to the runs that hold now; columns added by later batches are NULL before."""
        folders = [f"{self.path}/{r.folder}" for r in self.runs(spark)]
        if not folders:
            raise ValueError(f"no batch stored in {self.path}")
        return spark.read.option("mergeSchema", "true").parquet(*folders)

    def vacuum(self, spark: SparkSession) -> int:
        """Delete superseded runs and say how many; readers opened before must be done."""
        current, marked = self.runs(spark), self._marked(spark)
        gone = [r for r in marked if r not in current]
        for run in gone:
            delete_path(spark, f"{self.path}/{run.folder}")
            delete_path(spark, f"{self.path}_runs/{run.marker}")
        return len(gone)

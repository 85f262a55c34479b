"""Streaming SCD2 without MERGE: append runs, merge on read.

*A batch appends.*  The batch's records go to ``log`` as one run (sorted by key
bucket, key and sequence), and nothing that is stored is read: the work of a
batch is proportional to the batch.  A run counts once its marker exists; a
replayed batch replaces its unmarked run, and a batch whose run is marked is
done.  Records with a NULL sequence have no place in a history: they go to
``<log>_rejects`` with the batch id, and ``rejected`` returns them.

*Runs are merged in levels.*  ``fan_in`` runs of a level become one of the next,
so a record is rewritten once per level (the logarithm of the number of batches)
and a reader opens few runs.

*A base holds the history of all batches up to one.*  It is rebuilt when the
records since then outnumber ``rebuild_ratio`` times its own (at least
``rebuild_rows``): by doubling, so all rebuilds together cost a few times the
records.  A base is a folder of its own that counts once its marker exists;
readers see the old base or the new one.

*A read merges* the base with the records since:

* keys without new records keep their base rows;
* a key whose new records are all later than its last one needs its open version
  only: closed versions stay, and the open one takes part as a record at its
  start and one at its last sequence;
* a key with an earlier (late) or equal record is built anew from all its records;
* what takes part goes through one batch ``scd2``.

So the history equals batch ``scd2`` over all records, whatever their order.

The bucket count is part of the stored layout: the first batch stores it beside
the log, and a sink with another count is refused.  Superseded runs and bases
stay until ``vacuum`` (no reader of an earlier state is cut off by a batch).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeshift.operators.history import END_AT, START_AT, scd2
from lakeshift.sinks import overwrite_partitions
from lakeshift.sources.files import create_marker, delete_path, list_names, path_exists

BUCKET = "__bucket"
BATCH = "__batch"
RUN = "__run"

DEFAULT_FAN_IN = 8
DEFAULT_REBUILD_ROWS = 1_000_000


def batch_partitioned_append(path: str):
    """Handler: append a micro-batch to ``path``, idempotent per batch id."""

    def handle(df: DataFrame, batch_id: int) -> None:
        overwrite_partitions(df.withColumn(BATCH, F.lit(batch_id)), path, [BATCH])

    return handle


@dataclass(frozen=True, order=True)
class Run:
    """Stored records of the batches ``first`` to ``last`` (``level`` 0: one batch)."""

    first: int
    last: int
    level: int
    rows: int

    @property
    def folder(self) -> str:
        return f"{RUN}={self.level}-{self.first}-{self.last}"

    @property
    def marker(self) -> str:
        return f"{self.level}-{self.first}-{self.last}-{self.rows}"

    @staticmethod
    def of(marker: str) -> Run:
        level, first, last, rows = map(int, marker.split("-"))
        return Run(first, last, level, rows)


class Scd2Sink:
    """foreachBatch handler maintaining an SCD2 history (see module docstring).

    ``work`` holds, for every batch handled by this object, the stored records
    and base rows that were read and rewritten beside the batch itself."""

    def __init__(
        self,
        log: str,
        history: str,
        keys: Sequence[str],
        sequence_by: str,
        track: Sequence[str] | None = None,
        tie_break: Sequence[str] | None = None,
        buckets: int = 64,
        transform=None,
        fan_in: int = DEFAULT_FAN_IN,
        rebuild_rows: int = DEFAULT_REBUILD_ROWS,
        rebuild_ratio: float = 1.0,
    ):
        self.log, self.history = log, history
        self.keys, self.sequence_by = list(keys), sequence_by
        self.track, self.tie_break = track, tie_break
        self.buckets = buckets
        self.transform = transform
        self.fan_in, self.rebuild_rows, self.rebuild_ratio = fan_in, rebuild_rows, rebuild_ratio
        self.work: list[int] = []

    # ------------------------------------------------------------------ layout
    def _check_buckets(self, spark) -> None:
        store = f"{self.log}_buckets"
        if not path_exists(spark, f"{store}/_SUCCESS"):
            spark.createDataFrame([(str(self.buckets),)], "v string").coalesce(1).write.mode("overwrite").text(store)
            return
        stored = int(spark.read.text(store).first()[0])
        if stored != self.buckets:
            raise ValueError(f"{self.log} is laid out in {stored} buckets, not {self.buckets}")

    def _marked(self, spark) -> list[Run]:
        return sorted(Run.of(name) for name in list_names(spark, f"{self.log}_runs"))

    def runs(self, spark) -> list[Run]:
        """The marked runs that no marked run of a higher level holds, in order."""
        marked = self._marked(spark)
        held = lambda r: any(o.level > r.level and o.first <= r.first and r.last <= o.last for o in marked)
        return [r for r in marked if not held(r)]

    def _base(self, spark) -> tuple[int, int]:
        """(last batch, rows) of the newest base; (-1, 0) without one."""
        return max((tuple(map(int, name.split("-"))) for name in list_names(spark, f"{self.history}_bases")), default=(-1, 0))

    def _write(self, rows: DataFrame, path: str, order: Sequence[str]) -> None:
        # Ranges end within a bucket or a key where these are large: no task holds a hot key whole.
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)

    # ------------------------------------------------------------------ writing
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._check_buckets(spark)
        if any(r.first <= batch_id <= r.last for r in self._marked(spark)):
            return
        rows = self.transform(batch) if self.transform else batch
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        counted = Observation()
        missing = F.col(self.sequence_by).isNull()
        run = rows.withColumns({BUCKET: bucket, BATCH: F.lit(batch_id).cast("long")}).observe(
            counted, F.count_if(~missing).alias("rows"), F.count_if(missing).alias("rejects")
        )
        new = Run(batch_id, batch_id, 0, 0)
        # Sorted within the batch's own tasks: no shuffle, and a reader of few buckets skips row groups.
        order = [BUCKET, *self.keys, self.sequence_by]
        run.filter(~missing).sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{self.log}/{new.folder}")
        n = counted.get
        if n["rejects"]:
            rejects = rows.filter(missing).withColumn(BATCH, F.lit(batch_id).cast("long"))
            overwrite_partitions(rejects, f"{self.log}_rejects", [BATCH])
        # A run without rows counts too: it holds the columns of an empty history.
        create_marker(spark, f"{self.log}_runs/{Run(batch_id, batch_id, 0, n['rows']).marker}")
        self.work.append(self._merge(spark) + self._rebuild_if_due(spark))

    def _merge(self, spark) -> int:
        """Merge the newest ``fan_in`` runs of a level, level by level; the records rewritten."""
        done = 0
        while True:
            runs = self.runs(spark)
            newest = runs[-self.fan_in :]
            if len(newest) < self.fan_in or len({r.level for r in newest}) > 1:
                return done
            merged = Run(newest[0].first, newest[-1].last, newest[0].level + 1, sum(r.rows for r in newest))
            rows = spark.read.parquet(*[f"{self.log}/{r.folder}" for r in newest])
            self._write(rows, f"{self.log}/{merged.folder}", [BUCKET, *self.keys, self.sequence_by])
            create_marker(spark, f"{self.log}_runs/{merged.marker}")
            done += merged.rows

    def _rebuild_if_due(self, spark) -> int:
        base, rows = self._base(spark)
        since = sum(r.rows for r in self.runs(spark) if r.first > base)
        if since < max(self.rebuild_rows, self.rebuild_ratio * rows):
            return 0
        return rows + since if self.rebuild(spark) else 0

    def rebuild(self, spark) -> bool:
        """Store the history of all marked runs as a new base; False if the base is up to date."""
        last = max((r.last for r in self.runs(spark)), default=-1)
        if last <= self._base(spark)[0]:
            return False
        path = f"{self.history}/base={last}"
        self._write(self._merged(spark), path, [BUCKET, *self.keys, START_AT])
        rows = spark.read.parquet(path).count()  # from the footers
        create_marker(spark, f"{self.history}_bases/{last}-{rows}")
        return True

    def vacuum(self, spark) -> None:
        """Delete superseded runs and bases; readers of an earlier state must be done."""
        current = set(self.runs(spark))
        for r in self._marked(spark):
            if r not in current:
                delete_path(spark, f"{self.log}/{r.folder}")
                delete_path(spark, f"{self.log}_runs/{r.marker}")
        base = self._base(spark)
        for name in list_names(spark, f"{self.history}_bases"):
            last, rows = map(int, name.split("-"))
            if (last, rows) != base:
                delete_path(spark, f"{self.history}_bases/{name}")
                if last != base[0]:
                    delete_path(spark, f"{self.history}/base={last}")

    # ------------------------------------------------------------------ reading
    def records(self, spark) -> DataFrame:
        """All records with a sequence, with their bucket and batch."""
        return spark.read.parquet(*[f"{self.log}/{r.folder}" for r in self.runs(spark)])

    def rejected(self, spark) -> DataFrame | None:
        """The records with a NULL sequence and their batch; None if there was none."""
        path = f"{self.log}_rejects"
        return spark.read.parquet(path) if path_exists(spark, path) else None

    def _scd2(self, rows: DataFrame) -> DataFrame:
        return scd2(rows, [*self.keys, BUCKET], self.sequence_by, track=self.track, tie_break=self.tie_break)

    def _merged(self, spark) -> DataFrame:
        base_batch, base_rows = self._base(spark)
        records = self.records(spark)
        if base_batch < 0:
            return self._scd2(records.drop(BATCH))
        base = spark.read.parquet(f"{self.history}/base={base_batch}")
        since = [f"{self.log}/{r.folder}" for r in self.runs(spark) if r.last > base_batch]
        if not since:
            return base
        keys, seq = [*self.keys, BUCKET], self.sequence_by
        columns = [c for c in records.columns if c != BATCH]
        new = spark.read.parquet(*since).filter(F.col(BATCH) > base_batch).select(columns)
        # Which keys have new records, and from when on; their open versions tell what else takes part.
        mine = [f"__k{i}" for i in range(len(keys))]
        touched = new.groupBy(*[F.col(k).alias(m) for k, m in zip(keys, mine, strict=True)]).agg(F.min(seq).alias("__from"))

        def same(df: DataFrame) -> list[Column]:
            return [df[k].eqNullSafe(F.col(m)) for k, m in zip(keys, mine, strict=True)]

        open_ = base.filter(F.col(END_AT).isNull())
        heads = open_.join(touched, same(open_)).withColumn("__late", F.col("__from") <= F.col(seq))
        kept = base.join(heads.select(*mine, "__late"), same(base), "left").filter(
            F.col("__late").isNull() | (~F.col("__late") & F.col(END_AT).isNotNull())
        )
        going_on = heads.filter(~F.col("__late"))
        parts = [
            new,
            going_on.select(columns),
            going_on.select(*[F.col(START_AT).alias(c) if c == seq else F.col(c) for c in columns]),
        ]
        late = heads.filter("__late").select(mine)
        # At most as many values as buckets; runs are sorted by bucket, so others are skipped.
        late_buckets = [r[0] for r in late.select(mine[-1]).distinct().collect()]
        if late_buckets:
            earlier = records.filter((F.col(BATCH) <= base_batch) & F.col(BUCKET).isin(late_buckets))
            parts.append(earlier.join(late, same(earlier), "left_semi").select(columns))
        part = self._scd2(reduce(DataFrame.unionByName, parts))
        return kept.select(base.columns).unionByName(part.select(base.columns))

    def read(self, spark) -> DataFrame:
        """The history of all batches, merged on read (the base rows, if there are no later records)."""
        return self._merged(spark).drop(BUCKET)

"""Watermark, fan-out of one stream to several outputs, run-to-completion."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

DEFAULT_WATERMARK = "1 day"

BatchHandler = Callable[[DataFrame, int], None]


def with_event_watermark(df: DataFrame, col: str, delay: str = DEFAULT_WATERMARK) -> DataFrame:
    """Declare an event-time watermark (``timestamp_ntz`` is cast first: the
    watermark needs ``timestamp``).  On its own it drops nothing — only a later
    stateful operator (windowed aggregate, dedup, stream join) uses it."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        df = df.withColumn(col, F.col(col).cast("timestamp"))
    return df.withWatermark(col, delay)


def fan_out(
    df: DataFrame,
    handlers: Mapping[str, BatchHandler],
    checkpoint: str,
    query_name: str | None = None,
) -> StreamingQuery:
    """Run one streaming plan and feed every micro-batch to several handlers.

    The batch is persisted once (memory + disk; recomputed from the source files
    of the batch if an executor is lost) so the source is read and the shared
    transformations are evaluated once per batch.  Handlers must be idempotent
    per ``batch_id`` (a failed batch is replayed with the same id).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            # A watermark can add a trailing no-data batch: nothing to write.
            if batch.isEmpty():
                return
            for handler in handlers.values():
                handler(batch, batch_id)
        finally:
            batch.unpersist()

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def run_to_completion(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query; re-raise its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream {query.name or query.id} failed: {query.exception()}")
    return query


def observed_totals(query: StreamingQuery, name: str) -> dict[str, int]:
    """Sum the counters a stream published with ``observe(name, ...)`` over all
    its recorded micro-batches (e.g. expectation violations per rule)."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = (progress.observedMetrics or {}).get(name)
        if row is None:
            continue
        for k, v in row.asDict().items():
            totals[k] = totals.get(k, 0) + (v or 0)
    return totals

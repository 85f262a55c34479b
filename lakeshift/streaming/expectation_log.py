"""Durable expectation counters of a stream.

A stream's progress events hold the counters of the last batches only and are
gone with the query.  Here every micro-batch writes its counters to a table,
keyed by (query, batch id), after its rows: the rows' own write counts them
(``observe``, no second pass), and a replayed batch replaces its counters as it
replaces its rows.  Totals of any number of batches are then an aggregate over
the table, also across restarts.

``warn`` rules keep a row and count it, ``drop`` rules remove and count it; a
predicate that is NULL counts as a violation (see ``operators.expectations``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators.expectations import DROP, WARN, expect
from lakeshift.sinks import overwrite_partitions
from lakeshift.sources.files import path_exists
from lakeshift.streaming.streams import BatchHandler

LOG_SCHEMA = "rule string, action string, failed_rows long, passed_rows long, input_rows long, query string, batch_id long"


def write_counts(
    spark: SparkSession,
    log: str,
    query: str,
    batch_id: int,
    counts: Mapping[str, int],
    warn: Mapping[str, str] | None = None,
    drop: Mapping[str, str] | None = None,
) -> None:
    """Store the counters that ``expect`` observed in a batch (``input_rows`` and ``<rule>_failed``), replacing earlier ones."""
    total = counts.get("input_rows") or 0
    rules = [(name, WARN) for name in warn or {}] + [(name, DROP) for name in drop or {}]
    rows = [(r, a, failed := counts.get(f"{r}_failed") or 0, total - failed, total, query, batch_id) for r, a in rules]
    overwrite_partitions(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), log, ["query", "batch_id"])


def with_expectations(
    handler: BatchHandler,
    log: str,
    query: str,
    warn: Mapping[str, str] | None = None,
    drop: Mapping[str, str] | None = None,
) -> BatchHandler:
    """A ``foreachBatch`` handler that applies expectations, hands the rows left to ``handler`` and logs the counters.

    ``handler`` must write its rows in its first action over them, without a
    range partitioning (Spark samples for that, and a sample is not counted as
    a batch); an idempotent one makes rows and counters exactly-once.  A batch
    whose handler fails logs nothing and is replayed."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        handler(expect(batch, warn, drop, seen), batch_id)
        write_counts(batch.sparkSession, log, query, batch_id, seen.get, warn, drop)

    return handle


def expectation_log(spark: SparkSession, log: str) -> DataFrame:
    """All counters stored under ``log``: one row per (query, batch, rule)."""
    return spark.read.schema(LOG_SCHEMA).parquet(log)


def expectation_totals(spark: SparkSession, log: str, query: str) -> DataFrame:
    """``rule, action, failed_rows, passed_rows, total_rows, batches`` over all batches of ``query``; empty without any."""
    if not path_exists(spark, log):
        return spark.createDataFrame([], "rule string, action string, failed_rows long, passed_rows long, total_rows long, batches long")
    return (
        expectation_log(spark, log)
        .filter(F.col("query") == query)
        .groupBy("rule", "action")
        .agg(
            F.sum("failed_rows").alias("failed_rows"),
            F.sum("passed_rows").alias("passed_rows"),
            F.sum("input_rows").alias("total_rows"),
            F.count(F.lit(1)).alias("batches"),
        )
    )

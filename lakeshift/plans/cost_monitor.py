"""Cost monitor: cluster-state samples -> cost log (append) + idle alerts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions.costs import IDLE_DBU_THRESHOLD
from lakeshift.operators.costs import cost_log, idle_alerts
from lakeshift.session import ensure_checkpoint_dir
from lakeshift.sinks import append_batch
from lakeshift.sources.files import path_exists

LOG_MONTH = "log_month"


def run_cost_monitor(
    spark: SparkSession, samples: DataFrame, log_path: str, threshold: float = IDLE_DBU_THRESHOLD
) -> DataFrame:
    """Append the cost rows of ``samples`` to ``log_path``; return the alert rows of
    their runs (read back from the log, so they are what was stored).

    The log is partitioned by the month of the sample, and only the months that
    ``samples`` covers are read.  Samples that the log holds already (same run,
    time and cluster) are not appended again, so a repeated run changes nothing; a
    sample that occurs several times in ``samples`` itself is kept as often."""
    rows = cost_log(samples, threshold).withColumn(LOG_MONTH, F.substring("run_timestamp", 1, 7))
    rows.persist(StorageLevel.MEMORY_AND_DISK)  # its months and runs, then the append: samples are evaluated once
    try:
        runs = _stored_runs(rows)
        first, last = runs.agg(F.min(LOG_MONTH), F.max(LOG_MONTH)).first()
        months = F.col(LOG_MONTH).between(F.lit(first), F.lit(last)) | F.col(LOG_MONTH).isNull()

        def logged() -> DataFrame:
            return spark.read.schema(rows.schema).parquet(log_path).filter(months)

        new = rows
        if path_exists(spark, log_path):
            new = _matching(rows, logged(), [LOG_MONTH, "run_id", "run_timestamp", "cluster_id"], "left_anti")
        # a month is written by few tasks, a large one by several (split by AQE)
        append_batch(new.hint("rebalance", F.col(LOG_MONTH)), log_path, [LOG_MONTH])
    finally:
        rows.unpersist()
    return idle_alerts(_matching(logged(), runs, [LOG_MONTH, "run_id"], "left_semi"))


def _stored_runs(rows: DataFrame) -> DataFrame:
    """The (month, run) pairs of ``rows``, stored: the alerts returned later ask for them again."""
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.select(LOG_MONTH, "run_id").distinct().checkpoint()


def _matching(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """``left`` with (semi) or without (anti) the rows that ``right`` holds; NULL equals NULL."""
    keys = right.select(*[F.col(c).alias(f"__{c}") for c in columns]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns]
    return left.join(keys, same, how)

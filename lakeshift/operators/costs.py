"""Cost log over cluster-state samples, idle alerts and the cost tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.costs import IDLE_DBU_THRESHOLD, UNKNOWN_STATE, dbu_estimate, idle_flag


def cost_log(samples: DataFrame, threshold: float = IDLE_DBU_THRESHOLD) -> DataFrame:
    """One cost-log row per cluster-state sample.

    Input columns: ``run_id, sampled_at, cluster_id, state, num_workers,
    queries_run`` (any number of clusters and samples).  Output: ``run_id,
    run_timestamp`` (ISO text of ``sampled_at``), ``cluster_id, cluster_state,
    dbu_estimate, queries_run, idle``.  Missing state -> ``UNKNOWN``, missing
    worker count -> 0.  Narrow projection, no shuffle.
    """
    state = F.coalesce(F.col("state"), F.lit(UNKNOWN_STATE))
    dbu = dbu_estimate(state, F.col("num_workers"))
    return samples.select(
        F.col("run_id"),
        F.date_format("sampled_at", "yyyy-MM-dd'T'HH:mm:ss").alias("run_timestamp"),
        F.col("cluster_id"),
        state.alias("cluster_state"),
        dbu.alias("dbu_estimate"),
        F.col("queries_run").cast("bigint").alias("queries_run"),
        idle_flag(F.col("queries_run"), dbu, threshold).alias("idle"),
    )


def idle_alerts(log: DataFrame) -> DataFrame:
    """Alert rows (as a table, not console text) for idle log entries."""
    return log.filter(F.col("idle")).select(
        "run_id",
        "run_timestamp",
        "cluster_id",
        "dbu_estimate",
        F.format_string(
            "ALERT: Cluster %s is idle but consuming %s DBU/hr. Consider terminating.",
            F.col("cluster_id"),
            F.col("dbu_estimate").cast("string"),
        ).alias("message"),
    )


def cost_per_run(log: DataFrame) -> DataFrame:
    """Tile: estimated DBU per pipeline run (sum over its samples)."""
    return log.groupBy("run_id").agg(
        F.round(F.sum("dbu_estimate"), 2).alias("dbu_total"),
        F.count(F.lit(1)).alias("samples"),
        F.count_if(F.col("idle")).alias("idle_samples"),
    )


def idle_dbu_per_week(log: DataFrame) -> DataFrame:
    """Tile: DBU spent while idle, per week (weeks start on Monday)."""
    week = F.date_trunc("week", F.to_timestamp("run_timestamp")).cast("timestamp_ntz")
    return (
        log.filter(F.col("idle"))
        .groupBy(week.alias("week_start"))
        .agg(F.round(F.sum("dbu_estimate"), 2).alias("idle_dbu"), F.count(F.lit(1)).alias("idle_samples"))
    )

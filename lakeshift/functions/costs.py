"""Cluster cost estimate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values of the cost estimate ---------------------------------------
BILLED_STATES = ("RUNNING", "RESIZING")
DRIVER_DBU_PER_HOUR = 2.0
WORKER_DBU_PER_HOUR = 1.0
IDLE_DBU_THRESHOLD = 0.5
UNKNOWN_STATE = "UNKNOWN"
# ------------------------------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbu_estimate(state: Column | str, num_workers: Column | str) -> Column:
    """DBU/hour estimate: driver + one per worker while billed, else 0.0."""
    workers = F.coalesce(_c(num_workers), F.lit(0))
    billed = F.round(F.lit(DRIVER_DBU_PER_HOUR) + workers * F.lit(WORKER_DBU_PER_HOUR), 2)
    return F.when(_c(state).isin(*BILLED_STATES), billed).otherwise(F.lit(0.0))


def idle_flag(queries_run: Column | str, dbu: Column | str, threshold: float = IDLE_DBU_THRESHOLD) -> Column:
    """Idle = billed above ``threshold`` while no query ran."""
    return (_c(queries_run) == 0) & (_c(dbu) > F.lit(threshold))

"""Gold roll-ups: counts per time bucket, conditional counts per entity and
tie-aware top-K per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.functions.timecols import truncate_time

# ---- fixed values: conditional counters of the repository roll-up -------------
REPO_COUNTERS = {
    "watch_count": "WatchEvent",
    "fork_count": "ForkEvent",
    "push_count": "PushEvent",
}
TOP_K = 20
# --------------------------------------------------------------------------------


def event_volume(
    silver: DataFrame,
    unit: str = "hour",
    time_col: str = "event_time",
    type_col: str = "event_type",
    order: bool = False,
) -> DataFrame:
    """``event_<unit>, event_type, event_count``.

    Partial count per task, one exchange on the grouping keys, final merge: a hot
    (hour, type) key costs one row per task in the shuffle, not its raw rows.
    ``order`` adds the reader-side sort (a range exchange over the small result).
    """
    bucket = f"event_{unit}"
    out = (
        silver.groupBy(truncate_time(time_col, unit).alias(bucket), F.col(type_col).alias("event_type"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    return out.orderBy(bucket, "event_type") if order else out


def entity_activity(
    silver: DataFrame,
    entity: str = "repo_name",
    counters: Mapping[str, str] = REPO_COUNTERS,
    unit: str = "hour",
    time_col: str = "event_time",
    type_col: str = "event_type",
) -> DataFrame:
    """Per (time bucket, entity): one conditional count per entry of ``counters``
    (output column -> event type) and ``total_events``.  A NULL entity is a group
    of its own.  Same partial/final aggregation shape as ``event_volume``."""
    bucket = f"event_{unit}"
    aggs = [F.count_if(F.col(type_col) == F.lit(v)).alias(name) for name, v in counters.items()]
    aggs.append(F.count(F.lit(1)).alias("total_events"))
    return silver.groupBy(truncate_time(time_col, unit).alias(bucket), F.col(entity)).agg(*aggs)


def top_k_per_group(
    df: DataFrame,
    group_by: Sequence[str] | str,
    order_col: str,
    k: int = TOP_K,
    ties: bool = True,
    descending: bool = True,
    tie_break: Sequence[str] = (),
    materialize: bool = False,
) -> DataFrame:
    """Rows whose ``order_col`` ranks within the top ``k`` of their group.

    ``ties=True`` is dense-rank semantics: every row whose value is among the
    ``k`` best *distinct* values is kept, so a group may return more than ``k``
    rows.  It is computed without sending a group's rows to one task:

    1. the distinct (group, value) levels are taken (an aggregate: partial per
       task, so a hot group with many equal values shrinks before the shuffle);
    2. the ``k`` best levels per group are kept (``row_number`` over distinct
       levels; Catalyst adds a partial ``WindowGroupLimit`` before the exchange,
       so at most ``k`` levels per group per task move);
    3. their worst value is the group's threshold; rows at or beyond it are kept
       by a join on the group key.  The threshold side has one row per group:
       AQE broadcasts it when its measured size is under the broadcast limit,
       otherwise the join is a sort-merge join whose hot partitions AQE splits.

    ``ties=False`` keeps exactly ``k`` rows per group (``row_number`` ordered by
    ``order_col`` then ``tie_break``), again with a partial group limit before
    the exchange.  NULL values sort last.

    The tie-aware plan uses ``df`` twice (levels and rows).  Column pruning would
    make the two differ, so both pass a filter that needs every column: the same
    sub-plan twice, of which Spark runs the exchange once and reads its output
    again (``ReusedExchange``).  An aggregate is scanned and aggregated a single
    time, and nothing runs while the plan is built.  ``materialize`` checkpoints
    ``df`` instead: for an input whose plan does not end in an exchange, or whose
    lineage is to be cut.
    """
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    value = F.col(order_col)
    if not ties:
        order = [value.desc_nulls_last() if descending else value.asc_nulls_last()]
        order += [F.col(c).asc_nulls_last() for c in tie_break]
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k).drop("__rn")

    if materialize:
        from lakeshift.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    else:
        # True of every row, but not to the optimizer.
        df = df.filter(F.xxhash64(*df.columns) >= F.lit(-(1 << 63)))
    lv = F.col("__level")
    levels = df.select(*keys, value.alias("__level")).distinct()
    w = Window.partitionBy(*keys).orderBy(lv.desc_nulls_last() if descending else lv.asc_nulls_last())
    best = levels.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    limit = F.min(lv) if descending else F.max(lv)
    renamed = {c: f"__g{i}" for i, c in enumerate(keys)}
    thresholds = best.groupBy(*[F.col(c).alias(renamed[c]) for c in keys]).agg(
        limit.alias("__threshold"), F.max(lv.isNull()).alias("__keep_null")
    )
    beyond: Column = (value >= F.col("__threshold")) if descending else (value <= F.col("__threshold"))
    keep = F.coalesce(beyond, F.lit(False)) | (value.isNull() & F.col("__keep_null"))
    # eqNullSafe: a NULL group key (e.g. events without a repo) is a group too.
    cond = [F.col(c).eqNullSafe(F.col(renamed[c])) for c in keys]
    joined = df.join(thresholds, cond, "inner")
    return joined.filter(keep).select(*df.columns)


def top_entities(
    silver: DataFrame,
    entity: str = "repo_name",
    counters: Mapping[str, str] = REPO_COUNTERS,
    unit: str = "hour",
    k: int = TOP_K,
    rank_by: str = "total_events",
    ties: bool = True,
    materialize: bool = False,
) -> DataFrame:
    """Gold top-entities table: ``entity_activity`` then the per-bucket top-K.

    Lazy; silver is scanned and aggregated a single time (see ``top_k_per_group``)."""
    activity = entity_activity(silver, entity=entity, counters=counters, unit=unit)
    return top_k_per_group(activity, f"event_{unit}", rank_by, k=k, ties=ties, materialize=materialize)


def events_per_bucket(silver: DataFrame, unit: str = "hour", time_col: str = "event_time") -> DataFrame:
    """Dashboard tile: all events per time bucket."""
    bucket = f"event_{unit}"
    return silver.groupBy(truncate_time(time_col, unit).alias(bucket)).agg(F.count(F.lit(1)).alias("event_count"))


def volume_totals(volume: DataFrame, unit: str = "hour") -> DataFrame:
    """Dashboard tile from the gold volume table: events per time bucket, summed
    over event types (reads the small gold table, not silver)."""
    bucket = f"event_{unit}"
    return volume.groupBy(bucket).agg(F.sum("event_count").cast("bigint").alias("event_count"))

"""

Each query reads the driver's tables from ``sf_dir``, maps them to the
reference's input shapes with ``lakeshift.plans.fixtures`` and runs the
library's operators over the whole tables.  Timestamps leave as
``timestamp_ntz`` and computed columns carry the same aliases as the SQL.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from datetime import datetime, timedelta

# The package sits next to this file; make it importable however this file is loaded.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions.timecols import as_naive_timestamps
from lakeshift.operators import (
    SSN_RULES,
    apply_checks,
    cost_log,
    cost_per_run,
    entity_activity,
    event_expectations,
    event_volume,
    expectation_counts,
    explode_hourly,
    flatten_events,
    get_invalid,
    get_valid,
    idle_alerts,
    idle_dbu_per_week,
    latest,
    normalize_identifier,
    plan_slices,
    rule_names,
    scd2,
    silver_events,
    to_exceptions,
    top_entities,
    volume_totals,
)
from lakeshift.plans import fixtures as fx

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 3, 1, 0, 0, 0)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None):
    def deco(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = fx.raw_events(fx.table(spark, sf_dir, "events"))
    return silver_events(bronze, valid_types=fx.FIXTURE_VALID_TYPES)


# ---------------------------------------------------------------- SQL building blocks
_TYPES_SQL = "('click', 'purchase', 'signup', 'view')"
_SILVER_SQL = f"""
    SELECT CAST(event_id AS VARCHAR) AS id, event_type,
           'user_' || CAST(user_id AS VARCHAR) AS actor_login, user_id AS actor_id,
           'repo_' || CAST(user_id % 40 AS VARCHAR) AS repo_name, user_id % 40 AS repo_id,
           ts AS event_time,
           CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'org_' || CAST(user_id % 5 AS VARCHAR) END AS org_login,
           event_id % 2 = 0 AS public
    FROM events WHERE event_type IN {_TYPES_SQL} AND ts IS NOT NULL"""


def _activity_sql(entity: str, unit: str) -> str:
    return f"""
    SELECT date_trunc('{unit}', event_time) AS event_{unit}, {entity},
           count(*) FILTER (WHERE event_type = 'click') AS watch_count,
           count(*) FILTER (WHERE event_type = 'signup') AS fork_count,
           count(*) FILTER (WHERE event_type = 'view') AS push_count,
           count(*) AS total_events
    FROM ({_SILVER_SQL}) s GROUP BY 1, 2"""


def _top_sql(entity: str, unit: str, k: int, ties: bool) -> str:
    rank = (
        f"dense_rank() OVER (PARTITION BY event_{unit} ORDER BY total_events DESC)"
        if ties
        else f"row_number() OVER (PARTITION BY event_{unit} ORDER BY total_events DESC, {entity})"
    )
    return f"""
    SELECT event_{unit}, {entity}, watch_count, fork_count, push_count, total_events
    FROM (SELECT *, {rank} AS rk FROM ({_activity_sql(entity, unit)}) a) r WHERE rk <= {k}"""


_SSN_SQL = """CASE WHEN c_custkey % 7 = 0 THEN NULL
         WHEN c_custkey % 11 = 0 THEN '912-70-1234'
         WHEN c_custkey % 13 = 0 THEN '000-12-3456'
         WHEN c_custkey % 17 = 0 THEN 'n/a'
         ELSE lpad(CAST(100 + c_custkey % 500 AS VARCHAR), 3, '0') || '-' ||
              lpad(CAST(1 + c_custkey % 98 AS VARCHAR), 2, '0') || '-' ||
              lpad(CAST(1 + c_custkey % 9998 AS VARCHAR), 4, '0') END"""
_CUSTOMERS_SQL = f"""
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, {_SSN_SQL} AS ssn,
           c_acctbal AS account_balance, 'r' || CAST(c_custkey AS VARCHAR) AS record_id,
           'seed' AS source_system, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) AS event_ts
    FROM customer"""
_NORM_SQL = """CASE WHEN regexp_matches(trim(ssn), '^[0-9\\-\\s]+$')
                    THEN regexp_replace(trim(ssn), '[\\-\\s]', '', 'g') END"""
# SSN structure without look-ahead (the JVM pattern uses it; this engine's does not).
_VALID_SSN_SQL = """(regexp_matches(ssn_norm, '^[0-9]{9}$') AND substr(ssn_norm, 1, 3) NOT IN ('000', '666')
        AND substr(ssn_norm, 1, 1) <> '9' AND substr(ssn_norm, 4, 2) <> '00' AND substr(ssn_norm, 6, 4) <> '0000')"""
_ITIN_SQL = "regexp_matches(ssn_norm, '^9[0-9]{2}(7[0-9]|8[0-9]|9[0-2]|9[4-9])[0-9]{4}$')"
_CHECKED_SQL = f"""
    SELECT *,
      CASE WHEN ssn_norm IS NULL THEN 'SSN_MISSING'
           WHEN NOT {_VALID_SSN_SQL} THEN 'SSN_INVALID_STRUCTURE' END AS error_rules,
      CASE WHEN ssn_norm IS NOT NULL AND {_ITIN_SQL} THEN 'ITIN_SUPPLIED_INSTEAD_OF_SSN' END AS warning_rules
    FROM (SELECT *, {_NORM_SQL} AS ssn_norm FROM ({_CUSTOMERS_SQL}) c) n"""


def _scd2_sql(src: str, key: str, seq: str, track: list[str], content: list[str]) -> str:
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in track)
    last = ", ".join(f"max_by({c}, {seq}) AS {c}" for c in content)
    cols = ", ".join(content)
    return f"""
    WITH x AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR {changed} THEN 1 ELSE 0 END AS chg
               FROM ({src}) s WINDOW w AS (PARTITION BY {key} ORDER BY {seq})),
         g AS (SELECT *, sum(chg) OVER (PARTITION BY {key} ORDER BY {seq} ROWS UNBOUNDED PRECEDING) AS grp FROM x),
         v AS (SELECT {key}, grp, min({seq}) AS start_at, {last}, max({seq}) AS {seq} FROM g GROUP BY {key}, grp)
    SELECT {key}, {cols}, {seq}, start_at AS "__START_AT",
           lead(start_at) OVER (PARTITION BY {key} ORDER BY start_at) AS "__END_AT"
    FROM v"""


# ---------------------------------------------------------------- event medallion
@_register("silver_events", _SILVER_SQL)
def q_silver_events(spark, sf_dir):
    return as_naive_timestamps(_silver(spark, sf_dir))


@_register(
    "event_volume",
    f"SELECT date_trunc('hour', event_time) AS event_hour, event_type, count(*) AS event_count "
    f"FROM ({_SILVER_SQL}) s GROUP BY 1, 2",
)
def q_event_volume(spark, sf_dir):
    return as_naive_timestamps(event_volume(_silver(spark, sf_dir)))


@_register("entity_activity", _activity_sql("repo_name", "hour"))
def q_entity_activity(spark, sf_dir):
    return as_naive_timestamps(entity_activity(_silver(spark, sf_dir), "repo_name", fx.FIXTURE_COUNTERS))


@_register("top_repos_per_hour", _top_sql("repo_name", "hour", 1, True))
def q_top_repos_per_hour(spark, sf_dir):
    return as_naive_timestamps(top_entities(_silver(spark, sf_dir), "repo_name", fx.FIXTURE_COUNTERS, "hour", 1))


@_register("top_actors_per_day_k1", _top_sql("actor_login", "day", 1, True))
def q_top_actors_per_day_k1(spark, sf_dir):
    return as_naive_timestamps(top_entities(_silver(spark, sf_dir), "actor_login", fx.FIXTURE_COUNTERS, "day", 1))


@_register("top_actors_per_day_k3", _top_sql("actor_login", "day", 3, True))
def q_top_actors_per_day_k3(spark, sf_dir):
    return as_naive_timestamps(top_entities(_silver(spark, sf_dir), "actor_login", fx.FIXTURE_COUNTERS, "day", 3))


@_register("top_actors_per_day_k20", _top_sql("actor_login", "day", 20, True))
def q_top_actors_per_day_k20(spark, sf_dir):
    return as_naive_timestamps(top_entities(_silver(spark, sf_dir), "actor_login", fx.FIXTURE_COUNTERS, "day", 20))


@_register("top_actors_per_day_exact3", _top_sql("actor_login", "day", 3, False))
def q_top_actors_per_day_exact3(spark, sf_dir):
    from lakeshift.operators.rollups import top_k_per_group

    act = entity_activity(_silver(spark, sf_dir), "actor_login", fx.FIXTURE_COUNTERS, "day")
    return as_naive_timestamps(top_k_per_group(act, "event_day", "total_events", 3, ties=False, tie_break=["actor_login"]))


@_register(
    "events_per_hour",
    f"SELECT date_trunc('hour', event_time) AS event_hour, count(*) AS event_count FROM ({_SILVER_SQL}) s GROUP BY 1",
)
def q_events_per_hour(spark, sf_dir):
    # tile R1: the hourly sum of the gold event volume (A1)
    return as_naive_timestamps(volume_totals(event_volume(_silver(spark, sf_dir)), "hour"))


@_register(
    "top_watched_repos_per_day",
    f"""SELECT event_day, repo_name, watch_count, fork_count, push_count, total_events FROM (
          SELECT *, dense_rank() OVER (PARTITION BY event_day ORDER BY watch_count DESC) AS rk
          FROM ({_activity_sql('repo_name', 'day')}) a) r WHERE rk <= 5""",
)
def q_top_watched_repos_per_day(spark, sf_dir):
    return as_naive_timestamps(
        top_entities(_silver(spark, sf_dir), "repo_name", fx.FIXTURE_COUNTERS, "day", 5, rank_by="watch_count")
    )


@_register(
    "expectation_counts",
    f"""SELECT rule, action, failed_rows, total_rows - failed_rows AS passed_rows, total_rows FROM (
          SELECT 'valid_event_id' AS rule, 'warn' AS action, count(*) FILTER (WHERE event_id IS NULL) AS failed_rows,
                 count(*) AS total_rows FROM events
          UNION ALL
          SELECT 'valid_event_type', 'drop',
                 count(*) FILTER (WHERE event_type IS NULL OR event_type NOT IN {_TYPES_SQL}), count(*) FROM events
          UNION ALL
          SELECT 'valid_event_time', 'drop', count(*) FILTER (WHERE ts IS NULL), count(*) FROM events) t""",
)
def q_expectation_counts(spark, sf_dir):
    flat = flatten_events(fx.raw_events(fx.table(spark, sf_dir, "events")))
    warn, drop = event_expectations(fx.FIXTURE_VALID_TYPES)
    return expectation_counts(flat, warn=warn, drop=drop)


# ---------------------------------------------------------------- data-exception flow
def _checked(spark, sf_dir):
    feed = fx.customers(fx.table(spark, sf_dir, "customer"))
    return apply_checks(normalize_identifier(feed, "ssn", "ssn_norm"), SSN_RULES)


@_register(
    "normalize_identifier",
    f"SELECT customer_id, ssn, {_NORM_SQL} AS ssn_norm FROM ({_CUSTOMERS_SQL}) c",
)
def q_normalize_identifier(spark, sf_dir):
    feed = fx.customers(fx.table(spark, sf_dir, "customer"))
    return normalize_identifier(feed, "ssn", "ssn_norm").select("customer_id", "ssn", "ssn_norm")


@_register("dq_flags", f"SELECT customer_id, ssn_norm, error_rules, warning_rules FROM ({_CHECKED_SQL}) k")
def q_dq_flags(spark, sf_dir):
    return _checked(spark, sf_dir).select(
        "customer_id",
        "ssn_norm",
        rule_names("_errors").alias("error_rules"),
        rule_names("_warnings").alias("warning_rules"),
    )


@_register(
    "dq_valid",
    f"""SELECT customer_id, customer_name, ssn, account_balance, record_id, source_system, event_ts, ssn_norm
        FROM ({_CHECKED_SQL}) k WHERE error_rules IS NULL""",
)
def q_dq_valid(spark, sf_dir):
    return as_naive_timestamps(get_valid(_checked(spark, sf_dir)))


@_register(
    "dq_exceptions",
    f"""SELECT customer_id, customer_name, ssn, account_balance, record_id, source_system, event_ts, ssn_norm,
               error_rules, warning_rules, TIMESTAMP '2024-03-01 00:00:00' AS exception_ts,
               'PENDING' AS review_status
        FROM ({_CHECKED_SQL}) k WHERE error_rules IS NOT NULL OR warning_rules IS NOT NULL""",
)
def q_dq_exceptions(spark, sf_dir):
    exc = to_exceptions(get_invalid(_checked(spark, sf_dir)), as_of=AS_OF)
    out = exc.withColumns({"error_rules": rule_names("_errors"), "warning_rules": rule_names("_warnings")})
    return as_naive_timestamps(out.drop("_errors", "_warnings"))


# ---------------------------------------------------------------- SCD2 history
_EVENTS_FEED_SQL = "SELECT user_id, ts, event_type, event_id, value FROM events"
_ORDERS_FEED_SQL = """
    SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
      FROM orders WHERE o_orderdate IS NOT NULL) o WHERE rn = 1"""
_ORDERS_SCD2_SQL = _scd2_sql(
    _ORDERS_FEED_SQL, "o_custkey", "o_orderdate", ["o_orderstatus", "o_orderpriority"],
    ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"],
)


def _orders_history(spark, sf_dir):
    feed = fx.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    return scd2(feed, "o_custkey", "o_orderdate", track=["o_orderstatus", "o_orderpriority"], tie_break=["o_orderkey"])


@_register(
    "scd2_history",
    _scd2_sql(_EVENTS_FEED_SQL, "user_id", "ts", ["event_type"], ["event_type", "event_id", "value"]),
)
def q_scd2_history(spark, sf_dir):
    feed = fx.table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "event_id", "value")
    return scd2(feed, "user_id", "ts", track=["event_type"])


@_register("scd2_orders", _ORDERS_SCD2_SQL)
def q_scd2_orders(spark, sf_dir):
    return _orders_history(spark, sf_dir)


@_register("scd2_latest", f'SELECT * FROM ({_ORDERS_SCD2_SQL}) h WHERE "__END_AT" IS NULL')
def q_scd2_latest(spark, sf_dir):
    return latest(_orders_history(spark, sf_dir))


# ---------------------------------------------------------------- sliced API source (batch side)
@_register(
    "slice_plan",
    """WITH r AS (SELECT user_id, date_trunc('hour', min(ts)) AS s, max(ts) AS e FROM events GROUP BY user_id)
       SELECT user_id, s AS start, e AS "end", slice_start, slice_start + INTERVAL 1 HOUR AS slice_end
       FROM (SELECT *, unnest(generate_series(s, e - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS slice_start
             FROM r WHERE s + INTERVAL 1 HOUR <= e) t""",
)
def q_slice_plan(spark, sf_dir):
    ranges = fx.location_ranges(fx.table(spark, sf_dir, "events"))
    return as_naive_timestamps(plan_slices(ranges, "start", "end", "1 hour"))


@_register(
    "explode_hourly",
    """SELECT location_id, date_trunc('hour', ts) AS time, max(value) AS temperature, '°C' AS unit,
              40.0 + CAST(location_id % 10 AS DOUBLE) AS latitude, -80.0 - CAST(location_id % 7 AS DOUBLE) AS longitude,
              CAST(100.0 AS DOUBLE) AS elevation, CAST(0.25 AS DOUBLE) AS generationtime_ms, 0 AS utc_offset_seconds,
              'GMT' AS timezone, 'GMT' AS timezone_abbreviation
       FROM (SELECT *, user_id % 50 AS location_id FROM events) e GROUP BY location_id, date_trunc('hour', ts)""",
)
def q_explode_hourly(spark, sf_dir):
    responses = fx.api_responses(fx.table(spark, sf_dir, "events"))
    return as_naive_timestamps(explode_hourly(responses, "body", keep=("location_id",)))


# ---------------------------------------------------------------- cost monitor
_SAMPLES_SQL = """
    SELECT 'run_' || CAST(o_orderkey % 50 AS VARCHAR) AS run_id, o_orderdate AS sampled_at,
           'cluster_' || CAST(o_custkey % 7 AS VARCHAR) AS cluster_id,
           CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'P' THEN 'RESIZING' WHEN 'F' THEN 'TERMINATED' END AS state,
           CAST(o_orderkey % 4 AS INTEGER) AS num_workers, CAST(o_custkey % 3 AS BIGINT) AS queries_run
    FROM orders"""
_COST_LOG_SQL = f"""
    SELECT run_id, strftime(sampled_at, '%Y-%m-%dT%H:%M:%S') AS run_timestamp, cluster_id,
           coalesce(state, 'UNKNOWN') AS cluster_state, dbu_estimate, queries_run,
           queries_run = 0 AND dbu_estimate > 0.5 AS idle
    FROM (SELECT *, CAST(CASE WHEN state IN ('RUNNING', 'RESIZING') THEN round(2.0 + coalesce(num_workers, 0) * 1.0, 2)
                              ELSE 0.0 END AS DOUBLE) AS dbu_estimate FROM ({_SAMPLES_SQL}) s) d"""


def _cost_log(spark, sf_dir):
    return cost_log(fx.cluster_samples(fx.table(spark, sf_dir, "orders")))


@_register("cost_log", _COST_LOG_SQL)
def q_cost_log(spark, sf_dir):
    return _cost_log(spark, sf_dir)


@_register(
    "idle_alerts",
    f"""SELECT run_id, run_timestamp, cluster_id, dbu_estimate,
               'ALERT: Cluster ' || cluster_id || ' is idle but consuming ' || CAST(dbu_estimate AS VARCHAR)
               || ' DBU/hr. Consider terminating.' AS message
        FROM ({_COST_LOG_SQL}) l WHERE idle""",
)
def q_idle_alerts(spark, sf_dir):
    return idle_alerts(_cost_log(spark, sf_dir))


@_register(
    "cost_per_run",
    f"""SELECT run_id, round(sum(dbu_estimate), 2) AS dbu_total, count(*) AS samples,
               count(*) FILTER (WHERE idle) AS idle_samples FROM ({_COST_LOG_SQL}) l GROUP BY run_id""",
)
def q_cost_per_run(spark, sf_dir):
    return cost_per_run(_cost_log(spark, sf_dir))


@_register(
    "idle_dbu_per_week",
    f"""SELECT date_trunc('week', CAST(run_timestamp AS TIMESTAMP)) AS week_start,
               round(sum(dbu_estimate), 2) AS idle_dbu, count(*) AS idle_samples
        FROM ({_COST_LOG_SQL}) l WHERE idle GROUP BY 1""",
)
def q_idle_dbu_per_week(spark, sf_dir):
    return idle_dbu_per_week(_cost_log(spark, sf_dir))


# ---------------------------------------------------------------- streamed flows (files -> stream -> table)
def _scratch(spark, name):
    from lakeshift.session import scratch_dir

    return scratch_dir(spark, name)


@_register(
    "json_stream_bronze",
    """WITH e AS (SELECT *, coalesce(event_id % 83 = 0, false) AS cut FROM events)
       SELECT CASE WHEN NOT cut THEN CAST(event_id AS VARCHAR) END AS id, CASE WHEN NOT cut THEN event_type END AS event_type,
              CASE WHEN NOT cut THEN 'user_' || CAST(user_id AS VARCHAR) END AS actor_login,
              CASE WHEN NOT cut THEN user_id END AS actor_id,
              CASE WHEN NOT cut THEN 'repo_' || CAST(user_id % 40 AS VARCHAR) END AS repo_name,
              CASE WHEN cut OR event_id % 59 = 0 THEN NULL ELSE user_id % 40 END AS repo_id,
              CASE WHEN NOT cut THEN ts END AS event_time,
              CASE WHEN cut OR event_id % 3 = 0 THEN NULL ELSE 'org_' || CAST(user_id % 5 AS VARCHAR) END AS org_login,
              CASE WHEN cut OR event_id % 77 = 0 THEN NULL ELSE event_id % 2 = 0 END AS public,
              CASE WHEN NOT cut THEN NULLIF(concat_ws(',', CASE WHEN event_id % 50 = 0 THEN 'extra_field' END,
                                    CASE WHEN event_id % 77 = 0 THEN 'public' END,
                                    CASE WHEN event_id % 59 = 0 THEN 'repo' END), '') END AS rescued_keys,
              CASE WHEN cut THEN 'cut ' || CAST(event_id AS VARCHAR) END AS corrupt_record,
              true AS has_source_file
       FROM e""",
)
def q_json_stream_bronze(spark, sf_dir):
    from lakeshift.plans.medallion import ingest_bronze
    from lakeshift.sources.files import read_stored

    root = _scratch(spark, "json_bronze")
    fx.write_event_drop(fx.table(spark, sf_dir, "events"), f"{root}/raw", mutate=True)
    ingest_bronze(spark, f"{root}/raw", f"{root}/bronze", f"{root}/_checkpoint")
    flat = flatten_events(read_stored(spark, f"{root}/bronze"), carry=("_rescued_data", "_corrupt_record"))
    keys = F.array_join(F.array_sort(F.map_keys(F.from_json("_rescued_data", "map<string,string>"))), ",")
    return as_naive_timestamps(
        flat.select(
            "id", "event_type", "actor_login", "actor_id", "repo_name", "repo_id", "event_time", "org_login", "public",
            keys.alias("rescued_keys"), F.col("_corrupt_record").alias("corrupt_record"), F.col("_source_file").isNotNull().alias("has_source_file"),
        )
    )


@_register("medallion_gold_top", _top_sql("repo_name", "hour", 1, True))
def q_medallion_gold_top(spark, sf_dir):
    from lakeshift.plans.medallion import MedallionPaths, run_medallion
    from lakeshift.sources.files import read_stored

    root = _scratch(spark, "medallion")
    fx.write_event_drop(fx.table(spark, sf_dir, "events"), f"{root}/raw", mutate=False)
    paths = MedallionPaths(f"{root}/raw", f"{root}/bronze", f"{root}/_ckpt", f"{root}/silver", f"{root}/top", f"{root}/vol")
    run_medallion(spark, paths, fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, 1)
    return as_naive_timestamps(read_stored(spark, paths.gold_top))


@_register("medallion_incremental_top", _top_sql("repo_name", "hour", 1, True))
def q_medallion_incremental_top(spark, sf_dir):
    from lakeshift.plans.medallion import MedallionPaths, run_medallion_incremental
    from lakeshift.sources.files import read_stored

    events = fx.table(spark, sf_dir, "events")
    root = _scratch(spark, "medallion_inc")
    paths = MedallionPaths(f"{root}/raw", f"{root}/bronze", f"{root}/_bck", f"{root}/silver", f"{root}/top", f"{root}/vol")
    # two hourly drops; days from the 15th receive events in both
    second = F.coalesce(F.expr("ts >= '2024-01-15' AND event_id % 2 = 1"), F.lit(False))
    fx.write_event_drop(events.filter(~second), paths.raw, mutate=False)
    run_medallion_incremental(spark, paths, f"{root}/_sck", fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, 1)
    fx.raw_event_lines(events.filter(second), mutate=False).write.mode(
        "append"
    ).option("maxRecordsPerFile", fx.records_per_file(events)).text(paths.raw)
    run_medallion_incremental(spark, paths, f"{root}/_sck", fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, 1)
    return as_naive_timestamps(read_stored(spark, paths.gold_top).drop("event_date"))


@_register(
    "csv_evolution",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS account_balance,
              CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS segment,
              CASE WHEN c_custkey % 3 = 2 THEN c_nationkey END AS nation
       FROM customer""",
)
def q_csv_evolution(spark, sf_dir):
    from lakeshift.plans.csv_autoload import run_csv_autoload

    root = _scratch(spark, "csv_autoload")
    fx.write_customer_csv_drop(fx.table(spark, sf_dir, "customer"), f"{root}/drop")
    table = run_csv_autoload(spark, f"{root}/drop", f"{root}/table", f"{root}/_schema", f"{root}/_ckpt", 2)
    return table.select(
        F.col("customer_id").cast("bigint"),
        F.col("customer_name").cast("string"),
        F.col("account_balance").cast("double"),
        F.col("segment").cast("string"),
        F.col("nation").cast("int"),
    )


@_register(
    "csv_type_evolution",
    """SELECT CASE WHEN c_custkey % 2 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 9, '0')
                   ELSE 'x' || CAST(c_custkey AS VARCHAR) END AS customer_code,
              c_name AS customer_name, c_acctbal AS "account.balance",
              CASE WHEN c_custkey % 2 = 1 THEN c_nationkey END AS nation
       FROM customer""",
)
def q_csv_type_evolution(spark, sf_dir):
    from lakeshift.plans.csv_autoload import run_csv_autoload

    root = _scratch(spark, "csv_types")
    customer = fx.table(spark, sf_dir, "customer")
    # codes of digits with leading zeros, then codes of letters: bigint or int, then text
    for part, mode in ((0, "overwrite"), (1, "append")):
        fx.write_customer_code_drop(customer, f"{root}/drop", part, mode)
        table = run_csv_autoload(spark, f"{root}/drop", f"{root}/table", f"{root}/_schema", f"{root}/_ckpt")
    return table.select("customer_code", "customer_name", F.col("`account.balance`"), F.col("nation").cast("int"))


_FEED2_SQL = f"""
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name,
           CASE WHEN c_custkey % 5 = 0 THEN lpad(CAST(100 + c_custkey % 500 AS VARCHAR), 3, '0') || '-' ||
                lpad(CAST(1 + c_custkey % 98 AS VARCHAR), 2, '0') || '-' || lpad(CAST(1 + c_custkey % 9998 AS VARCHAR), 4, '0')
                ELSE {_SSN_SQL} END AS ssn,
           CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 100.0 ELSE c_acctbal END AS account_balance,
           's' || CAST(c_custkey AS VARCHAR) AS record_id, 'seed' AS source_system,
           TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 30 DAY + to_seconds(c_custkey) AS event_ts
    FROM customer"""
_FEED_CHECKED_SQL = _CHECKED_SQL.replace(f"FROM ({_CUSTOMERS_SQL}) c", f"FROM ({_CUSTOMERS_SQL} UNION ALL {_FEED2_SQL}) c")
_CUST_CONTENT = ["customer_name", "ssn", "account_balance", "record_id", "source_system", "ssn_norm", "error_rules", "warning_rules"]
_CUST_TRACK = ["customer_name", "ssn", "account_balance", "source_system", "ssn_norm"]


def _run_exception_flow(spark, sf_dir):
    from lakeshift.plans.exceptions import ExceptionPaths, run_exception_workflow

    root = _scratch(spark, "exceptions")
    fx.write_customer_feed(fx.table(spark, sf_dir, "customer"), f"{root}/raw")
    names = ["checkpoint", "checked", "exceptions", "exceptions_log", "exceptions_history", "valid", "valid_log", "valid_history"]
    paths = ExceptionPaths(f"{root}/raw", *[f"{root}/{n}" for n in names])
    # one micro-batch per stored file: the second load is merged into the histories incrementally
    return run_exception_workflow(spark, paths, as_of=AS_OF, buckets=8, max_files_per_trigger=1)


def _history_out(hist):
    return as_naive_timestamps(
        hist.select(
            "customer_id", "customer_name", "ssn", "account_balance", "record_id", "source_system", "ssn_norm",
            rule_names("_errors").alias("error_rules") if "_errors" in hist.columns else F.lit(None).cast("string").alias("error_rules"),
            rule_names("_warnings").alias("warning_rules") if "_warnings" in hist.columns else F.lit(None).cast("string").alias("warning_rules"),
            "event_ts", "__START_AT", "__END_AT",
        )
    )


@_register(
    "stream_open_exceptions",
    "SELECT * FROM ("
    + _scd2_sql(
        f"SELECT * FROM ({_FEED_CHECKED_SQL}) k WHERE error_rules IS NOT NULL OR warning_rules IS NOT NULL",
        "customer_id", "event_ts", _CUST_TRACK, _CUST_CONTENT,
    )
    + ') h WHERE "__END_AT" IS NULL',
)
def q_stream_open_exceptions(spark, sf_dir):
    exc_hist, _ = _run_exception_flow(spark, sf_dir)
    return _history_out(latest(exc_hist))


@_register(
    "stream_valid_history",
    _scd2_sql(
        f"SELECT * FROM ({_FEED_CHECKED_SQL}) k WHERE error_rules IS NULL",
        "customer_id", "event_ts", _CUST_TRACK, _CUST_CONTENT,
    ),
)
def q_stream_valid_history(spark, sf_dir):
    _, valid_hist = _run_exception_flow(spark, sf_dir)
    return _history_out(valid_hist)


@_register(
    "sliced_stream",
    """SELECT 'fixture' AS source, date_trunc('hour', ts) AS time, max(value) AS temperature, '°C' AS unit,
              'loc_' || CAST(location_id AS VARCHAR) AS location_name,
              40.0 + CAST(location_id % 10 AS DOUBLE) AS latitude, -80.0 - CAST(location_id % 7 AS DOUBLE) AS longitude,
              CAST(100.0 AS DOUBLE) AS elevation, CAST(0.25 AS DOUBLE) AS generationtime_ms, 0 AS utc_offset_seconds,
              'GMT' AS timezone, 'GMT' AS timezone_abbreviation
       FROM (SELECT *, user_id % 50 AS location_id FROM events) e GROUP BY location_id, date_trunc('hour', ts)""",
)
def q_sliced_stream(spark, sf_dir):
    from lakeshift.plans.sliced_ingest import run_sliced_ingest

    events = fx.table(spark, sf_dir, "events")
    root = _scratch(spark, "sliced")
    fx.write_api_responses(events, f"{root}/responses")
    # The source's configuration: at most fx.LOCATIONS locations and the covered range.
    locations = [
        {"name": r["name"], "latitude": r["latitude"], "longitude": r["longitude"]}
        for r in fx.fixture_locations(events).collect()
    ]
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    table = run_sliced_ingest(
        spark, locations, {"url": "", "source": "fixture"}, f"{root}/table", f"{root}/_ckpt",
        start=lo.isoformat(), end=(hi.replace(minute=0, second=0, microsecond=0) + timedelta(hours=1)).isoformat(),
        hours_per_slice=24, responses=f"{root}/responses",
    )
    cols = ["source", "time", "temperature", "unit", "location_name", "latitude", "longitude", "elevation",
            "generationtime_ms", "utc_offset_seconds", "timezone", "timezone_abbreviation"]
    # API times are instants: present them as UTC wall-clock, whatever the session zone
    utc = F.to_utc_timestamp("time", spark.conf.get("spark.sql.session.timeZone")).cast("timestamp_ntz")
    return table.select(*cols).withColumn("time", utc)


@_register(
    "cost_monitor_alerts",
    f"""SELECT run_id, run_timestamp, cluster_id, dbu_estimate,
               'ALERT: Cluster ' || cluster_id || ' is idle but consuming ' || CAST(dbu_estimate AS VARCHAR)
               || ' DBU/hr. Consider terminating.' AS message
        FROM ({_COST_LOG_SQL}) l WHERE idle""",
)
def q_cost_monitor_alerts(spark, sf_dir):
    from lakeshift.plans.cost_monitor import run_cost_monitor

    root = _scratch(spark, "cost")
    samples = fx.cluster_samples(fx.table(spark, sf_dir, "orders"))
    run_cost_monitor(spark, samples, f"{root}/cost_log")
    return run_cost_monitor(spark, samples, f"{root}/cost_log")  # the repeated run adds nothing


@_register(
    "scd2_late_batches",
    _scd2_sql(_EVENTS_FEED_SQL, "user_id", "ts", ["event_type"], ["event_type", "event_id", "value"]),
)
def q_scd2_late_batches(spark, sf_dir):
    """The feed in four batches that interleave in time (all but the first are late), merged on read."""
    from lakeshift.streaming import Scd2Sink

    root = _scratch(spark, "scd2_late")
    feed = fx.table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "event_id", "value")
    rows = feed.count()
    sink = Scd2Sink(f"{root}/log", f"{root}/history", ["user_id"], "ts", track=["event_type"], fan_in=2, rebuild_rows=rows // 2)
    for i in range(4):
        sink(feed.filter(F.coalesce(F.pmod("event_id", F.lit(4)), F.lit(0)) == i), i)
    return sink.read(spark)


@_register(
    "scd2_rejects",
    """SELECT event_id % 2 AS batch_id, count(*) FILTER (WHERE event_id % 101 <> 0 AND ts IS NOT NULL) AS accepted_rows,
              count(*) FILTER (WHERE event_id % 101 = 0 OR ts IS NULL) AS rejected_rows
       FROM events WHERE event_id IS NOT NULL GROUP BY 1""",
)
def q_scd2_rejects(spark, sf_dir):
    """Records without a sequence leave the history by the reject table; both add up to the input."""
    from lakeshift.streaming import Scd2Sink
    from lakeshift.streaming.scd2_sink import BATCH

    root = _scratch(spark, "scd2_rejects")
    feed = fx.table(spark, sf_dir, "events").filter("event_id IS NOT NULL").select(
        "user_id", F.when(F.col("event_id") % 101 != 0, F.col("ts")).alias("ts"), "event_type", "event_id"
    )
    sink = Scd2Sink(f"{root}/log", f"{root}/history", ["user_id"], "ts", track=["event_type"])
    for i in (0, 1):
        sink(feed.filter(F.col("event_id") % 2 == i), i)
    sides = sink.records(spark).select(BATCH, F.lit(1).alias("ok")).unionByName(sink.rejected(spark).select(BATCH, F.lit(0).alias("ok")))
    return sides.groupBy(F.col(BATCH).cast("bigint").alias("batch_id")).agg(
        F.sum("ok").alias("accepted_rows"), F.sum(1 - F.col("ok")).alias("rejected_rows")
    )


@_register("stream_expectation_log", _ORACLE["expectation_counts"])
def q_stream_expectation_log(spark, sf_dir):
    """Expectation counters of a stream of several batches, from the durable log."""
    from lakeshift.streaming import batch_partitioned_append, expectation_totals, run_to_completion, with_expectations

    root = _scratch(spark, "expectation_log")
    bronze = fx.raw_events(fx.table(spark, sf_dir, "events"))
    bronze.write.option("maxRecordsPerFile", fx.records_per_file(bronze)).parquet(f"{root}/bronze")
    stream = spark.readStream.schema(bronze.schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/bronze")
    warn, drop = event_expectations(fx.FIXTURE_VALID_TYPES)
    handler = with_expectations(batch_partitioned_append(f"{root}/silver"), f"{root}/log", "silver_events", warn, drop)
    writer = flatten_events(stream).writeStream.foreachBatch(handler).option("checkpointLocation", f"{root}/_checkpoint")
    run_to_completion(writer.trigger(availableNow=True).start())
    return expectation_totals(spark, f"{root}/log", "silver_events").drop("batches")


@_register(
    "json_inferred_bronze",
    """SELECT event_id, ts, user_id, event_type, props, CASE WHEN event_id % 14 = 7 THEN NULL ELSE value END AS value,
              NULLIF(concat_ws(',', CASE WHEN event_id % 2 = 1 THEN 'added' END,
                               CASE WHEN event_id % 14 = 7 AND value IS NOT NULL THEN 'value' END), '') AS rescued_keys
       FROM events WHERE event_id IS NOT NULL""",
)
def q_json_inferred_bronze(spark, sf_dir):
    """JSON drops whose columns the code does not name: types inferred from the first drop and stored; what the
    second drop adds or mistypes is rescued."""
    from lakeshift.plans.medallion import ingest_bronze
    from lakeshift.sources.files import read_stored

    root = _scratch(spark, "json_inferred")
    events = fx.table(spark, sf_dir, "events").filter("event_id IS NOT NULL")
    for part in (0, 1):
        fx.write_plain_drop(events.filter(F.col("event_id") % 2 == part), f"{root}/raw", part)
        ingest_bronze(spark, f"{root}/raw", f"{root}/bronze", f"{root}/_checkpoint", schema_store=f"{root}/_schema")
    keys = F.array_join(F.array_sort(F.map_keys(F.from_json("_rescued_data", "map<string,string>"))), ",")
    bronze = read_stored(spark, f"{root}/bronze").withColumn("rescued_keys", keys)
    inferred = [c for c in bronze.columns if c in events.columns]
    return bronze.select(*inferred, "rescued_keys").withColumn("ts", F.col("ts").try_cast("timestamp_ntz"))


@_register("published_tables", _ORACLE["event_volume"])
def q_published_tables(spark, sf_dir):
    """Named tables from end to end: appended, streamed into a partitioned table, published twice, read back."""
    import uuid

    from lakeshift.plans.medallion import publish_medallion
    from lakeshift.sinks import append_batch, append_stream_to_table
    from lakeshift.sources.files import read_stored_stream
    from lakeshift.streaming import run_to_completion

    root, db = _scratch(spark, "published"), f"lakeshift_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{root}/{db}.db'")
    events = fx.table(spark, sf_dir, "events")
    for part in (0, 1):
        append_batch(events.filter(F.coalesce(F.col("event_id") % 2, F.lit(0)) == part), f"{db}.raw_events")
        stream = read_stored_stream(spark, f"{db}.raw_events")
        query = append_stream_to_table(
            stream, f"{db}.typed_events", f"{root}/_checkpoint", partition_by=["event_type"], query_name=f"{db}_typed", comment="Events by type"
        )
        run_to_completion(query)
        bronze = fx.raw_events(spark.table(f"{db}.typed_events"))
        publish_medallion(spark, bronze, fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, database=db)
    return as_naive_timestamps(spark.table(f"{db}.gold_event_volume"))


@_register("compacted_batches", "SELECT event_id, user_id, event_type, value FROM events")
def q_compacted_batches(spark, sf_dir):
    """The events as 16 appended batches, merged to few files; a batch replayed after that changes nothing."""
    from lakeshift.sinks.batch_table import BatchTable

    table = BatchTable(f"{_scratch(spark, 'batches')}/events", sort_by=["event_type"])
    events = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    batch = lambda i: events.filter(F.coalesce(F.pmod("event_id", F.lit(16)), F.lit(0)) == i)
    for i in range(16):
        table(batch(i), i)
    table.compact(spark)
    table(batch(5), 5)
    return table.read(spark)


# ---------------------------------------------------------------- training-data operators
def _register_llm() -> None:
    """Add the queries of the llm subpackage and the pipeline, where these are present."""
    if importlib.util.find_spec("lakeshift.llm") is None:
        return
    from lakeshift.llm import registry

    _QUERIES.update(registry.queries())
    _ORACLE.update(registry.oracle_sql())
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        _QUERIES["pipeline"] = lambda spark, sf_dir: corpus_pipeline.run(spark, sf_dir)
        if corpus_pipeline.ORACLE_SQL is not None:
            _ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


_register_llm()


# ---------------------------------------------------------------- contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: hourly top repositories (silver -> roll-up -> tie-aware top-K)."""
    return q_top_repos_per_hour(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)

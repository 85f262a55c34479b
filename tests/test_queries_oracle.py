"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

from conftest import SF01

# The queries of the training-data subpackage, which may be absent, have tests of their own.
LLM = {n for n in E.queries() if n == "pipeline" or n.startswith("op")}
SLOW = {"sliced_stream", "stream_open_exceptions", "stream_valid_history", "csv_evolution", "csv_type_evolution", "json_stream_bronze",
        "medallion_gold_top", "medallion_incremental_top", "scd2_late_batches", "published_tables"}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", [n for n in E.queries() if n not in SLOW | LLM])
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF01, name, E.queries()[name], E.oracle_sql().get(name), con)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "total_events" in df.columns


def test_every_query_has_oracle():
    assert set(E.queries()) - LLM == set(E.oracle_sql()) - LLM


def test_hourly_top_cuts(spark):
    qs = E.queries()
    assert 0 < qs["top_repos_per_hour"](spark, SF01).count() < qs["entity_activity"](spark, SF01).count()


@pytest.mark.parametrize("name", ["silver_events", "dq_exceptions", "cost_log", "idle_dbu_per_week", "slice_plan"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, SF01, name, E.queries()[name], E.oracle_sql().get(name), con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert r["status"] == "ok", r

"""Hot keys and replays: the cases a large cluster meets."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeshift.operators.clean import silver_events
from lakeshift.operators.history import scd2
from lakeshift.plans import fixtures as fx
from lakeshift.plans.exceptions import ExceptionPaths, run_exception_workflow
from lakeshift.streaming.scd2_sink import Scd2Sink
from lakeshift.streaming.streams import observed_totals, run_to_completion

from conftest import SF001


def _hot_feed(spark):
    """events where user 0 additionally owns a copy of every event (a third of
    all rows after the union), shifted by a millisecond so sequences stay unique."""
    ev = fx.table(spark, SF001, "events").select("user_id", "ts", "event_type", "event_id")
    hot = ev.select(F.lit(0).cast("bigint").alias("user_id"), (F.col("ts") + F.expr("INTERVAL 1 MILLISECOND")).alias("ts"),
                    "event_type", (F.col("event_id") + 10_000_000).alias("event_id"))
    return ev.unionByName(hot).unionByName(hot.withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 MILLISECOND"))
                                            .withColumn("event_id", F.col("event_id") + 10_000_000))


def test_hot_key_scd2_chunked_equals_plain(spark):
    feed = _hot_feed(spark)
    n = feed.count()
    hot = feed.filter("user_id = 0").count()
    assert hot * 3 > n  # user 0 holds more than a third
    plain = scd2(feed, "user_id", "ts", track=["event_type"], chunk_rows=10 * n)
    chunked = scd2(feed, "user_id", "ts", track=["event_type"], chunk_rows=max(50, hot // 40))
    assert plain.count() == chunked.count()
    assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0


def test_scd2_sink_replay_is_idempotent(spark, tmp):
    ev = fx.table(spark, SF001, "events").select("user_id", "ts", "event_type", "event_id")
    sink = Scd2Sink(f"{tmp}/log", f"{tmp}/hist", ["user_id"], "ts", track=["event_type"], buckets=4)
    half1, half2 = ev.filter("event_id % 2 = 0"), ev.filter("event_id % 2 = 1")
    sink(half1, 0)
    sink(half2, 1)
    once = sink.read(spark)
    rows_once = sorted(map(tuple, once.collect()), key=repr)
    sink(half2, 1)  # the same batch replayed after a failure
    again = sink.read(spark)  # re-read: the replay replaced the touched buckets' files
    assert sorted(map(tuple, again.collect()), key=repr) == rows_once
    expected = scd2(ev, "user_id", "ts", track=["event_type"]).select(again.columns)
    assert again.exceptAll(expected).count() == 0 and expected.exceptAll(again).count() == 0


def test_exception_flow_restart_adds_nothing(spark, tmp):
    fx.write_customer_feed(fx.table(spark, SF001, "customer"), f"{tmp}/raw")
    names = ["checkpoint", "checked", "exceptions", "exceptions_log", "exceptions_history", "valid", "valid_log",
             "valid_history"]
    paths = ExceptionPaths(f"{tmp}/raw", *[f"{tmp}/{n}" for n in names])
    exc1, val1 = run_exception_workflow(spark, paths, as_of=datetime(2024, 3, 1), buckets=4, max_files_per_trigger=1)
    c1 = (exc1.count(), val1.count(), spark.read.parquet(paths.checked).count())
    exc2, val2 = run_exception_workflow(spark, paths, as_of=datetime(2024, 3, 1), buckets=4)
    assert (exc2.count(), val2.count(), spark.read.parquet(paths.checked).count()) == c1
    assert c1[2] == 2 * fx.table(spark, SF001, "customer").count()


def test_stream_expectation_counters(spark, tmp):
    ev = fx.table(spark, SF001, "events")
    fx.raw_events(ev).write.parquet(f"{tmp}/bronze")
    stream = spark.readStream.schema(fx.raw_events(ev).schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/bronze")
    silver = silver_events(stream, fx.FIXTURE_VALID_TYPES, observation="silver_checks")
    q = (silver.writeStream.format("parquet").option("checkpointLocation", f"{tmp}/ck")
         .trigger(availableNow=True).start(f"{tmp}/silver"))
    run_to_completion(q)
    totals = observed_totals(q, "silver_checks")
    assert totals["input_rows"] == ev.count()
    assert totals["valid_event_type_failed"] == ev.filter("event_type = 'error'").count()
    assert spark.read.parquet(f"{tmp}/silver").count() == ev.count() - totals["valid_event_type_failed"]


def test_scd2_sink_refuses_another_bucket_count(spark, tmp):
    ev = fx.table(spark, SF001, "events").select("user_id", "ts", "event_type", "event_id")
    of = lambda n: Scd2Sink(f"{tmp}/log", f"{tmp}/hist", ["user_id"], "ts", track=["event_type"], buckets=n)
    of(4)(ev, 0)
    with pytest.raises(ValueError, match="laid out in 4 buckets"):
        of(7)(ev, 1)


def test_one_stamp_per_exception(spark, tmp):
    fx.write_customer_feed(fx.table(spark, SF001, "customer"), f"{tmp}/raw")
    names = ["checkpoint", "checked", "exceptions", "exceptions_log", "exceptions_history", "valid", "valid_log",
             "valid_history"]
    paths = ExceptionPaths(f"{tmp}/raw", *[f"{tmp}/{n}" for n in names])
    run_exception_workflow(spark, paths, buckets=4)
    stamps = lambda p: {r[0] for r in spark.read.parquet(p).select("exception_ts").distinct().collect()}
    assert len(stamps(paths.exceptions)) == 1 and stamps(paths.exceptions) == stamps(paths.exceptions_log)
    for p in (paths.checked, paths.valid, paths.exceptions, paths.valid_log):
        assert "__stamp" not in spark.read.parquet(p).columns


def test_cost_monitor_run_twice_adds_nothing(spark, tmp):
    from lakeshift.plans.cost_monitor import run_cost_monitor

    samples = fx.cluster_samples(fx.table(spark, SF001, "orders"))
    blank = samples.limit(1).select(F.lit(None).cast("string").alias("run_id"), F.lit(None).cast("timestamp").alias("sampled_at"),
                                    "cluster_id", F.lit("RUNNING").alias("state"), F.lit(3).alias("num_workers"),
                                    F.lit(0).cast("bigint").alias("queries_run"))
    samples = samples.unionByName(blank)
    first = run_cost_monitor(spark, samples, f"{tmp}/log").count()
    again = run_cost_monitor(spark, samples, f"{tmp}/log")
    assert again.count() == first > 0
    assert spark.read.parquet(f"{tmp}/log").count() == samples.count()
    assert again.filter("run_id is null").count() == 1

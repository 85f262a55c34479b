"""Stream = batch; restart on the same checkpoint adds nothing; streaming SCD2
equals batch SCD2."""

import os

from pyspark.sql import functions as F

from lakeshift.operators.history import scd2
from lakeshift.plans import fixtures as fx
from lakeshift.plans.medallion import ingest_bronze
from lakeshift.sources.files import read_json, read_stored
from lakeshift.schemas import RAW_EVENT
from lakeshift.streaming.scd2_sink import Scd2Sink
from lakeshift.streaming.streams import fan_out, run_to_completion

from conftest import SF001


def test_json_stream_equals_batch_and_restart_is_idempotent(spark, tmp):
    events = fx.table(spark, SF001, "events")
    fx.raw_event_lines(events).write.option("maxRecordsPerFile", 500).text(f"{tmp}/raw")
    batch = read_json(spark, f"{tmp}/raw", RAW_EVENT).select("id", "public", "_rescued_data")
    for per_trigger in (1, 3):
        out, ckpt = f"{tmp}/bronze{per_trigger}", f"{tmp}/ckpt{per_trigger}"
        ingest_bronze(spark, f"{tmp}/raw", out, ckpt, max_files_per_trigger=per_trigger)
        ingest_bronze(spark, f"{tmp}/raw", out, ckpt, max_files_per_trigger=per_trigger)  # restart: no new files
        stored = read_stored(spark, out)
        assert stored.count() == events.count()
        assert stored.filter(F.col("_source_file").isNull()).count() == 0
        got = stored.select("id", "public", "_rescued_data")
        assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_stream_scd2_equals_batch(spark, tmp):
    events = fx.table(spark, SF001, "events").select("user_id", "ts", "event_type", "event_id")
    events.repartition(4).write.parquet(f"{tmp}/feed")
    sink = Scd2Sink(f"{tmp}/log", f"{tmp}/hist", ["user_id"], "ts", track=["event_type"], buckets=4)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/feed")
    run_to_completion(fan_out(stream, {"h": sink}, f"{tmp}/ckpt"))
    streamed = sink.read(spark).select("user_id", "event_type", "event_id", "ts", "__START_AT", "__END_AT")
    expected = scd2(spark.read.parquet(f"{tmp}/feed"), "user_id", "ts", track=["event_type"]).select(streamed.columns)
    assert streamed.count() == expected.count()
    assert streamed.exceptAll(expected).count() == 0
    assert len(os.listdir(f"{tmp}/log")) > 0


def test_incremental_medallion_equals_full_recompute(spark, tmp):
    from lakeshift.operators.clean import silver_events
    from lakeshift.plans.medallion import MedallionPaths, build_golds, run_medallion_incremental

    events = fx.table(spark, SF001, "events")
    lines = fx.raw_event_lines(events, mutate=False)
    # Days from the 15th get events in both runs: their golds must combine both.
    first = events.filter("ts < '2024-01-15' OR event_id % 2 = 0")
    second = events.filter("ts >= '2024-01-15' AND event_id % 2 = 1")
    paths = MedallionPaths(f"{tmp}/raw", f"{tmp}/bronze", f"{tmp}/bck", f"{tmp}/silver", f"{tmp}/top", f"{tmp}/vol")
    fx.raw_event_lines(first, mutate=False).write.text(f"{tmp}/raw")
    run_medallion_incremental(spark, paths, f"{tmp}/sck", fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, 3)
    fx.raw_event_lines(second, mutate=False).write.mode("append").text(f"{tmp}/raw")
    run_medallion_incremental(spark, paths, f"{tmp}/sck", fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, 3)

    full_silver = silver_events(read_json(spark, f"{tmp}/raw", RAW_EVENT), fx.FIXTURE_VALID_TYPES)
    exp_top, exp_vol = build_golds(full_silver, 3, fx.FIXTURE_COUNTERS)
    got_top = spark.read.parquet(paths.gold_top).drop("event_date")
    got_vol = spark.read.parquet(paths.gold_volume).drop("event_date")
    for got, exp in ((got_top, exp_top), (got_vol, exp_vol)):
        exp = exp.select(got.columns)
        assert got.count() == exp.count()
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert spark.read.parquet(paths.silver).count() == full_silver.count()
    assert lines.count() == events.count()

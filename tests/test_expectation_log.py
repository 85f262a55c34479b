"""The durable expectation log: every batch of a long stream, replays and restarts."""

import os

import pytest
from pyspark.sql import functions as F

from lakeshift.operators.clean import event_expectations, flatten_events, silver_events
from lakeshift.operators.expectations import expectation_counts
from lakeshift.plans import fixtures as fx
from lakeshift.streaming import batch_partitioned_append, expectation_log, expectation_totals, observed_totals, run_to_completion, with_expectations

from conftest import SF001

WARN, DROP = {"small": "v < 900", "named": "name IS NOT NULL"}, {"odd": "v % 2 = 1"}
COLUMNS = ["rule", "action", "failed_rows", "passed_rows", "total_rows"]


def _rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def _feed(spark, n, files):
    name = F.when(F.col("id") % 7 != 0, F.concat(F.lit("n"), "id"))
    return spark.range(n).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("v"), name.alias("name")).repartition(files)


def test_150_batches_are_counted_in_full(spark, tmp):
    """More batches than a query's progress keeps (100 by default)."""
    feed = _feed(spark, 1500, 1).withColumn("batch", F.monotonically_increasing_id() % 150).cache()
    write = lambda df, i: df.write.format("noop").mode("overwrite").save()
    handler = with_expectations(write, f"{tmp}/log", "q1", WARN, DROP)
    for i in range(150):
        handler(feed.filter(F.col("batch") == i).coalesce(1), i)
    totals = expectation_totals(spark, f"{tmp}/log", "q1")
    assert {r["batches"] for r in totals.collect()} == {150}
    assert _rows(totals) == _rows(expectation_counts(feed, WARN, DROP))


def test_replayed_batch_replaces_its_counters(spark, tmp):
    a, b = _feed(spark, 100, 1), _feed(spark, 40, 1)
    handle = with_expectations(batch_partitioned_append(f"{tmp}/out"), f"{tmp}/log", "q", WARN, DROP)
    for batch, i in ((a, 0), (b, 1), (b, 1), (a, 0)):
        handle(batch, i)
    other = with_expectations(batch_partitioned_append(f"{tmp}/out2"), f"{tmp}/log", "other query", {"always": "true"})
    other(a.limit(0), 7)
    assert _rows(expectation_totals(spark, f"{tmp}/log", "q")) == _rows(expectation_counts(a.unionByName(b), WARN, DROP))
    assert _rows(expectation_totals(spark, f"{tmp}/log", "other query")) == [("always", "warn", 0, 0, 0)]
    assert expectation_log(spark, f"{tmp}/log").count() == 2 * 3 + 1
    assert expectation_totals(spark, f"{tmp}/nowhere", "q").count() == 0


def test_failed_batch_logs_nothing(spark, tmp):
    def fails(df, i):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        with_expectations(fails, f"{tmp}/log", "q", WARN)(_feed(spark, 10, 1), 0)
    assert expectation_totals(spark, f"{tmp}/log", "q").count() == 0


def test_incremental_medallion_logs_its_expectations(spark, tmp):
    from lakeshift.plans.medallion import SILVER_TABLE, MedallionPaths, run_medallion_incremental

    events = fx.table(spark, SF001, "events")
    paths = MedallionPaths(f"{tmp}/raw", f"{tmp}/bronze", f"{tmp}/bck", f"{tmp}/silver", f"{tmp}/top", f"{tmp}/vol")
    run = lambda: run_medallion_incremental(
        spark, paths, f"{tmp}/sck", fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, 3, expectation_log=f"{tmp}/log"
    )
    for part in (0, 1):
        fx.raw_event_lines(events.filter(F.col("event_id") % 2 == part), mutate=False).write.mode("append").text(f"{tmp}/raw")
        run()
    warn, drop = event_expectations(fx.FIXTURE_VALID_TYPES)
    want = expectation_counts(flatten_events(fx.raw_events(events)), warn, drop)
    assert _rows(expectation_totals(spark, f"{tmp}/log", SILVER_TABLE)) == _rows(want)


def test_golds_come_from_partial_counts_and_not_from_silver(spark, tmp):
    """With silver of earlier batches gone the golds of their dates still come out whole; a replay changes nothing."""
    from lakeshift.plans.medallion import MedallionPaths, build_golds, run_medallion_incremental
    from lakeshift.sources.files import delete_path

    events = fx.table(spark, SF001, "events")
    paths = MedallionPaths(f"{tmp}/raw", f"{tmp}/bronze", f"{tmp}/bck", f"{tmp}/silver", f"{tmp}/top", f"{tmp}/vol")
    run = lambda: run_medallion_incremental(spark, paths, f"{tmp}/sck", fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, 3)
    for part in (0, 1, 2):
        fx.raw_event_lines(events.filter(F.col("event_id") % 3 == part), mutate=False).write.mode("append").text(f"{tmp}/raw")
        if part == 2:
            delete_path(spark, paths.silver)
        run()
    # The last batch again, as after a crash before its commit.
    commits = [n for n in os.listdir(f"{tmp}/sck/commits") if n.isdigit()]
    for name in (max(commits, key=int), f".{max(commits, key=int)}.crc"):
        delete_path(spark, f"{tmp}/sck/commits/{name}")
    run()
    silver = silver_events(fx.raw_events(events), fx.FIXTURE_VALID_TYPES)
    for got, want in zip((paths.gold_top, paths.gold_volume), build_golds(silver, 3, fx.FIXTURE_COUNTERS), strict=True):
        got = spark.read.parquet(got).drop("event_date").select(want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert spark.read.parquet(paths.silver).count() < silver.count()


def test_progress_keeps_fewer_batches_than_the_log(spark, tmp):
    """Why the log exists: the recent progress of a stream is cut."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        fx.raw_events(fx.table(spark, SF001, "events")).repartition(12).write.parquet(f"{tmp}/b")
        schema = spark.read.parquet(f"{tmp}/b").schema
        stream = silver_events(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/b"), fx.FIXTURE_VALID_TYPES, "s")
        query = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp}/ck").trigger(availableNow=True).start()
        run_to_completion(query)
        assert observed_totals(query, "s")["input_rows"] < fx.table(spark, SF001, "events").count()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_batches_of_a_larger_table_are_larger(spark, tmp, monkeypatch):
    """The query's batches are as many for a table of many times the rows, and its counters whole."""
    import __spark_entry__

    monkeypatch.setattr(fx, "RECORDS_PER_FILE", 10)
    types, n = F.element_at(F.array(*map(F.lit, ["click", "view", "odd"])), (F.col("id") % 3 + 1).cast("int")), 20_000
    events = spark.range(n, numPartitions=2).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"), (F.col("id") % 90).alias("user_id"),
        types.alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props"),
    )
    events.write.parquet(f"{tmp}/sf/events.parquet")
    roots = []
    real = __spark_entry__._scratch
    monkeypatch.setattr(__spark_entry__, "_scratch", lambda spark, name: roots.append(real(spark, name)) or roots[-1])
    got = _rows(__spark_entry__.queries()["stream_expectation_log"](spark, f"{tmp}/sf"))
    assert {r[4] for r in got} == {n}
    log = expectation_log(spark, f"{roots[0]}/log")
    assert log.select("batch_id").distinct().count() <= fx.FILES_PER_DROP // 4 + 2  # 500 of files of ten rows

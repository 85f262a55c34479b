"""Compaction of batch runs: rows unchanged, readers undisturbed, replays idempotent."""

import os

import pytest
from pyspark.sql import functions as F

from lakeshift.sinks.batch_table import BatchTable
from lakeshift.streaming import fan_out, run_to_completion


def _rows(df):
    return sorted(r["id"] for r in df.select("id").collect())


def _files(path, runs):
    return sum(name.endswith(".parquet") for r in runs for name in os.listdir(f"{path}/{r.folder}"))


def test_100_batches_compacted_while_a_reader_runs(spark, tmp):
    table, n = BatchTable(f"{tmp}/t"), 100
    for i in range(n):
        table(spark.range(i * 50, i * 50 + 50, numPartitions=2), i)
    reader = table.read(spark)
    size = sum(r.size for r in table.runs(spark))
    assert len(table.runs(spark)) == n and table.compact(spark, size // 4) == n
    runs = table.runs(spark)
    assert len(runs) <= 5 and _files(table.path, runs) <= 2 * len(runs)
    assert _rows(reader) == _rows(table.read(spark)) == list(range(50 * n))  # the reader opened before goes on
    for i in (0, 57, 99):
        table(spark.range(5), i)  # replays
    assert _rows(table.read(spark)) == list(range(50 * n))
    table(spark.range(50 * n, 50 * n + 10), n)
    assert table.vacuum(spark) == n
    assert _rows(table.read(spark)) == list(range(50 * n + 10))
    assert table.compact(spark, 1 << 30) == len(runs) + 1 and len(table.runs(spark)) == 1
    assert table.compact(spark) == 0


def test_dead_batch_and_dead_merge_are_not_seen(spark, tmp):
    table = BatchTable(f"{tmp}/t", sort_by=["id"])
    with pytest.raises(ValueError):
        table.read(spark)
    for i in range(4):
        table(spark.range(i * 10, i * 10 + 10), i)
    spark.range(999).write.parquet(f"{tmp}/t/run=0-3-1")  # a merge that died before its marker
    spark.range(999).write.parquet(f"{tmp}/t/run=4-4-0")  # a batch that did
    assert _rows(table.read(spark)) == list(range(40))
    table(spark.range(40, 45).withColumn("more", F.lit("x")), 4)
    assert table.compact(spark) == 5
    got = table.read(spark)
    assert _rows(got) == list(range(45)) and got.filter("more IS NULL").count() == 40


def test_as_a_stream_handler(spark, tmp):
    spark.range(300).repartition(6).write.parquet(f"{tmp}/in")
    table = BatchTable(f"{tmp}/t")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    run_to_completion(fan_out(stream, {"t": table}, f"{tmp}/ck"))
    assert len(table.runs(spark)) == 6 and table.compact(spark) == 6
    assert _rows(table.read(spark)) == list(range(300))


def test_no_task_of_a_merge_sorts_more_than_its_rows(spark, tmp, monkeypatch):
    """Runs of few bytes, most rows of one key: the files that a merge writes are bounded by their rows, and in order."""
    monkeypatch.setattr("lakeshift.sinks.batch_table.SORT_ROWS", 2000)
    table = BatchTable(f"{tmp}/t", sort_by=["key"])
    for i in range(4):
        rows = spark.range(i * 5000, i * 5000 + 5000, numPartitions=2)
        table(rows.withColumn("key", F.when(F.col("id") % 10 == 0, F.col("id") % 3)), i)  # null: nine of ten rows
    assert table.compact(spark) == 4 and _rows(table.read(spark)) == list(range(20_000))
    files = table.read(spark).groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.collect_list("key").alias("keys")).collect()
    assert max(r["n"] for r in files) < 4000
    assert all(r["keys"] == sorted(r["keys"]) for r in files)

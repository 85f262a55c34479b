"""The streaming SCD2 sink: merge on read equals batch SCD2, work follows the batches, nothing is lost."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeshift.operators.history import scd2
from lakeshift.sources.files import list_names
from lakeshift.streaming.scd2_sink import BATCH, RUN, Scd2Sink

SCHEMA = "k long, name string, seq timestamp, v string, note long"
T0 = datetime(2024, 1, 1)


def batches(seed, n, rows, keys=40, late=0.2):
    """Records of mostly rising sequences; some are late, some repeat an earlier (key, sequence)."""
    rng, out, sent = random.Random(seed), [], []
    for b in range(n):
        batch = []
        for i in range(rows):
            at = T0 + timedelta(minutes=rng.randint(0, 60 * b) if rng.random() < late else 60 * b + i)
            key = None if rng.random() < 0.02 else 0 if rng.random() < 0.3 else rng.randint(1, keys)
            batch.append((key, "n", at, rng.choice("xy"), b * rows + i))
            if sent and rng.random() < 0.05:
                k, _, s, _, _ = rng.choice(sent)
                batch.append((k, "n", s, rng.choice("xy"), rng.randint(0, 10**6)))
        sent += batch
        out.append(batch)
    return out


def sink_of(tmp, **options):
    options = {"fan_in": 3, "rebuild_rows": 300, **options}
    return Scd2Sink(f"{tmp}/log", f"{tmp}/hist", ["k", "name"], "seq", track=["v"], buckets=8, **options)


def rows_of(df):
    return sorted(map(tuple, df.select("k", "name", "v", "note", "seq", "__START_AT", "__END_AT").collect()), key=repr)


def expected(spark, sent):
    return rows_of(scd2(spark.createDataFrame(sent, SCHEMA), ["k", "name"], "seq", track=["v"]))


def test_twenty_batches_equal_batch_scd2_with_bounded_work(spark, tmp):
    sink, sent, n, rows = sink_of(tmp), [], 20, 150
    for b, batch in enumerate(batches(1, n, rows)):
        sink(spark.createDataFrame(batch, SCHEMA), b)
        sent += batch
        if b in (2, 8):
            assert rows_of(sink.read(spark)) == expected(spark, sent), b
        if b in (5, 12):
            sink(spark.createDataFrame(batch, SCHEMA), b)  # replayed after its run was stored
    assert rows_of(sink.read(spark)) == expected(spark, sent)
    assert sink.records(spark).count() == len(sent)
    # Rewritten: each record once a level, and bases by doubling; a full rebuild per batch would read 10 times the records.
    levels = math.ceil(math.log(n, sink.fan_in))
    assert len(sink.work) == n and sum(sink.work) <= (levels + 3) * len(sent)
    assert sum(1 for w in sink.work if w == 0) >= n // 3
    assert len(sink.runs(spark)) <= levels * sink.fan_in


def test_no_base_one_base_and_a_base_up_to_date(spark, tmp):
    sent = [r for b in batches(2, 3, 60) for r in b]
    sink = sink_of(tmp, rebuild_rows=10**9)
    for i in range(3):
        sink(spark.createDataFrame(sent[i::3], SCHEMA), 10 * i)  # batch ids need not be dense
    want = expected(spark, sent)
    assert rows_of(sink.read(spark)) == want and list_names(spark, f"{tmp}/hist_bases") == []
    assert sink.rebuild(spark) and not sink.rebuild(spark)
    assert rows_of(sink.read(spark)) == want
    late = [(0, "n", T0 - timedelta(days=1), "z", -1), (99, "n", T0, "x", 1), (None, "n", T0 + timedelta(days=99), "x", 2)]
    sink(spark.createDataFrame(late, SCHEMA), 21)
    assert rows_of(sink.read(spark)) == expected(spark, sent + late)


def test_unmarked_run_is_replaced_and_vacuum_keeps_the_history(spark, tmp):
    sink, sent = sink_of(tmp), []
    for b, batch in enumerate(batches(3, 7, 120)):
        if b == 4:  # an attempt that died before its marker
            spark.createDataFrame([(1, "n", T0, "lost", 0, 0, 4)], SCHEMA + ", __bucket int, __batch long").write.parquet(f"{tmp}/log/{RUN}=0-4-4")
        sink(spark.createDataFrame(batch, SCHEMA), b)
        sent += batch
    want, before = expected(spark, sent), len(list_names(spark, f"{tmp}/log"))
    assert rows_of(sink.read(spark)) == want
    sink.vacuum(spark)
    assert rows_of(sink.read(spark)) == want
    assert len(list_names(spark, f"{tmp}/log")) == len(sink.runs(spark)) < before
    assert len(list_names(spark, f"{tmp}/hist_bases")) == 1


def test_null_sequences_are_rejected_and_counted(spark, tmp):
    sink = sink_of(tmp)
    first = [(1, "n", T0, "x", 1), (1, "n", None, "y", 2), (2, "n", None, "y", 3)]
    sink(spark.createDataFrame(first, SCHEMA), 0)
    sink(spark.createDataFrame([(3, "n", None, "x", 4)], SCHEMA), 1)
    sink(spark.createDataFrame([], SCHEMA), 2)
    rejected = sink.rejected(spark)
    assert sorted(map(tuple, rejected.select(BATCH, "k", "note").collect())) == [(0, 1, 2), (0, 2, 3), (1, 3, 4)]
    assert rejected.count() + sink.records(spark).count() == 4
    assert rows_of(sink.read(spark)) == expected(spark, first)


def test_history_without_any_record(spark, tmp):
    sink = sink_of(tmp)
    sink(spark.createDataFrame([(1, "n", None, "x", 1)], SCHEMA), 0)
    assert rows_of(sink.read(spark)) == [] and sink.rejected(spark).count() == 1
    assert sink.rebuild(spark) and rows_of(sink.read(spark)) == []


def test_batch_appends_only(spark, tmp):
    """A batch below the thresholds reads nothing stored: it works on a log that cannot be read."""
    sink = sink_of(tmp, fan_in=100, rebuild_rows=10**9)
    for b in range(3):
        sink(spark.createDataFrame([(b, "n", T0, "x", b)], SCHEMA), b)
        sink.records = None
    assert sink.work == [0, 0, 0]


def test_rows_of_the_base_that_a_batch_does_not_touch_are_not_rebuilt(spark, tmp):
    sent = [(k, "n", T0 + timedelta(hours=h), "xy"[h % 2], h) for k in range(200) for h in range(5)]
    sink = sink_of(tmp, rebuild_rows=500)
    sink(spark.createDataFrame(sent, SCHEMA), 0)
    more = [(7, "n", T0 + timedelta(hours=50), "x", 50)]
    sink(spark.createDataFrame(more, SCHEMA), 1)
    seen = []
    whole = sink._scd2
    sink._scd2 = lambda rows: seen.append(rows.count()) or whole(rows)
    assert rows_of(sink.read(spark)) == expected(spark, sent + more)
    assert seen == [3]  # the new record and the open version, at its start and at its end


@pytest.mark.parametrize("late", [0.0, 1.0])
def test_only_in_order_and_only_late(spark, tmp, late):
    sink, sent = sink_of(tmp, rebuild_rows=100), []
    for b, batch in enumerate(batches(4, 5, 80, late=late)):
        sink(spark.createDataFrame(batch, SCHEMA), b)
        sent += batch
    assert rows_of(sink.read(spark).withColumn("k", F.col("k"))) == expected(spark, sent)

"""Chunks of a heavy key hold equal counts however its records crowd in time."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeshift.operators.history import scd2

T0 = datetime(2024, 1, 1)


def _feed(spark, burst, spread, light):
    """Key 1: ``burst`` records within 1 % of a year, ``spread`` over all of it; ``light`` records of other keys."""
    year = 365 * 86_400
    at = F.lit(T0).cast("timestamp")
    seconds = F.when(F.col("id") < burst, year // 2 + F.col("id") * (year // 100) / burst).otherwise((F.col("id") - burst) * year / max(1, spread))
    heavy = spark.range(burst + spread).select(F.lit(1).cast("long").alias("k"), (at + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("seq"),
                                               (F.xxhash64("id") % 3 == 0).alias("v"))
    other = spark.range(light).select((F.col("id") % 50 + 2).alias("k"), (at + F.make_dt_interval(secs=F.col("id"))).alias("seq"), (F.col("id") % 2 == 0).alias("v"))
    return heavy.unionByName(other)


@pytest.mark.parametrize("burst,spread", [(9000, 90), (3000, 3000)])
def test_burst_is_cut_into_equal_chunks(spark, monkeypatch, burst, spread):
    feed = _feed(spark, burst, spread, 2000).cache()
    chunk_rows = 500
    plain = scd2(feed, "k", "seq", track=["v"], chunk_rows=10**9)
    frames = []
    checkpoint = type(feed).checkpoint
    monkeypatch.setattr(type(feed), "checkpoint", lambda self, eager=True: frames.append(out := checkpoint(self, eager)) or out)
    chunked = scd2(feed, "k", "seq", track=["v"], chunk_rows=chunk_rows)
    inner = next(f for f in frames if "__chunk" in f.columns)
    sizes = [r["count"] for r in inner.filter("k = 1").groupBy("__chunk").count().collect()]
    assert max(sizes) <= chunk_rows and sum(sizes) == feed.filter("k = 1").select("seq").distinct().count()
    assert len(sizes) <= (burst + spread) / chunk_rows + 8 + 1
    assert plain.count() == chunked.count()
    assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0


def test_small_feed_is_not_counted_by_key(spark):
    """Below ``chunk_rows`` the plan is one window by key; NULL keys are a group, heavy or not."""
    rows = [(None, T0 + timedelta(hours=i), i % 4 < 2) for i in range(300)] + [(1, T0 + timedelta(hours=i), True) for i in range(300)]
    feed = spark.createDataFrame(rows, "k long, seq timestamp, v boolean")
    plain, cut = scd2(feed, "k", "seq"), scd2(feed, "k", "seq", chunk_rows=50)
    want = sorted(map(tuple, plain.collect()), key=repr)
    assert len(want) == 151 and sorted(map(tuple, cut.collect()), key=repr) == want

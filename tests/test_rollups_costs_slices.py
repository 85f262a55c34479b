import json
import os
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeshift.operators.costs import cost_log, idle_alerts
from lakeshift.operators.rollups import top_k_per_group
from lakeshift.operators.slices import plan_slices
from lakeshift.schemas import CLUSTER_SAMPLE
from lakeshift.sources.sliced import Slice, http_fetch, plan


def _dense_top(rows, k):
    out = []
    for g in {r[0] for r in rows}:
        vals = sorted({r[1] for r in rows if r[0] == g and r[1] is not None}, reverse=True)[:k]
        nulls_in = len(vals) < k and any(r[1] is None for r in rows if r[0] == g)
        out += [r for r in rows if r[0] == g and ((r[1] is not None and r[1] >= vals[-1]) if vals else False)
                or (r[0] == g and r[1] is None and nulls_in)]
    return sorted(out, key=repr)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 4)), st.integers(-(2**62), 2**62)),
                min_size=1, max_size=30), st.integers(1, 3))
def test_top_k_ties_matches_dense_rank(spark, rows, k):
    df = spark.createDataFrame(rows, "g string, v int, id long")
    got = sorted((tuple(r) for r in top_k_per_group(df, "g", "v", k).collect()), key=repr)
    assert got == _dense_top(rows, k)


def test_top_k_exact(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 3, 2), ("a", 2, 3), ("b", 1, 4)], "g string, v int, id long")
    got = sorted(tuple(r) for r in top_k_per_group(df, "g", "v", 1, ties=False, tie_break=["id"]).collect())
    assert got == [("a", 3, 1), ("b", 1, 4)]


def test_cost_log_and_alerts(spark):
    t = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame(
        [("r1", t, "c1", "RUNNING", 2, 0), ("r1", t, "c2", "RESIZING", None, 5), ("r1", t, "c3", None, 1, 0),
         ("r1", t, "c4", "TERMINATED", 4, 0)],
        CLUSTER_SAMPLE,
    )
    log = {r.cluster_id: r for r in cost_log(df).collect()}
    assert (log["c1"].dbu_estimate, log["c1"].idle) == (4.0, True)
    assert (log["c2"].dbu_estimate, log["c2"].idle) == (2.0, False)
    assert (log["c3"].cluster_state, log["c3"].dbu_estimate, log["c3"].idle) == ("UNKNOWN", 0.0, False)
    assert log["c1"].run_timestamp == "2024-01-01T12:00:00"
    alerts = idle_alerts(cost_log(df)).collect()
    assert [a.cluster_id for a in alerts] == ["c1"] and "c1" in alerts[0].message


def test_plan_slices_batch(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 3, 30)), (2, datetime(2024, 1, 1, 0), datetime(2024, 1, 1, 0, 30))],
        "loc int, start timestamp, end timestamp",
    )
    got = plan_slices(df).select("loc", F.hour("slice_start").alias("h")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0), (1, 1), (1, 2)]


def test_plan_source_slices_disjoint_and_covering():
    locs = [{"name": "A", "latitude": 1.0, "longitude": 2.0}, {"name": "B", "latitude": 3.0, "longitude": 4.0}]
    start = {"A": "2024-01-01T00:00:00"}
    end = {"A": "2024-01-01T10:00:00", "B": "2024-01-01T10:00:00"}
    parts = plan(locs, start, end, initial="2024-01-01T05:00:00", hours_per_slice=3)
    a = [(p.start, p.end) for p in parts if p.name == "A"]
    assert a[0][0] == "2024-01-01T00:00:00" and a[-1][1] == "2024-01-01T10:00:00"
    assert all(x[1] == y[0] for x, y in zip(a, a[1:]))
    b = [(p.start, p.end) for p in parts if p.name == "B"]  # new location starts at the initial offset
    assert b[0][0] == "2024-01-01T05:00:00" and len(b) == 2


def test_fetch_failure_raises_after_retries():
    part = Slice("A", 1.0, 2.0, "2024-01-01T00:00:00", "2024-01-01T01:00:00")
    with pytest.raises(OSError):
        http_fetch({"url": "http://127.0.0.1:9/none"}, part, max_retries=1, backoff=0.01, timeout=1)


def test_sliced_source_stream(spark, tmp):
    from lakeshift.plans.sliced_ingest import run_sliced_ingest

    folder = os.path.join(tmp, "responses", "location_name=A")
    os.makedirs(folder)
    body = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"],
                       "temperature_2m": [1.0, None, 3.0]},
            "hourly_units": {"temperature_2m": "C"}, "latitude": 1.0, "longitude": 2.0, "utc_offset_seconds": 0}
    with open(os.path.join(folder, "part-0.txt"), "w") as fh:
        fh.write(json.dumps(body) + "\n")
    locs = [{"name": "A", "latitude": 1.0, "longitude": 2.0}]
    table = run_sliced_ingest(spark, locs, {"url": "", "source": "t"}, f"{tmp}/table", f"{tmp}/ckpt",
                              start="2024-01-01T00:00:00", end="2024-01-01T02:00:00", fetcher="files",
                              root=os.path.join(tmp, "responses"))
    rows = sorted(table.select(F.hour("time").alias("h"), "temperature", "location_name").collect())
    assert [tuple(r) for r in rows] == [(0, 1.0, "A"), (1, None, "A")]  # [start, end): hour 2 not yet complete
    # restart with the same checkpoint and end: nothing new
    table2 = run_sliced_ingest(spark, locs, {"url": "", "source": "t"}, f"{tmp}/table", f"{tmp}/ckpt",
                               start="2024-01-01T00:00:00", end="2024-01-01T02:00:00", fetcher="files",
                               root=os.path.join(tmp, "responses"))
    assert table2.count() == 2


def test_latest_offset_is_floored_to_complete_hours():
    from datetime import datetime, timedelta, timezone

    from lakeshift.sources.sliced import SlicedStreamReader

    now = datetime.now(timezone.utc).replace(tzinfo=None)
    start = (now - timedelta(hours=3)).replace(minute=0, second=0, microsecond=0)
    reader = SlicedStreamReader({"locations": json.dumps([{"name": "A", "latitude": 1.0, "longitude": 2.0}]),
                                 "start": start.isoformat()})
    latest = reader.latestOffset()
    end = datetime.fromisoformat(latest["A"])
    assert end == end.replace(minute=0, second=0, microsecond=0) and end >= now - timedelta(hours=1)
    parts = reader.partitions(reader.initialOffset(), latest)
    # whole hours from start to the last complete hour; the current hour is never planned
    assert len(parts) == int((end - start).total_seconds() // 3600) in (3, 4)
    assert datetime.fromisoformat(parts[-1].end) == end <= datetime.now(timezone.utc).replace(tzinfo=None)


def test_api_rows_use_the_response_offset_and_slice_bounds():
    from datetime import datetime, timezone

    from lakeshift.sources.sliced import Slice, rows_of

    body = {"hourly": {"time": ["2024-01-01T09:00", "2024-01-01T10:00", "2024-01-01T11:00"],
                       "temperature_2m": [1.0, 2.0]},
            "hourly_units": {"temperature_2m": "C"}, "utc_offset_seconds": -18000, "timezone": "America/New_York"}
    part = Slice("A", 1.0, 2.0, "2024-01-01T10:00:00", "2024-01-01T12:00:00")
    rows = list(rows_of(body, part, "src"))
    # 09:00 is outside the slice; 11:00 has no value (shorter array -> NULL); local -05:00 -> UTC +5h
    assert [(r[1], r[2]) for r in rows] == [(datetime(2024, 1, 1, 15, tzinfo=timezone.utc), 2.0),
                                          (datetime(2024, 1, 1, 16, tzinfo=timezone.utc), None)]
    assert rows[0][0] == "src" and rows[0][4] == "A" and rows[0][10] == "America/New_York"

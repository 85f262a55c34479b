"""Bounded catch-up of the sliced source: plans of ranges, offsets that advance by parts, responses read by Spark."""

import json
import tracemalloc
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeshift.plans import fixtures as fx
from lakeshift.plans.sliced_ingest import run_sliced_ingest
from lakeshift.sources.files import list_names
from lakeshift.sources.sliced import SlicedStreamReader, SliceRange, advanced, committed_offset, plan, plan_ranges

from conftest import SF001

T0 = datetime(2024, 1, 1)


def locations(n):
    return [{"name": f"L{i}", "latitude": float(i % 90), "longitude": float(i % 180)} for i in range(n)]


def hours(n):
    return (T0 + timedelta(hours=n)).isoformat()


@pytest.mark.parametrize("step,per,most", [(1, 1, 0), (3, 1, 0), (5, 4, 0), (1, 1000, 0), (2, 1, 7), (24, 1, 3), (1, 7, 2)])
def test_ranges_hold_every_slice_once(step, per, most):
    locs = locations(11)
    start = {f"L{i}": hours(i % 3) for i in range(9)}  # two locations start at the initial offset
    end = {loc["name"]: hours(40) for loc in locs} | {"L3": hours(0), "L4": hours(5)}
    ranges = plan_ranges(locs, start, end, hours(7), step, per, most)
    slices = [s for r in ranges for s in r.slices()]
    got = {}
    for s in slices:
        got.setdefault(s.name, []).append((datetime.fromisoformat(s.start), datetime.fromisoformat(s.end)))
    for loc in locs:
        lo = datetime.fromisoformat(start.get(loc["name"], hours(7)))
        hi = datetime.fromisoformat(end[loc["name"]])
        own = sorted(got.get(loc["name"], []))
        assert [a for a, _ in own] == [lo + timedelta(hours=step) * i for i in range(len(own))]
        assert (own[-1][1] == hi and all(b - a <= timedelta(hours=step) for a, b in own)) if lo < hi else not own
    assert sorted((s.name, s.start) for s in slices) == sorted((s.name, s.start) for s in plan(locs, start, end, hours(7), step))
    if per > 1 and not most:
        assert len(ranges) <= len(slices) // per + 2 * len(locs)


def test_a_year_of_many_locations_is_planned_in_little_memory():
    locs = locations(100_000)
    options = {"locations": json.dumps(locs), "start": hours(0), "end": hours(24 * 365), "max_partitions": "200"}
    reader = SlicedStreamReader({**options, "max_slices_per_trigger": "2000000000"})  # 876 million slices at once
    start, end = reader.initialOffset(), reader.latestOffset()
    assert set(end.values()) == {hours(24 * 365)}
    tracemalloc.start()
    parts = reader.partitions(start, end)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 100 <= len(parts) <= 200 and peak < 64 << 20
    assert sum(len(p.locations) for p in parts) == len(locs) and len(list(SliceRange(parts[0].locations[:1], parts[0].start, parts[0].end, 1).slices())) == 8760


def test_offsets_advance_by_the_limit_and_those_behind_first():
    reader = SlicedStreamReader({"locations": json.dumps(locations(4)), "start": hours(0), "end": hours(10), "max_slices_per_trigger": "8"})
    offsets, at = [], reader.initialOffset()
    while (end := reader.latestOffset()) != at:
        assert reader.latestOffset() == end  # asked again before the batch is planned
        assert 0 < sum(len(list(p.slices())) for p in reader.partitions(at, end)) <= 8
        offsets.append(end)
        at = end
    assert [set(o.values()) for o in offsets] == [{hours(h)} for h in (2, 4, 6, 8, 10)]
    late = {"A": hours(9), "B": hours(1), "C": hours(0)}
    assert advanced(late, hours(10), 1, 2) == {"A": hours(9), "B": hours(2), "C": hours(1)}
    assert advanced(late, hours(10), 4, 30) == {"A": hours(10), "B": hours(10), "C": hours(10)}
    assert advanced(late, hours(0), 1, 5) == late and advanced({}, hours(3), 1, 5) == {}


def test_restarted_reader_goes_on_from_its_position():
    options = {"locations": json.dumps(locations(3)), "start": hours(0), "end": hours(10), "max_slices_per_trigger": "6"}
    reader = SlicedStreamReader({**options, "position": json.dumps({"L0": hours(4), "L1": hours(4), "gone": hours(9)})})
    assert reader.latestOffset() == {"L0": hours(6), "L1": hours(6), "L2": hours(2)}


def _ingest(spark, tmp, name, responses, **options):
    events = fx.table(spark, SF001, "events")
    locs = [r.asDict() for r in fx.fixture_locations(events).collect()]
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    end = (hi.replace(minute=0, second=0, microsecond=0) + timedelta(hours=1)).isoformat()
    table = run_sliced_ingest(
        spark, locs, {"url": "", "source": "t"}, f"{tmp}/{name}", f"{tmp}/{name}_ck", start=lo.isoformat(), end=end,
        hours_per_slice=24, **({"responses": responses} if "fetcher" not in options else {"root": responses}), **options,
    )
    return table, locs


def test_rounds_and_readers_give_the_same_rows(spark, tmp):
    events = fx.table(spark, SF001, "events")
    fx.write_api_responses(events, f"{tmp}/responses")
    by_source, locs = _ingest(spark, tmp, "a", f"{tmp}/responses", fetcher="files")
    in_rounds, _ = _ingest(spark, tmp, "b", f"{tmp}/responses", max_slices_per_trigger=300)
    want = fx.hourly_readings(events)
    assert in_rounds.count() == by_source.count() == want.count()
    assert in_rounds.select(by_source.columns).exceptAll(by_source).count() == 0
    batches = list_names(spark, f"{tmp}/b_ck/commits")
    assert len([b for b in batches if b.isdigit()]) == -(-31 // (300 // len(locs)))
    assert len(set(committed_offset(spark, f"{tmp}/b_ck").values())) == 1
    again, _ = _ingest(spark, tmp, "b", f"{tmp}/responses", max_slices_per_trigger=300)
    assert again.count() == want.count()


def test_responses_on_a_file_system_that_only_spark_opens(spark, tmp):
    fx.write_api_responses(fx.table(spark, SF001, "events"), f"{tmp}/responses")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.sliced.link./drop", f"file://{tmp}/responses")
    table, _ = _ingest(spark, tmp, "c", "viewfs://sliced/drop")
    assert table.count() == fx.hourly_readings(fx.table(spark, SF001, "events")).count()


def test_local_hours_and_missing_folders(spark, tmp):
    body = {"hourly": {"time": ["2024-01-01T09:00", "2024-01-01T10:00", "2024-01-01T11:00", "bad"], "temperature_2m": [1.0, 2.0]},
            "hourly_units": {"temperature_2m": "C"}, "latitude": 1.5, "longitude": 2.5, "utc_offset_seconds": -18000}
    spark.createDataFrame([("A b", json.dumps(body)), ("A b", " ")], "location_name string, value string").write.partitionBy("location_name").text(f"{tmp}/r")
    locs = [{"name": "A b", "latitude": 1.0, "longitude": 2.0}]
    run = lambda ls, t: run_sliced_ingest(
        spark, ls, {"source": "s"}, f"{tmp}/{t}", f"{tmp}/{t}_ck", start=hours(10), end=hours(12), responses=f"{tmp}/r"
    )
    got = run(locs, "t").select(F.unix_timestamp("time"), "temperature", "source", "location_name", "latitude").collect()
    at = int((T0 + timedelta(hours=15) - datetime(1970, 1, 1)).total_seconds())
    # 10:00 and 11:00 of a place five hours behind; the value of 11:00 is missing
    assert sorted(map(tuple, got)) == [(at, 2.0, "s", "A b", 1.5), (at + 3600, None, "s", "A b", 1.5)]
    with pytest.raises(FileNotFoundError, match="nowhere"):
        run([*locs, {"name": "nowhere", "latitude": 0.0, "longitude": 0.0}], "u")

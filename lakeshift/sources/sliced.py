"""Sliced API stream source (Python data source API).

Offsets are ``{location name: ISO hour}``.  A slice is one location and
``hours_per_slice`` whole hours.  Each trigger plans the slices between the
committed and the latest offset as *ranges* (some locations x a span of hours),
which ``read`` expands on an executor: the driver holds as many objects as there
are partitions, not slices.  The latest offset is at most
``max_slices_per_trigger`` slices ahead of the position, so a long catch-up
commits many offsets on its way; the locations furthest behind go first.

Options (all strings):

* ``locations`` — JSON list of ``{"name", "latitude", "longitude"}``;
* ``endpoint`` — JSON ``{"url", "source"}``;
* ``start`` — ISO time of the initial offset (default: now - 7 days), floored
  to the hour; a location added later starts there too;
* ``end`` — optional fixed ISO end (bounded back-fill); default: the clock,
  floored to the hour, so only complete hours are planned and none is skipped;
* ``hours_per_slice`` — hours per slice / API call (default 1);
* ``slices_per_partition`` — slices fetched by one task (default 1: one call
  per task); larger values amortise task start-up when calls are small and
  locations many;
* ``max_partitions`` — cap on input partitions per trigger (0 = none); slices
  are then spread evenly over about that many tasks;
* ``max_slices_per_trigger`` — how far an offset may advance (default 100,000
  slices over all locations);
* ``position`` — JSON of the offset a checkpoint holds (``committed_offset``): a
  restarted reader advances from there, as Spark does not tell it where it was;
* ``max_retries`` / ``backoff_sec`` — HTTP retries with exponential back-off;
  a slice that still fails fails the task (and the batch), never skipped;
* ``fetcher`` = ``http`` (default) or ``files`` with ``root``: responses stored
  as JSON lines under ``<root>/location_name=<name>/`` (a shared POSIX path);
  ``none``: the rows are the planned ranges themselves (``RANGE_ROW``), for flows
  that let Spark read the responses (``plans.sliced_ingest``).
"""

from __future__ import annotations

import glob
import json
import math
import os
import time
import urllib.request
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lakeshift.schemas import API_SLICE_ROW

SOURCE_NAME = "sliced_api"
HOUR = timedelta(hours=1)
MAX_SLICES_PER_TRIGGER = 100_000
RANGE_ROW = "location_name string, latitude double, longitude double, range_start timestamp_ntz, range_end timestamp_ntz"


def floor_hour(ts: datetime) -> datetime:
    return ts.replace(minute=0, second=0, microsecond=0)


def _parse(ts: str) -> datetime:
    return datetime.fromisoformat(ts).replace(tzinfo=None)


class Slice(InputPartition):
    def __init__(self, name: str, lat: float, lon: float, start: str, end: str):
        self.name, self.lat, self.lon, self.start, self.end = name, lat, lon, start, end


class SliceRange(InputPartition):
    """Slices of some locations and a span of hours, read by one task."""

    def __init__(self, locations: Sequence[tuple[str, float, float]], start: str, end: str, hours: int):
        self.locations, self.start, self.end, self.hours = locations, start, end, hours

    def slices(self) -> Iterator[Slice]:
        step, end = HOUR * self.hours, _parse(self.end)
        for name, lat, lon in self.locations:
            lo = _parse(self.start)
            while lo < end:
                hi = min(lo + step, end)
                yield Slice(name, lat, lon, lo.isoformat(), hi.isoformat())
                lo = hi


def plan_ranges(
    locations: list[dict], start: dict, end: dict, initial: str, hours_per_slice: int = 1, per_partition: int = 1, max_partitions: int = 0
) -> list[SliceRange]:
    """Ranges of about ``per_partition`` slices (more, where ``max_partitions`` asks for it) covering ``[start, end)``
    per location, disjoint: locations with the same span share ranges, or a location's span is cut."""
    hours = max(1, int(hours_per_slice))
    spans: dict[tuple[datetime, datetime], list[tuple[str, float, float]]] = {}
    for loc in locations:
        name = loc["name"]
        lo, hi = floor_hour(_parse(start.get(name) or initial)), floor_hour(_parse(end.get(name) or initial))
        if lo < hi:
            spans.setdefault((lo, hi), []).append((name, loc["latitude"], loc["longitude"]))
    count = {span: math.ceil((span[1] - span[0]) / (HOUR * hours)) for span in spans}
    per = max(1, per_partition)
    if max_partitions > 0:
        per = max(per, math.ceil(sum(count[s] * len(locs) for s, locs in spans.items()) / max_partitions))
    out = []
    for (lo, hi), locs in spans.items():
        together = max(1, per // count[lo, hi])
        step = HOUR * hours * max(1, per if together == 1 else count[lo, hi])
        for a in range(0, len(locs), together):
            at = lo
            while at < hi:
                out.append(SliceRange(locs[a : a + together], at.isoformat(), min(at + step, hi).isoformat(), hours))
                at += step
    return out


def plan(locations: list[dict], start: dict, end: dict, initial: str, hours_per_slice: int = 1) -> list[Slice]:
    """Slices of whole hours covering ``[start, end)`` per location, disjoint."""
    return [s for r in plan_ranges(locations, start, end, initial, hours_per_slice) for s in r.slices()]


def advanced(position: dict, target: str, hours_per_slice: int, most: int) -> dict:
    """``position`` moved towards ``target`` by at most ``most`` slices over all locations, those furthest behind first."""
    step, goal = HOUR * max(1, hours_per_slice), _parse(target)
    behind = sorted((at, name) for name, at in position.items() if _parse(at) < goal)
    slices_each = max(1, most // len(behind)) if behind else 0
    moved = {name: min(_parse(at) + step * slices_each, goal).isoformat() for at, name in behind[: max(1, most)]}
    return {**position, **moved}


# ------------------------------------------------------------------ fetchers (run on executors)
def http_fetch(endpoint: dict, part: Slice, max_retries: int, backoff: float, timeout: float = 30.0) -> list[dict]:
    first = _parse(part.start).strftime("%Y-%m-%dT%H:00")
    last = (_parse(part.end) - HOUR).strftime("%Y-%m-%dT%H:00")
    url = (
        f"{endpoint['url']}?latitude={part.lat}&longitude={part.lon}"
        f"&start_hour={first}&end_hour={last}&hourly=temperature_2m"
    )
    for attempt in range(max_retries + 1):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as resp:
                if resp.status != 200:
                    raise OSError(f"HTTP {resp.status} for {url}")
                return [json.loads(resp.read().decode("utf-8"))]
        except OSError:
            if attempt == max_retries:
                raise
            time.sleep(backoff * (2**attempt))
    return []


def file_fetch(root: str, part: Slice) -> list[dict]:
    if "://" in root.removeprefix("file://"):
        raise ValueError(f"the files fetcher reads shared POSIX folders, not {root}")
    folder = os.path.join(root.removeprefix("file://").removeprefix("file:"), f"location_name={part.name}")
    if not os.path.isdir(folder):
        # An empty answer would commit the offset and lose the slice for good.
        raise FileNotFoundError(f"no folder of responses for location {part.name}: {folder}")
    bodies = []
    for path in sorted(glob.glob(os.path.join(folder, "*"))):
        if os.path.basename(path).startswith((".", "_")):
            continue
        with open(path, encoding="utf-8") as fh:
            bodies.extend(json.loads(line) for line in fh if line.strip())
    return bodies


def rows_of(body: dict, part: Slice, source: str) -> Iterator[tuple]:
    """Elements of one response inside the slice, as schema-ordered tuples."""
    lo, hi = _parse(part.start), _parse(part.end)
    hourly = body.get("hourly") or {}
    times = hourly.get("time") or []
    values = hourly.get("temperature_2m") or []
    offset = timedelta(seconds=body.get("utc_offset_seconds") or 0)
    unit = (body.get("hourly_units") or {}).get("temperature_2m")
    for i, t in enumerate(times):
        local = _parse(t)
        if not lo <= local < hi:
            continue
        yield (
            source,
            (local - offset).replace(tzinfo=timezone.utc),
            values[i] if i < len(values) else None,
            unit,
            part.name,
            body.get("latitude"),
            body.get("longitude"),
            body.get("elevation"),
            body.get("generationtime_ms"),
            body.get("utc_offset_seconds"),
            body.get("timezone"),
            body.get("timezone_abbreviation"),
        )


class _Options:
    def __init__(self, options: dict):
        o = dict(options or {})
        self.locations = json.loads(o.get("locations", "[]"))
        self.endpoint = json.loads(o.get("endpoint", "{}"))
        default_start = floor_hour(datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(days=7))
        self.initial = floor_hour(_parse(o.get("start") or default_start.isoformat())).isoformat()
        self.fixed_end = o.get("end")
        self.hours_per_slice = int(o.get("hours_per_slice", 1))
        self.slices_per_partition = int(o.get("slices_per_partition", 1))
        self.max_partitions = int(o.get("max_partitions", 0))
        self.max_slices = int(o.get("max_slices_per_trigger", MAX_SLICES_PER_TRIGGER))
        self.position = json.loads(o.get("position") or "{}")
        self.max_retries = int(o.get("max_retries", 3))
        self.backoff = float(o.get("backoff_sec", 1.0))
        self.fetcher = o.get("fetcher", "http")
        self.root = o.get("root", "")

    def end_offset(self) -> str:
        if self.fixed_end:
            return floor_hour(_parse(self.fixed_end)).isoformat()
        return floor_hour(datetime.now(timezone.utc).replace(tzinfo=None)).isoformat()

    def plan(self, start: dict, end: dict) -> list[InputPartition]:
        return plan_ranges(
            self.locations, start, end, self.initial, self.hours_per_slice, self.slices_per_partition, self.max_partitions
        )

    def read(self, part: SliceRange) -> Iterator[tuple]:
        if self.fetcher == "none":
            for name, lat, lon in part.locations:
                yield name, lat, lon, _parse(part.start), _parse(part.end)
            return
        source = self.endpoint.get("source", "")
        cache: dict[str, list[dict]] = {}
        for one in part.slices():
            if self.fetcher == "files":
                if one.name not in cache:  # a task reads a location's stored responses once
                    cache = {one.name: file_fetch(self.root, one)}
                bodies = cache[one.name]
            else:
                bodies = http_fetch(self.endpoint, one, self.max_retries, self.backoff)
            for body in bodies:
                yield from rows_of(body, one, source)


class SlicedStreamReader(DataSourceStreamReader):
    """Plans from the position: the offset planned last, at first that of the options or the initial one."""

    def __init__(self, options: dict):
        self.o = _Options(options)
        self.position = self.o.position

    def initialOffset(self) -> dict:
        return {loc["name"]: self.o.initial for loc in self.o.locations}

    def latestOffset(self) -> dict:
        known = self.initialOffset()
        known.update({name: at for name, at in self.position.items() if name in known})
        return advanced(known, self.o.end_offset(), self.o.hours_per_slice, self.o.max_slices)

    def partitions(self, start: dict, end: dict):
        self.position = end or {}
        return self.o.plan(start or {}, end or {})

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.o.read(partition)

    def commit(self, end: dict) -> None:
        return None


class SlicedBatchReader(DataSourceReader):
    """Batch read of ``[start, end)`` with the same slicing."""

    def __init__(self, options: dict):
        self.o = _Options(options)

    def partitions(self):
        return self.o.plan({}, {loc["name"]: self.o.end_offset() for loc in self.o.locations})

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return self.o.read(partition)


class SlicedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self):
        return RANGE_ROW if (self.options or {}).get("fetcher") == "none" else API_SLICE_ROW

    def streamReader(self, schema):
        return SlicedStreamReader(self.options)

    def reader(self, schema):
        return SlicedBatchReader(self.options)


def committed_offset(spark, checkpoint: str) -> dict:
    """The newest offset in a stream's checkpoint (planned, if its batch did not end); {} without one."""
    from lakeshift.sources.files import list_names

    batches = [int(name) for name in list_names(spark, f"{checkpoint}/offsets") if name.isdigit()]
    if not batches:
        return {}
    # The file's last line is the source's own offset, as JSON.
    text = spark.read.text(f"{checkpoint}/offsets/{max(batches)}", wholetext=True).first()[0]
    return json.loads(text.strip().splitlines()[-1])


def register(spark) -> str:
    """Register the source under ``sliced_api``.

    The source is planned in a driver-side Python process and read in executor
    workers; its classes are serialised by value so neither needs ``lakeshift``
    installed."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SlicedSource)
    return SOURCE_NAME

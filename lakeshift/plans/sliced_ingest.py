"""Sliced API ingest: custom stream source -> parquet table partitioned by
location."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators.slices import explode_hourly
from lakeshift.schemas import API_SLICE_ROW
from lakeshift.sinks import append_stream
from lakeshift.sources.files import list_names, read_stored
from lakeshift.sources.sliced import committed_offset, floor_hour, register
from lakeshift.streaming.streams import run_to_completion


def sliced_stream(spark: SparkSession, locations: Sequence[dict], endpoint: dict, **options) -> DataFrame:
    name = register(spark)
    reader = spark.readStream.format(name).option("locations", json.dumps(list(locations))).option(
        "endpoint", json.dumps(endpoint)
    )
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader.load()


def stored_responses(spark: SparkSession, ranges: DataFrame, responses: str, source: str) -> DataFrame:
    """The API rows of ``ranges`` (``RANGE_ROW``, batch or stream) out of the responses stored under ``responses``.

    The responses (JSON lines under ``location_name=<name>/``) are read by Spark,
    so they may lie on any file system of the cluster.  An element belongs to the
    range that holds its local hour.  The ranges of a trigger are broadcast: at
    most ``max_slices_per_trigger``.
    """
    bodies = spark.read.schema("value string, location_name string").text(responses)
    hours = explode_hourly(bodies.filter(F.trim("value") != ""), "value", keep=("location_name",), local_time=True)
    wanted = F.broadcast(ranges.select("location_name", "range_start", "range_end"))
    found = hours.join(wanted, "location_name").filter("time >= range_start AND time < range_end")
    since_epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', time)")
    instant = F.timestamp_seconds(since_epoch - F.coalesce("utc_offset_seconds", F.lit(0)))
    return found.withColumns({"source": F.lit(source), "time": instant}).select(API_SLICE_ROW.names)


def _refuse_missing(spark: SparkSession, locations: Sequence[dict], responses: str) -> None:
    """An empty answer would commit the offset and lose the slices for good."""
    there = {unquote(name).removeprefix("location_name=") for name in list_names(spark, responses)}
    missing = [loc["name"] for loc in locations if loc["name"] not in there]
    if missing:
        raise FileNotFoundError(f"no folder of responses for {len(missing)} locations, e.g. {missing[0]}: {responses}")


def run_sliced_ingest(
    spark: SparkSession,
    locations: Sequence[dict],
    endpoint: dict,
    table: str,
    checkpoint: str,
    partition_by: Sequence[str] = ("latitude", "longitude"),
    responses: str | None = None,
    **options,
) -> DataFrame:
    """Fetch every complete slice since the last offset, append, stop.

    A run goes on in rounds of at most ``max_slices_per_trigger`` slices until it
    has reached the hour it started in (or ``end``); every round commits its
    offset, so a run that dies goes on where it was.  ``responses`` names a folder
    of stored responses that Spark reads instead of the source's own fetchers.

    Stored partitioned by ``partition_by`` (by coordinates by default, as the
    flow's table is; pass ``("location_name",)`` or a date column where that
    prunes better)."""
    # At most ~2 tasks per core per trigger unless the caller decides otherwise.
    options.setdefault("max_partitions", 2 * spark.sparkContext.defaultParallelism)
    if not options.get("end"):
        options["end"] = floor_hour(datetime.now(timezone.utc).replace(tzinfo=None)).isoformat()
    target = floor_hour(datetime.fromisoformat(options["end"]).replace(tzinfo=None))
    if responses is not None:
        options["fetcher"] = "none"
        _refuse_missing(spark, locations, responses)
    position = committed_offset(spark, checkpoint)
    while True:
        stream = sliced_stream(spark, locations, endpoint, **{**options, "position": json.dumps(position)})
        if responses is not None:
            stream = stored_responses(spark, stream, responses, endpoint.get("source", ""))
        run_to_completion(append_stream(stream, table, checkpoint, partition_by=list(partition_by)))
        before, position = position, committed_offset(spark, checkpoint)
        done = all(datetime.fromisoformat(position[loc["name"]]) >= target for loc in locations if loc["name"] in position)
        if done or position == before:
            return read_stored(spark, table)

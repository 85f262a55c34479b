"""Batch side of the sliced API source: slice planning and the explode of
API responses (parallel arrays) into one row per element."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.schemas import API_RESPONSE


def plan_slices(
    ranges: DataFrame,
    start_col: str = "start",
    end_col: str = "end",
    step: str = "1 hour",
) -> DataFrame:
    """One row per *complete* ``step`` slice of ``[start, end)`` per input row.

    Adds ``slice_start`` / ``slice_end``; a range shorter than one step yields no
    row (``sequence`` raises on an empty range, hence the guard).  Narrow: the
    slices of a row are generated in the task holding the row.
    """
    st = F.expr(f"INTERVAL {step}")
    start, end = F.col(start_col), F.col(end_col)
    starts = F.when(start + st <= end, F.sequence(start, end - st, st))
    return (
        ranges.select("*", F.explode(starts).alias("slice_start"))
        .withColumn("slice_end", F.col("slice_start") + st)
    )


def explode_hourly(
    responses: DataFrame, body_col: str = "body", keep: tuple[str, ...] = (), local_time: bool = False
) -> DataFrame:
    """API JSON text -> one row per hourly element.

    The body holds ``hourly.time`` / ``hourly.temperature_2m`` as parallel arrays
    and scalars (unit, coordinates, elevation, zone) that apply to every element.
    ``arrays_zip`` + ``inline`` keep NULL elements and pad the shorter array.
    ``keep`` columns of the input are carried.  ``local_time`` leaves ``time`` the
    response's wall clock (``timestamp_ntz``), else it is read in the session zone.
    """
    parsed = responses.select(*keep, F.from_json(F.col(body_col), API_RESPONSE).alias("__b"))
    b = F.col("__b")
    zipped = F.arrays_zip(b["hourly"]["time"].alias("t"), b["hourly"]["temperature_2m"].alias("v"))
    return parsed.select(
        *keep,
        F.inline(zipped),
        b["hourly_units"]["temperature_2m"].alias("unit"),
        b["latitude"].alias("latitude"),
        b["longitude"].alias("longitude"),
        b["elevation"].alias("elevation"),
        b["generationtime_ms"].alias("generationtime_ms"),
        b["utc_offset_seconds"].alias("utc_offset_seconds"),
        b["timezone"].alias("timezone"),
        b["timezone_abbreviation"].alias("timezone_abbreviation"),
    ).select(
        *keep,
        (F.col("t").try_cast("timestamp_ntz") if local_time else F.try_to_timestamp(F.col("t"))).alias("time"),
        F.col("v").alias("temperature"),
        "unit",
        "latitude",
        "longitude",
        "elevation",
        "generationtime_ms",
        "utc_offset_seconds",
        "timezone",
        "timezone_abbreviation",
    )

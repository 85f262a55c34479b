"""Timestamp parsing and truncation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """Text -> timestamp, NULL for text that does not parse.

    ``try_to_timestamp`` rather than ``to_timestamp``: under ANSI mode the latter
    raises on bad input, while the flows want such rows to become NULL so the
    time expectation can remove them.
    """
    c = F.col(c) if isinstance(c, str) else c
    if fmt is None:
        return F.try_to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt))


def truncate_time(c: Column | str, unit: str = "hour") -> Column:
    """Truncate to ``unit`` (hour, day, week, ...); returns ``timestamp``."""
    return F.date_trunc(unit, F.col(c) if isinstance(c, str) else c)


def as_naive_timestamps(df: DataFrame) -> DataFrame:
    """Cast every top-level ``timestamp`` column to ``timestamp_ntz``.

    Used at query boundaries so values line up with engines whose timestamps are
    zone-free; the session zone is UTC so the wall clock does not move.
    """
    cols = [
        F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
        if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def timestamp_literal(ts: datetime) -> Column:
    """A ``timestamp`` literal: a zone-aware value is that instant; a naive value
    is a wall-clock time in the session time zone (not the Python process's)."""
    if ts.tzinfo is not None:
        return F.lit(ts).cast("timestamp")
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp")

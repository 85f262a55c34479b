"""Data-exception flow as one stream:

raw customer feed (stored, append-only) -> watermark -> identifier
normalisation -> rule checks -> per micro-batch fan-out to
  * the checked table,
  * the exception queue (invalid rows stamped PENDING) and its SCD2 history,
  * the validated table and its SCD2 history.
The current open exceptions are ``latest`` of the exception history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions.timecols import timestamp_literal
from lakeshift.operators.history import latest
from lakeshift.operators.rules import SSN_RULES, apply_checks, get_invalid, get_valid, normalize_identifier, to_exceptions
from lakeshift.sources.files import read_stored_stream
from lakeshift.streaming.scd2_sink import Scd2Sink, batch_partitioned_append
from lakeshift.streaming.streams import DEFAULT_WATERMARK, fan_out, run_to_completion, with_event_watermark

# ---- fixed values: columns whose change opens a new customer version ----------
TRACKED_CUSTOMER_COLUMNS = ["customer_name", "ssn", "account_balance", "source_system", "ssn_norm"]
# --------------------------------------------------------------------------------

# Processing time of a row's micro-batch, until the handlers use it.
STAMP = "__stamp"


@dataclass
class ExceptionPaths:
    raw: str
    checkpoint: str
    checked: str
    exceptions: str
    exceptions_log: str
    exceptions_history: str
    valid: str
    valid_log: str
    valid_history: str


def append_customer_records(
    df: DataFrame, target: str, source_system: str = "seed", as_of: datetime | None = None
) -> None:
    """Append customer records to the raw append-only table (created when
    missing): each gets a fresh ``record_id`` (uuid), ``source_system`` and
    ``event_ts`` (``as_of`` or now).  Re-running appends the same customers again
    with new ids and times; no tracked column changes, so no new SCD2 version."""
    from lakeshift.sinks import append_batch

    ts = timestamp_literal(as_of) if as_of is not None else F.current_timestamp()
    rows = df.withColumns({"record_id": F.expr("uuid()"), "source_system": F.lit(source_system), "event_ts": ts})
    append_batch(rows, target)


def checked_stream(
    spark: SparkSession,
    raw: str,
    rules: Sequence[Mapping] = SSN_RULES,
    watermark: str = DEFAULT_WATERMARK,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    stream = with_event_watermark(read_stored_stream(spark, raw, max_files_per_trigger=max_files_per_trigger), "event_ts", watermark)
    return apply_checks(normalize_identifier(stream, "ssn", "ssn_norm"), rules)


def run_exception_workflow(
    spark: SparkSession,
    paths: ExceptionPaths,
    rules: Sequence[Mapping] = SSN_RULES,
    watermark: str = DEFAULT_WATERMARK,
    as_of: datetime | None = None,
    buckets: int = 16,
    max_files_per_trigger: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run the stream to completion; return (exception history, valid history).

    Each micro-batch is persisted once and fed to five handlers; on a large
    backlog cap its size with ``max_files_per_trigger`` (``availableNow`` then
    runs several bounded batches).  More ``buckets`` make small batches cheaper
    (the SCD2 sinks rebuild only the buckets a batch touched).

    ``exception_ts`` is ``as_of`` or the time of the micro-batch, which the stream's
    checkpoint keeps: the queue and its history agree, and a replay stamps the same."""

    def stamped(batch: DataFrame) -> DataFrame:
        return to_exceptions(get_invalid(batch), as_of=F.col(STAMP)).drop(STAMP)

    def passed(batch: DataFrame) -> DataFrame:
        return get_valid(batch).drop(STAMP)

    exc_hist = Scd2Sink(
        paths.exceptions_log,
        paths.exceptions_history,
        ["customer_id"],
        "event_ts",
        track=TRACKED_CUSTOMER_COLUMNS,
        buckets=buckets,
        transform=stamped,
    )
    valid_hist = Scd2Sink(
        paths.valid_log,
        paths.valid_history,
        ["customer_id"],
        "event_ts",
        track=TRACKED_CUSTOMER_COLUMNS,
        buckets=buckets,
        transform=passed,
    )
    handlers = {
        "checked": lambda b, i: batch_partitioned_append(paths.checked)(b.drop(STAMP), i),
        "exceptions": lambda b, i: batch_partitioned_append(paths.exceptions)(stamped(b), i),
        "valid": lambda b, i: batch_partitioned_append(paths.valid)(passed(b), i),
        "exception_history": exc_hist,
        "valid_history": valid_hist,
    }
    stamp = timestamp_literal(as_of) if as_of is not None else F.current_timestamp()
    stream = checked_stream(spark, paths.raw, rules, watermark, max_files_per_trigger).withColumn(STAMP, stamp)
    run_to_completion(fan_out(stream, handlers, paths.checkpoint))
    return exc_hist.read(spark), valid_hist.read(spark)


def open_exceptions(history: DataFrame) -> DataFrame:
    return latest(history)

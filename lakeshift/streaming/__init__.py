"""Structured Streaming helpers: watermark, multi-output fan-out, the SCD2
history sink and the durable expectation log."""

from lakeshift.streaming.expectation_log import expectation_log, expectation_totals, with_expectations, write_counts
from lakeshift.streaming.streams import fan_out, observed_totals, run_to_completion, with_event_watermark
from lakeshift.streaming.scd2_sink import Scd2Sink, batch_partitioned_append

__all__ = [
    "fan_out",
    "observed_totals",
    "run_to_completion",
    "with_event_watermark",
    "Scd2Sink",
    "batch_partitioned_append",
    "expectation_log",
    "expectation_totals",
    "with_expectations",
    "write_counts",
]

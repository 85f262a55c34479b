"""Column-level helpers (pure ``Column -> Column`` expressions, JVM-side)."""

from lakeshift.functions.timecols import as_naive_timestamps, parse_timestamp, timestamp_literal, truncate_time
from lakeshift.functions.identifiers import normalized_identifier
from lakeshift.functions.costs import dbu_estimate, idle_flag

__all__ = [
    "parse_timestamp",
    "truncate_time",
    "as_naive_timestamps",
    "timestamp_literal",
    "normalized_identifier",
    "dbu_estimate",
    "idle_flag",
]

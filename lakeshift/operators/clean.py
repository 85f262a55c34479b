"""Silver step of the event flow: flatten nested records, parse times,
validate with expectations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeshift.functions.timecols import parse_timestamp
from lakeshift.operators.expectations import expect

# ---- fixed values: event types admitted to silver -----------------------------
VALID_EVENT_TYPES = (
    "PushEvent",
    "PullRequestEvent",
    "WatchEvent",
    "ForkEvent",
    "IssuesEvent",
    "CreateEvent",
    "DeleteEvent",
    "IssueCommentEvent",
)
# -------------------------------------------------------------------------------

# output column <- dotted source path
FLAT_EVENT_COLUMNS = (
    ("id", "id"),
    ("event_type", "type"),
    ("actor_login", "actor.login"),
    ("actor_id", "actor.id"),
    ("repo_name", "repo.name"),
    ("repo_id", "repo.id"),
    ("org_login", "org.login"),
    ("public", "public"),
)
METADATA_COLUMNS = ("_ingested_at", "_source_file")


def flatten_events(bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Nested bronze event -> flat silver columns.

    A missing parent struct (``org`` NULL) yields NULL leaves.  Ingestion
    metadata columns (and ``carry`` columns) are kept when present.  Only the
    referenced leaves are read (nested schema pruning reaches the parquet scan).
    """
    cols = [F.col(src).alias(dst) for dst, src in FLAT_EVENT_COLUMNS]
    cols.insert(6, parse_timestamp("created_at").alias("event_time"))
    cols += [F.col(m) for m in (*METADATA_COLUMNS, *carry) if m in bronze.columns]
    return bronze.select(*cols)


def event_expectations(valid_types: Sequence[str] = VALID_EVENT_TYPES) -> tuple[dict, dict]:
    """(warn, drop) rule maps of the silver event table."""
    quoted = ", ".join("'" + t.replace("'", "''") + "'" for t in valid_types)
    warn = {"valid_event_id": "id IS NOT NULL"}
    drop = {
        "valid_event_type": f"event_type IN ({quoted})",
        "valid_event_time": "event_time IS NOT NULL",
    }
    return warn, drop


def silver_events(
    bronze: DataFrame,
    valid_types: Sequence[str] = VALID_EVENT_TYPES,
    observation: Observation | str | None = None,
) -> DataFrame:
    """Flatten, then apply the three event expectations.

    Rows without a type or a parsable time are removed (by the drop rules; a NULL
    predicate is a violation), rows without an id are kept and counted.  Narrow:
    no shuffle; ``IN`` / ``IS NOT NULL`` on stored columns reach the scan.
    """
    warn, drop = event_expectations(valid_types)
    return expect(flatten_events(bronze), warn=warn, drop=drop, observation=observation)

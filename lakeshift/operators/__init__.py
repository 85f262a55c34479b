"""DataFrame -> DataFrame operators (lazy; built from the DataFrame API)."""

from lakeshift.operators.clean import VALID_EVENT_TYPES, flatten_events, silver_events, event_expectations
from lakeshift.operators.costs import cost_log, cost_per_run, idle_alerts, idle_dbu_per_week
from lakeshift.operators.expectations import expect, expectation_counts
from lakeshift.operators.history import latest, scd2
from lakeshift.operators.rollups import (
    entity_activity,
    event_volume,
    events_per_bucket,
    top_entities,
    top_k_per_group,
    volume_totals,
)
from lakeshift.operators.rules import (
    SSN_RULES,
    apply_checks,
    get_invalid,
    get_valid,
    normalize_identifier,
    rule_names,
    to_exceptions,
)
from lakeshift.operators.slices import explode_hourly, plan_slices

__all__ = [
    "VALID_EVENT_TYPES",
    "flatten_events",
    "silver_events",
    "event_expectations",
    "cost_log",
    "cost_per_run",
    "idle_alerts",
    "idle_dbu_per_week",
    "expect",
    "expectation_counts",
    "latest",
    "scd2",
    "entity_activity",
    "event_volume",
    "events_per_bucket",
    "top_entities",
    "top_k_per_group",
    "volume_totals",
    "SSN_RULES",
    "apply_checks",
    "get_invalid",
    "get_valid",
    "normalize_identifier",
    "rule_names",
    "to_exceptions",
    "explode_hourly",
    "plan_slices",
]

"""Metadata-driven data-quality rules.

A rule is a plain dict::

    {"name": "SSN_MISSING", "criticality": "error" | "warn",
     "check": {"function": "is_not_null", "arguments": {"column": "ssn_norm"}},
     "user_metadata": {...}}                       # optional, str -> str

Supported check functions: ``is_not_null`` (fails on NULL) and
``sql_expression`` (fails when the predicate is FALSE; NULL passes).
``apply_checks`` evaluates all rules in one projection and adds ``_errors`` /
``_warnings``: arrays of result structs of the failing rules, NULL when none
failed.  Everything is narrow (no shuffle) and works on batch and streaming
DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.identifiers import ITIN_PATTERN, SSN_STRUCTURE, normalized_identifier
from lakeshift.functions.timecols import timestamp_literal

ERRORS = "_errors"
WARNINGS = "_warnings"
ERROR = "error"
WARN = "warn"

# ---- fixed values: the identifier rule pack ----------------------------------------
SSN_RULES = [
    {
        "check": {"function": "is_not_null", "arguments": {"column": "ssn_norm"}},
        "name": "SSN_MISSING",
        "criticality": "error",
    },
    {
        "check": {
            "function": "sql_expression",
            "arguments": {"expression": f"ssn_norm IS NULL OR ssn_norm RLIKE '{SSN_STRUCTURE}'"},
        },
        "name": "SSN_INVALID_STRUCTURE",
        "criticality": "error",
        "user_metadata": {
            "rule_type": "format_validation",
            "business_description": "SSN must be 9 digits and cannot contain invalid area, group, or serial numbers.",
            "remediation_hint": "Ensure SSN is normalized to 9 digits and does not contain restricted prefixes (000, 666, 9xx) or zero group/serial segments.",
        },
    },
    {
        "check": {
            "function": "sql_expression",
            "arguments": {"expression": f"ssn_norm IS NULL OR NOT (ssn_norm RLIKE '{ITIN_PATTERN}')"},
        },
        "name": "ITIN_SUPPLIED_INSTEAD_OF_SSN",
        "criticality": "warn",
        "user_metadata": {
            "rule_type": "identifier_classification",
            "business_description": "ITIN detected where SSN was expected.",
            "remediation_hint": "Confirm whether taxpayer provided an ITIN instead of SSN. Route to alternate compliance workflow.",
        },
    },
]
REVIEW_PENDING = "PENDING"
# ---------------------------------------------------------------------------------------


def _not_null(args: Mapping[str, str]) -> tuple[Column, str, list[str]]:
    col = args["column"]
    return F.col(col).isNull(), f"Column '{col}' value is null", [col]


def _sql_expression(args: Mapping[str, str]) -> tuple[Column, str, list[str]]:
    expr = args["expression"]
    msg = args.get("msg") or f"Value is not matching expression: {' '.join(expr.split())}"
    # FALSE fails; NULL passes (NOT NULL is NULL, coalesced to "no failure").
    return F.coalesce(~F.expr(expr), F.lit(False)), msg, list(args.get("columns", []))


CHECK_FUNCTIONS: dict[str, Callable[[Mapping[str, str]], tuple[Column, str, list[str]]]] = {
    "is_not_null": _not_null,
    "sql_expression": _sql_expression,
}


def compile_rule(rule: Mapping) -> tuple[str, Column, Column]:
    """Rule dict -> (criticality, failure predicate, result struct)."""
    check = rule["check"]
    fn = check["function"]
    if fn not in CHECK_FUNCTIONS:
        raise ValueError(f"unknown check function {fn!r}; known: {sorted(CHECK_FUNCTIONS)}")
    criticality = rule.get("criticality", ERROR)
    if criticality not in (ERROR, WARN):
        raise ValueError(f"criticality must be 'error' or 'warn', got {criticality!r}")
    failed, message, columns = CHECK_FUNCTIONS[fn](check.get("arguments", {}))
    name = rule.get("name") or f"{fn}_{'_'.join(columns)}"
    meta = rule.get("user_metadata") or {}
    meta_col = (
        F.create_map(*[F.lit(str(x)) for kv in sorted(meta.items()) for x in kv])
        if meta
        else F.create_map().cast("map<string,string>")
    )
    result = F.struct(
        F.lit(name).alias("name"),
        F.lit(message).alias("message"),
        F.array(*[F.lit(c) for c in columns]).cast("array<string>").alias("columns"),
        F.lit(fn).alias("function"),
        meta_col.alias("user_metadata"),
    )
    return criticality, failed, result


_RESULTS_TYPE = (
    "array<struct<name:string,message:string,columns:array<string>,function:string,user_metadata:map<string,string>>>"
)


def _results(pairs: list[tuple[Column, Column]]) -> Column:
    """Array of the failing rules' structs, NULL when none failed.

    Built as a ``concat`` of one-element-or-empty arrays (no lambda function),
    so the whole projection stays inside whole-stage code generation.
    """
    if not pairs:
        return F.lit(None).cast(_RESULTS_TYPE)
    empty = F.array().cast(_RESULTS_TYPE)
    arr = F.concat(*[F.when(failed, F.array(res)).otherwise(empty) for failed, res in pairs])
    return F.when(F.size(arr) > 0, arr)


def apply_checks(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Add ``_errors`` and ``_warnings`` (arrays of failing-rule structs or NULL)."""
    compiled = [compile_rule(r) for r in rules]
    errors = [(f, r) for c, f, r in compiled if c == ERROR]
    warnings = [(f, r) for c, f, r in compiled if c == WARN]
    return df.withColumns({ERRORS: _results(errors), WARNINGS: _results(warnings)})


def get_valid(checked: DataFrame) -> DataFrame:
    """Rows without errors (warning-only rows stay); result columns dropped."""
    return checked.filter(F.col(ERRORS).isNull()).drop(ERRORS, WARNINGS)


def get_invalid(checked: DataFrame) -> DataFrame:
    """Rows with any error or warning; result columns kept."""
    return checked.filter(F.col(ERRORS).isNotNull() | F.col(WARNINGS).isNotNull())


def to_exceptions(invalid: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Stamp exception-queue rows: ``exception_ts`` (``as_of``, a time or a column,
    or now) and ``review_status = 'PENDING'``."""
    if isinstance(as_of, Column):
        ts = as_of
    else:
        ts = timestamp_literal(as_of) if as_of is not None else F.current_timestamp()
    return invalid.withColumns({"exception_ts": ts, "review_status": F.lit(REVIEW_PENDING)})


def normalize_identifier(df: DataFrame, src: str = "ssn", dst: str = "ssn_norm") -> DataFrame:
    """Add ``dst`` = normalised digits of ``src`` (see ``normalized_identifier``)."""
    return df.withColumn(dst, normalized_identifier(src))


def rule_names(results: Column | str) -> Column:
    """Sorted, comma-joined rule names of a result array (NULL stays NULL)."""
    c = F.col(results) if isinstance(results, str) else results
    return F.when(c.isNotNull(), F.array_join(F.array_sort(F.transform(c, lambda r: r["name"])), ","))

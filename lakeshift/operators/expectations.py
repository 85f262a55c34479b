"""Expectations: named SQL predicates that either warn (count, keep the row)
or drop (count, remove the row).

Counting never costs an extra pass: ``DataFrame.observe`` attaches the counters
to the query that writes the result (batch or stream), and
``expectation_counts`` gives the same numbers as a DataFrame when a table of
them is wanted.  A predicate that evaluates to NULL counts as a violation.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN = "warn"
DROP = "drop"


def _holds(sql: str) -> Column:
    return F.coalesce(F.expr(sql), F.lit(False))


def expect(
    df: DataFrame,
    warn: Mapping[str, str] | None = None,
    drop: Mapping[str, str] | None = None,
    observation: Observation | str | None = None,
) -> DataFrame:
    """Apply expectations.  ``warn`` / ``drop`` map rule name -> SQL predicate.

    Counters (``<rule>_failed`` per rule and ``input_rows``) are published through
    ``observation`` (an ``Observation`` for batch, a name for streams, whose
    progress events carry them).
    """
    warn, drop = dict(warn or {}), dict(drop or {})
    if observation is not None:
        metrics = [F.count(F.lit(1)).alias("input_rows")]
        metrics += [F.count_if(~_holds(sql)).alias(f"{name}_failed") for name, sql in {**warn, **drop}.items()]
        df = df.observe(observation, *metrics)
    for sql in drop.values():
        # A filter keeps only TRUE rows, so NULL is already a violation; the bare
        # predicate (no coalesce wrapper) stays pushable to the scan.
        df = df.filter(F.expr(sql))
    return df


def expectation_counts(
    df: DataFrame,
    warn: Mapping[str, str] | None = None,
    drop: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per rule: ``rule, action, failed_rows, passed_rows, total_rows``.

    A single global aggregate (partial per task, one tiny final merge) followed by
    an unpivot of its one row.
    """
    rules = [(n, s, WARN) for n, s in (warn or {}).items()] + [(n, s, DROP) for n, s in (drop or {}).items()]
    if not rules:
        raise ValueError("no expectations given")
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(~_holds(sql)).alias(f"f{i}") for i, (_, sql, _) in enumerate(rules)]
    one_row = df.agg(*aggs)
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.lit(action).alias("action"), F.col(f"f{i}").alias("failed_rows"))
            for i, (name, _, action) in enumerate(rules)
        ]
    )
    return (
        one_row.select("total_rows", F.inline(pairs))
        .withColumn("passed_rows", F.col("total_rows") - F.col("failed_rows"))
        .select("rule", "action", "failed_rows", "passed_rows", "total_rows")
    )

"""lakeshift: Spark-native medallion, data-quality and history operators.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from the
DataFrame API, so Catalyst sees the whole plan (pruning, pushdown, partial
aggregation, exchange reuse).  Only the functions in ``lakeshift.plans`` and
``lakeshift.sinks`` perform actions.
"""

__version__ = "0.1.0"

"""Sinks: streaming appends (path, named table, partitioned), create-or-append
batch tables, published datasets with comment and properties."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# Between a published dataset's name and the number of a snapshot of it.
_SNAPSHOT = "__snapshot_"


def _stream_writer(df: DataFrame, checkpoint: str, partition_by: Sequence[str] | None, query_name: str | None, fmt: str):
    w = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    return w


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] | None = None,
    query_name: str | None = None,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Process everything available, append it to ``path``, stop.

    The checkpoint records processed files/offsets and the file sink's log makes
    the append exactly-once: a restart on the same checkpoint adds no rows.
    Readers use ``mergeSchema`` to see columns added by later batches.
    """
    return _stream_writer(df, checkpoint, partition_by, query_name, fmt).start(path)


def append_stream_to_table(
    df: DataFrame,
    table: str,
    checkpoint: str,
    partition_by: Sequence[str] | None = None,
    query_name: str | None = None,
    fmt: str = "parquet",
    comment: str | None = None,
) -> StreamingQuery:
    """Same as ``append_stream`` into a catalog table (created when missing),
    optionally with a table comment (a published streaming dataset)."""
    query = _stream_writer(df, checkpoint, partition_by, query_name, fmt).toTable(table)
    if comment:
        df.sparkSession.sql(f"COMMENT ON TABLE {table} IS {_literal(comment)}")
    return query


def append_batch(df: DataFrame, target: str, partition_by: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """Create-or-append: a path (contains '/') or a catalog table name."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def _literal(text: str) -> str:
    """A SQL string literal of ``text``."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def snapshots(spark: SparkSession, name: str) -> list[str]:
    """The stored snapshots of a published dataset, oldest first (full names)."""
    database, _, short = name.rpartition(".")
    tables = spark.catalog.listTables(database or None)
    prefix = f"{short}{_SNAPSHOT}".lower()
    found = [t.name for t in tables if t.name.lower().startswith(prefix) and t.name[len(prefix) :].isdigit()]
    return [f"{database}.{t}" if database else t for t in sorted(found, key=lambda t: int(t[len(prefix) :]))]


def publish_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    keep: int = 2,
) -> None:
    """Materialise a dataset under a catalog name (full refresh) with its comment and table properties.

    The rows go to a new snapshot table; the name is a view over the newest one
    and is moved there by one change of the catalog, after the snapshot is whole.
    A reader sees the old dataset or the new one, and a refresh that dies leaves
    the old one.  ``keep`` snapshots stay (the current one and those that running
    readers may have opened); older ones and the remains of a dead refresh that
    lie before them are dropped.  A plain table of that name becomes the first
    snapshot."""
    exists = spark.catalog.tableExists(name)
    if exists and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}{_SNAPSHOT}0")
        exists = False
    known = snapshots(spark, name)
    number = int(known[-1].rpartition(_SNAPSHOT)[2]) + 1 if known else 1
    snapshot = f"{name}{_SNAPSHOT}{number}"
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(snapshot)
    props = {"snapshot": str(number), **(properties or {})}
    listed = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in props.items())
    if exists:
        spark.sql(f"ALTER VIEW {name} AS SELECT * FROM {snapshot}")
        about = f", 'comment' = {_literal(comment)}" if comment else ""
        spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ({listed}{about})")
    else:
        about = f"COMMENT {_literal(comment)} " if comment else ""
        spark.sql(f"CREATE VIEW {name} {about}TBLPROPERTIES ({listed}) AS SELECT * FROM {snapshot}")
    for old in snapshots(spark, name)[:-keep]:
        spark.sql(f"DROP TABLE {old}")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite): a
    re-run of the same batch is idempotent."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .format(fmt)
        .partitionBy(*partition_by)
        .save(path)
    )

"""Incremental CSV auto-load: new files of a directory -> parquet table, with
columns matched by header name and new columns admitted (schema stored)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.sinks import overwrite_partitions
from lakeshift.sources.files import load_schema, read_csv_text, typed
from lakeshift.streaming.streams import run_to_completion

BATCH = "__batch"
# Fixed schema of the binary-file source (only ``path`` is selected).
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
# New files of one micro-batch: their paths reach the driver.
FILES_PER_TRIGGER = 1000


def run_csv_autoload(
    spark: SparkSession,
    source_dir: str,
    table: str,
    schema_store: str,
    checkpoint: str,
    max_files_per_trigger: int = FILES_PER_TRIGGER,
    query_name: str | None = None,
) -> DataFrame:
    """Stream the *paths* of new files (binary-file source, content not read) and
    append each micro-batch's rows to ``table`` idempotently (partition per batch
    id).  The table keeps the text of the files; ``read_csv_table`` casts it to the
    stored schema, so a type that a later file widens needs no rewrite."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "*.csv")
    reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    paths = reader.load(source_dir).select("path")

    def load(batch: DataFrame, batch_id: int) -> None:
        # One row per new file reaches the driver (bounded by maxFilesPerTrigger).
        files = [r[0] for r in batch.collect()]
        if not files:
            return
        text, _ = read_csv_text(spark, files, schema_store)
        overwrite_partitions(text.withColumn(BATCH, F.lit(batch_id)), table, [BATCH])

    w = paths.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    run_to_completion(w.start())
    return read_csv_table(spark, table, schema_store)


def read_csv_table(spark: SparkSession, table: str, schema_store: str) -> DataFrame:
    """The loaded table with the types of the stored schema.  The schema is known,
    so no footers are merged; files without a later column read it as NULL."""
    schema = load_schema(spark, schema_store)
    if schema is None:
        raise ValueError(f"no schema stored in {schema_store}: nothing was loaded")
    text = T.StructType([T.StructField(c, T.StringType(), True) for c in schema.names]).add(BATCH, T.LongType())
    return typed(spark.read.schema(text).parquet(table), schema)

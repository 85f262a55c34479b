"""Event medallion: raw JSON files -> bronze (stream) -> silver -> golds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators.clean import VALID_EVENT_TYPES, event_expectations, flatten_events, silver_events
from lakeshift.operators.expectations import expect
from lakeshift.operators.rollups import REPO_COUNTERS, TOP_K, entity_activity, event_volume, top_entities, top_k_per_group
from lakeshift.schemas import RAW_EVENT
from lakeshift.sinks import append_stream, overwrite_partitions, publish_table
from lakeshift.sources.files import read_json_stream, read_stored
from lakeshift.sources.json_schema import infer_or_load_json_schema
from lakeshift.streaming.expectation_log import write_counts
from lakeshift.streaming.streams import run_to_completion


EVENT_DATE = "event_date"


@dataclass
class MedallionPaths:
    raw: str
    bronze: str
    bronze_checkpoint: str
    silver: str
    gold_top: str
    gold_volume: str


def ingest_bronze(
    spark: SparkSession, raw: str, bronze: str, checkpoint: str, max_files_per_trigger=None, schema=RAW_EVENT,
    schema_store: str | None = None,
) -> None:
    """Raw JSON-lines directory of any ``schema`` -> bronze parquet (append, exactly-once).

    With ``schema_store`` the schema is the one stored there, inferred from the
    first drop (see ``sources.json_schema``), and ``schema`` is not used; later
    unknown keys and mistyped values are rescued."""
    if schema_store:
        schema = infer_or_load_json_schema(spark, raw, schema_store)
    lines = read_json_stream(spark, raw, schema, max_files_per_trigger=max_files_per_trigger)
    run_to_completion(append_stream(lines, bronze, checkpoint))


def build_golds(silver: DataFrame, k: int = TOP_K, counters=REPO_COUNTERS) -> tuple[DataFrame, DataFrame]:
    """(gold_top_repos, gold_event_volume) from silver."""
    return top_entities(silver, "repo_name", counters, "hour", k), event_volume(silver, order=True)


def run_medallion(
    spark: SparkSession,
    paths: MedallionPaths,
    valid_types: Sequence[str] = VALID_EVENT_TYPES,
    counters=REPO_COUNTERS,
    k: int = TOP_K,
) -> dict:
    """Bronze stream, then silver and golds recomputed in batch from storage.

    Silver is stored partitioned by ``event_date`` so time-bounded readers prune
    partitions; golds are small and stored unpartitioned."""
    ingest_bronze(spark, paths.raw, paths.bronze, paths.bronze_checkpoint)
    obs = Observation("silver_expectations")
    silver = silver_events(read_stored(spark, paths.bronze), valid_types, observation=obs)
    silver.withColumn(EVENT_DATE, F.to_date("event_time")).write.mode("overwrite").partitionBy(EVENT_DATE).parquet(
        paths.silver
    )
    stored = read_stored(spark, paths.silver).drop(EVENT_DATE)
    top, volume = build_golds(stored, k, counters)
    top.write.mode("overwrite").parquet(paths.gold_top)
    volume.write.mode("overwrite").parquet(paths.gold_volume)
    return dict(obs.get)


# ---- fixed values: published table names, comments and properties -------------
SILVER_TABLE = "silver_events"
GOLD_TOP_TABLE = "gold_top_repos"
GOLD_VOLUME_TABLE = "gold_event_volume"
TABLE_COMMENTS = {
    SILVER_TABLE: "Flattened events with parsed times; rows failing the drop expectations removed.",
    GOLD_TOP_TABLE: "Per hour, the repositories whose event count ranks in the top 20 (ties kept).",
    GOLD_VOLUME_TABLE: "Event count per hour and event type.",
}
TABLE_QUALITY = {SILVER_TABLE: "silver", GOLD_TOP_TABLE: "gold", GOLD_VOLUME_TABLE: "gold"}
# ----------------------------------------------------------------------------------


def publish_medallion(
    spark: SparkSession,
    bronze: DataFrame,
    valid_types: Sequence[str] = VALID_EVENT_TYPES,
    counters=REPO_COUNTERS,
    k: int = TOP_K,
    database: str | None = None,
) -> dict:
    """Silver and golds as catalog tables with comments and properties (full
    refresh); golds read the published silver.  Returns the expectation counters."""
    name = (lambda t: f"{database}.{t}") if database else (lambda t: t)
    obs = Observation("silver_expectations")

    def props(t):
        return {"quality": TABLE_QUALITY[t]}

    silver = silver_events(bronze, valid_types, observation=obs)
    publish_table(spark, silver, name(SILVER_TABLE), TABLE_COMMENTS[SILVER_TABLE], props(SILVER_TABLE))
    top, volume = build_golds(spark.table(name(SILVER_TABLE)), k, counters)
    publish_table(spark, top, name(GOLD_TOP_TABLE), TABLE_COMMENTS[GOLD_TOP_TABLE], props(GOLD_TOP_TABLE))
    publish_table(spark, volume, name(GOLD_VOLUME_TABLE), TABLE_COMMENTS[GOLD_VOLUME_TABLE], props(GOLD_VOLUME_TABLE))
    return dict(obs.get)


# ------------------------------------------------------------------ incremental variant
BATCH = "__batch"


def _summed(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial counts of several batches added up per key."""
    counts = [c for c in parts.columns if c not in (*keys, EVENT_DATE, BATCH)]
    return parts.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])


def run_medallion_incremental(
    spark: SparkSession,
    paths: MedallionPaths,
    silver_checkpoint: str,
    valid_types: Sequence[str] = VALID_EVENT_TYPES,
    counters=REPO_COUNTERS,
    k: int = TOP_K,
    max_files_per_trigger: int | None = None,
    expectation_log: str | None = None,
) -> None:
    """Hourly runs that touch only new data.

    * bronze: new raw files appended (as ``run_medallion``);
    * silver: new bronze files flattened and validated batch by batch and stored
      partitioned by ``event_date``; with ``expectation_log`` every batch's
      expectation counters are stored there (query ``silver_events``);
    * partial counts: every batch stores its own counts per (hour, repository)
      and (hour, type), partitioned by ``event_date``: counts add up, so no
      silver is read again;
    * golds: the dates a batch touched are added up from the partial counts
      (partition-pruned read), their top-K is redone and replaces those gold
      partitions (dynamic overwrite).  Exact, because a gold row depends only on
      the counts of its own hour.

    A replayed batch replaces its silver, counters and partial counts, and its
    dates' golds come out the same.
    """
    ingest_bronze(spark, paths.raw, paths.bronze, paths.bronze_checkpoint, max_files_per_trigger)
    reader = spark.readStream.schema(spark.read.parquet(paths.bronze).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    warn, drop = event_expectations(valid_types)

    def golds(path: str, delta: DataFrame, dates: list, keys: list[str]) -> DataFrame:
        """Counts of ``dates`` over all batches, this one's (``delta``) just stored."""
        return _summed(spark.read.schema(delta.schema).parquet(path).filter(F.col(EVENT_DATE).isin(dates)), keys)

    def publish(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        silver = expect(flatten_events(batch), warn, drop, seen).withColumn(EVENT_DATE, F.to_date("event_time"))
        silver = silver.persist(StorageLevel.MEMORY_AND_DISK)  # stored, then counted twice
        try:
            overwrite_partitions(silver.withColumn(BATCH, F.lit(batch_id)), paths.silver, [EVENT_DATE, BATCH])
            if expectation_log:
                write_counts(spark, expectation_log, SILVER_TABLE, batch_id, seen.get, warn, drop)
            deltas = {}
            for path, delta in (
                (f"{paths.gold_top}_counts", entity_activity(silver, "repo_name", counters, "hour")),
                (f"{paths.gold_volume}_counts", event_volume(silver)),
            ):
                delta = delta.withColumns({EVENT_DATE: F.to_date("event_hour"), BATCH: F.lit(batch_id)})
                overwrite_partitions(delta, path, [EVENT_DATE, BATCH])
                deltas[path] = delta
            # Touched dates: at most one row per day of the batch reaches the driver.
            dates = [r[0] for r in silver.select(EVENT_DATE).distinct().collect()]
        finally:
            silver.unpersist()
        if not dates:
            return
        (top_path, top_delta), (volume_path, volume_delta) = deltas.items()
        activity = golds(top_path, top_delta, dates, ["event_hour", "repo_name"])
        top = top_k_per_group(activity, "event_hour", "total_events", k=k)
        volume = golds(volume_path, volume_delta, dates, ["event_hour", "event_type"]).orderBy("event_hour", "event_type")
        for gold, path in ((top, paths.gold_top), (volume, paths.gold_volume)):
            overwrite_partitions(gold.withColumn(EVENT_DATE, F.to_date("event_hour")), path, [EVENT_DATE])

    query = reader.parquet(paths.bronze).writeStream.foreachBatch(publish).option("checkpointLocation", silver_checkpoint)
    run_to_completion(query.trigger(availableNow=True).start())

"""Catalog sinks and table streams: publish with comment/properties, create-or-
append, stream from / to named tables, watermark on timestamp_ntz, seed append."""

from datetime import datetime


from lakeshift.plans import fixtures as fx
from lakeshift.plans.exceptions import append_customer_records
from lakeshift.plans.medallion import publish_medallion
from lakeshift.schemas import CUSTOMER
from lakeshift.sinks import append_batch, append_stream_to_table
from lakeshift.sources.files import read_stored_stream
from lakeshift.streaming.streams import run_to_completion, with_event_watermark

from conftest import SF001


def test_publish_medallion_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS med")
    bronze = fx.raw_events(fx.table(spark, SF001, "events"))
    counters = publish_medallion(spark, bronze, fx.FIXTURE_VALID_TYPES, fx.FIXTURE_COUNTERS, database="med")
    assert counters["input_rows"] == fx.table(spark, SF001, "events").count()
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES med.gold_top_repos").collect()}
    assert props["quality"] == "gold"
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED med.silver_events").collect()}
    assert desc.get("Comment", "").startswith("Flattened events")
    assert spark.table("med.gold_event_volume").count() > 0


def test_seed_append_twice_creates_then_appends(spark):
    seed = spark.createDataFrame([("S1", "Noor", "321-54-9876", 1.0), ("S2", "Ilse", None, 2.0)], CUSTOMER)
    spark.sql("DROP TABLE IF EXISTS raw_customers")
    append_customer_records(seed, "raw_customers", as_of=datetime(2024, 1, 1))
    append_customer_records(seed, "raw_customers")
    t = spark.table("raw_customers")
    assert t.count() == 4 and t.select("record_id").distinct().count() == 4
    assert {r.source_system for r in t.collect()} == {"seed"}


def test_stream_between_named_tables(spark, tmp):
    spark.sql("DROP TABLE IF EXISTS src_events")
    spark.sql("DROP TABLE IF EXISTS dst_events")
    ev = fx.table(spark, SF001, "events")
    append_batch(ev, "src_events")
    stream = with_event_watermark(read_stored_stream(spark, "src_events"), "ts", "1 day")
    assert dict(stream.dtypes)["ts"] == "timestamp"
    run_to_completion(append_stream_to_table(stream, "dst_events", f"{tmp}/ck", partition_by=["event_type"],
                                             query_name="copy_events", comment="Raw source stream"))
    dst = spark.table("dst_events")
    assert dst.count() == ev.count() and dst.columns[-1] == "event_type"
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED dst_events").collect()}
    assert desc.get("Comment") == "Raw source stream"


def test_schema_inferred_once_then_loaded(spark, tmp):
    from lakeshift.sources.files import infer_or_load_schema

    ev = fx.table(spark, SF001, "events").select("event_id", "value", "event_type")
    ev.write.option("header", "true").csv(f"{tmp}/csv")
    first = infer_or_load_schema(spark, [f"{tmp}/csv"], "csv", f"{tmp}/store", header="true")
    assert [(f.name, f.dataType.simpleString()) for f in first.fields] == [
        ("event_id", "int"), ("value", "double"), ("event_type", "string")]
    # the stored schema wins over what a later inference would give
    spark.createDataFrame([("x", "y", "z")], "event_id string, value string, event_type string").write.mode(
        "overwrite").option("header", "true").csv(f"{tmp}/csv")
    assert infer_or_load_schema(spark, [f"{tmp}/csv"], "csv", f"{tmp}/store", header="true") == first


def test_transform_composition(spark):
    from lakeshift.operators.rules import SSN_RULES, apply_checks, normalize_identifier

    df = spark.createDataFrame([("C1", "n", "123-45-6789", 1.0)], CUSTOMER)
    out = df.transform(normalize_identifier).transform(apply_checks, SSN_RULES)
    assert out.first()._errors is None

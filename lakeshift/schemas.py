"""Record schemas of the data flows (explicit, so an input batch that lacks an
optional field such as ``org`` still resolves)."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw archive event (JSON lines).
RAW_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField(
            "actor",
            T.StructType([T.StructField("login", T.StringType()), T.StructField("id", T.LongType())]),
        ),
        T.StructField(
            "repo",
            T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.LongType())]),
        ),
        T.StructField("org", T.StructType([T.StructField("login", T.StringType())])),
        T.StructField("created_at", T.StringType()),
        T.StructField("public", T.BooleanType()),
    ]
)

# Customer record of the data-exception flow.
CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("ssn", T.StringType()),
        T.StructField("account_balance", T.DoubleType()),
    ]
)

# Rows produced by the sliced API source.
API_SLICE_ROW = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField("generationtime_ms", T.DoubleType()),
        T.StructField("utc_offset_seconds", T.IntegerType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("timezone_abbreviation", T.StringType()),
    ]
)

# API response body: parallel arrays plus scalars that apply to every element.
API_RESPONSE = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(T.StringType())),
                    T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
                ]
            ),
        ),
        T.StructField("hourly_units", T.StructType([T.StructField("temperature_2m", T.StringType())])),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField("generationtime_ms", T.DoubleType()),
        T.StructField("utc_offset_seconds", T.IntegerType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("timezone_abbreviation", T.StringType()),
    ]
)

# One sample of a cluster's state (replaces the single REST call of the
# reference with a table of samples for any number of clusters).
CLUSTER_SAMPLE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("sampled_at", T.TimestampType()),
        T.StructField("cluster_id", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("num_workers", T.IntegerType()),
        T.StructField("queries_run", T.LongType()),
    ]
)

# Structure of one data-quality rule result inside ``_errors`` / ``_warnings``.
RULE_RESULT = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("function", T.StringType()),
        T.StructField("user_metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

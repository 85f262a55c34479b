from pyspark.sql import Observation

from lakeshift.operators.clean import flatten_events, silver_events
from lakeshift.operators.expectations import expect, expectation_counts
from lakeshift.schemas import RAW_EVENT

ROWS = [
    ("1", "PushEvent", ("a", 1), ("r", 1), ("o",), "2024-01-01 10:00:00", True),
    (None, "WatchEvent", ("a", 1), ("r", 1), None, "2024-01-01 10:30:00", False),
    ("3", "BadEvent", ("b", 2), ("r", 1), None, "2024-01-01 11:00:00", None),
    ("4", None, ("b", 2), None, None, "2024-01-01 11:00:00", None),
    ("5", "ForkEvent", ("b", 2), ("s", 2), None, "not a time", None),
]


def test_silver_drops_and_warns(spark):
    bronze = spark.createDataFrame(ROWS, RAW_EVENT)
    obs = Observation("x")
    out = silver_events(bronze, observation=obs)
    rows = out.collect()
    assert sorted(r.id or "-" for r in rows) == ["-", "1"]
    assert rows[0].repo_name == "r"
    m = obs.get
    assert m["input_rows"] == 5
    assert m["valid_event_id_failed"] == 1
    assert m["valid_event_type_failed"] == 2  # BadEvent + NULL type
    assert m["valid_event_time_failed"] == 1
    # missing parent struct -> NULL leaves
    assert flatten_events(bronze).filter("id = '4'").first().repo_name is None


def test_expectation_counts_table(spark):
    flat = flatten_events(spark.createDataFrame(ROWS, RAW_EVENT))
    t = {r.rule: r for r in expectation_counts(flat, warn={"id": "id IS NOT NULL"}, drop={"t": "event_time IS NOT NULL"}).collect()}
    assert (t["id"].failed_rows, t["id"].passed_rows, t["id"].action) == (1, 4, "warn")
    assert (t["t"].failed_rows, t["t"].total_rows) == (1, 5)


def test_expect_without_observation_filters(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert expect(df, drop={"pos": "x > 1"}).count() == 1


def test_archive_time_formats_parse(spark):
    from datetime import datetime

    from lakeshift.functions.timecols import parse_timestamp

    df = spark.createDataFrame([("2011-02-12T00:00:00Z",), ("2024-01-01T10:00:00+02:00",), ("garbage",)], "s string")
    got = [r.t for r in df.select(parse_timestamp("s").alias("t")).collect()]
    assert got == [datetime(2011, 2, 12), datetime(2024, 1, 1, 8), None]

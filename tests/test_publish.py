"""Published datasets: a refresh is one change of the catalog."""

import pytest
from pyspark.sql import functions as F

from lakeshift.sinks import publish_table, snapshots


@pytest.fixture()
def db(spark, tmp):
    name = "pub_" + tmp.rsplit("-", 1)[-1].replace("-", "_").lower()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp}/{name}.db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def props(spark, name):
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def comment(spark, name):
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}.get("Comment")


def test_readers_see_the_old_or_the_new_dataset(spark, db):
    name = f"{db}.totals"
    publish_table(spark, spark.range(10), name, "First", {"quality": "gold"})
    before = spark.table(name)
    assert before.count() == 10
    publish_table(spark, spark.range(25).withColumn("more", F.lit("x")), name, "Second", {"quality": "better"}, partition_by=["more"])
    assert before.count() == 10  # a reader that opened the old one
    assert spark.table(name).count() == 25 and spark.table(name).columns == ["id", "more"]
    assert props(spark, name)["quality"] == "better" and comment(spark, name) == "Second"
    # a dataset may be computed from its own published state
    publish_table(spark, spark.table(name).filter("id < 5"), name)
    assert spark.table(name).count() == 5
    assert snapshots(spark, name) == [f"{name}__snapshot_2", f"{name}__snapshot_3"]


def test_refresh_that_dies_leaves_the_old_dataset(spark, db):
    name = f"{db}.safe"
    publish_table(spark, spark.range(3), name)
    broken = spark.range(100).withColumn("v", F.when(F.col("id") < 90, F.lit(1)).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        publish_table(spark, broken, name)
    assert spark.table(name).count() == 3
    for n in (4, 5, 6):
        publish_table(spark, spark.range(n), name)
        assert spark.table(name).count() == n
    assert len(snapshots(spark, name)) == 2


def test_texts_are_escaped(spark, db):
    hostile = "it's \"a\" back\\slash '); DROP"
    publish_table(spark, spark.range(1), f"{db}.q", hostile, {"k'ey": hostile})
    assert comment(spark, f"{db}.q") == hostile and props(spark, f"{db}.q")["k'ey"] == hostile
    publish_table(spark, spark.range(2), f"{db}.q", hostile + "2", {"k'ey": "x"})
    assert comment(spark, f"{db}.q") == hostile + "2" and props(spark, f"{db}.q")["k'ey"] == "x"


def test_plain_table_becomes_the_first_snapshot(spark, db):
    name = f"{db}.plain"
    spark.range(7).write.saveAsTable(name)
    publish_table(spark, spark.range(8), name, "Now a view")
    assert spark.table(name).count() == 8 and spark.table(f"{name}__snapshot_0").count() == 7
    other = f"{db}.plain_2"
    publish_table(spark, spark.range(1), other)
    assert snapshots(spark, name) == [f"{name}__snapshot_0", f"{name}__snapshot_1"] and snapshots(spark, other) == [f"{other}__snapshot_1"]

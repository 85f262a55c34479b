"""Inferred JSON schemas: the lattice, stored versions, and a bronze flow whose columns no code names."""

import json

import pytest
from pyspark.sql import types as T

from lakeshift.plans.medallion import ingest_bronze
from lakeshift.sources.files import list_names, read_stored
from lakeshift.sources.json_schema import evolve_json_schema, infer_json_schema, infer_or_load_json_schema, load_json_schema, merged_schema, stored_versions, wider_type


def drop(spark, folder, lines, mode="append"):
    rows = [(line if isinstance(line, str) else json.dumps(line),) for line in lines]
    spark.createDataFrame(rows, "value string").repartition(3).write.mode(mode).text(folder)


def ddl(schema):
    return schema.simpleString()


def test_lattice():
    long, double, text, null, boolean = T.LongType(), T.DoubleType(), T.StringType(), T.NullType(), T.BooleanType()
    struct = lambda **f: T.StructType([T.StructField(k, v) for k, v in f.items()])
    types = [long, double, text, null, boolean, T.ArrayType(long), T.ArrayType(struct(a=long)), struct(a=long), struct(b=text, a=double)]
    for a in types:
        assert wider_type(a, a) == a and wider_type(a, null) == a == wider_type(null, a)
        for b in types:
            meet = wider_type(a, b)
            assert wider_type(meet, a) == meet and wider_type(meet, b) == meet
            if not isinstance(meet, (T.StructType, T.ArrayType)):
                assert meet == wider_type(b, a)
    assert wider_type(long, double) == double and wider_type(long, boolean) == text
    assert ddl(merged_schema(struct(z=long, b=struct(x=long)), struct(a=text, b=struct(y=null, x=double), z=double))) == (
        "struct<z:double,b:struct<x:double,y:void>,a:string>"
    )


def test_every_line_counts_and_corrupt_ones_do_not(spark, tmp):
    drop(spark, tmp + "/d", [{"a": 1, "o": {"x": None}}] * 50 + [{"a": 2.5, "b": [1, None], "o": {"x": 1, "y": "t"}}, "cut {", "", {"a": None, "n": None, "e": {}}])
    assert ddl(infer_json_schema(spark, f"{tmp}/d")) == "struct<a:double,b:array<bigint>,n:string,o:struct<x:bigint,y:string>>"


def test_first_version_is_kept_and_evolution_adds_the_next(spark, tmp):
    store = f"{tmp}/store"
    assert load_json_schema(spark, store) is None
    drop(spark, f"{tmp}/one", [{"id": 1, "v": 1}])
    drop(spark, f"{tmp}/two", [{"id": "x", "v": 1.5, "w": {"k": True}}])
    first = infer_or_load_json_schema(spark, f"{tmp}/one", store)
    assert ddl(first) == "struct<id:bigint,v:bigint>"
    assert infer_or_load_json_schema(spark, f"{tmp}/two", store) == first
    second = evolve_json_schema(spark, f"{tmp}/two", store)
    assert ddl(second) == "struct<id:string,v:double,w:struct<k:boolean>>"
    assert evolve_json_schema(spark, f"{tmp}/two", store) == second == load_json_schema(spark, store)
    assert stored_versions(spark, store) == [1, 2] and load_json_schema(spark, store, 1) == first
    # a version that died while it was written is not seen
    spark.createDataFrame([("half",)], "v string").write.text(f"{store}/version=3")
    (__import__("pathlib").Path(store) / "version=3" / "_SUCCESS").unlink()
    assert load_json_schema(spark, store) == second


def test_drop_without_an_object_is_refused(spark, tmp):
    drop(spark, f"{tmp}/d", ["", "  "])
    with pytest.raises(ValueError, match="no JSON object"):
        infer_or_load_json_schema(spark, f"{tmp}/d", f"{tmp}/store")
    assert list_names(spark, f"{tmp}/store") == []


def test_bronze_with_a_stored_schema(spark, tmp):
    run = lambda: ingest_bronze(spark, f"{tmp}/raw", f"{tmp}/bronze", f"{tmp}/ck", schema_store=f"{tmp}/schema")
    drop(spark, f"{tmp}/raw", [{"id": i, "unheard_of": {"deep": i * 0.5}, "tags": ["a"]} for i in range(20)])
    run()
    drop(spark, f"{tmp}/raw", [{"id": 100, "unheard_of": {"deep": "text", "new": 1}, "tags": []}, {"id": 101, "later": [1]}, "broken"])
    run()
    run()  # nothing new
    rows = {r["id"]: r for r in read_stored(spark, f"{tmp}/bronze").collect()}
    assert len(rows) == 23 and rows[7]["unheard_of"]["deep"] == 3.5 and rows[7]["_rescued_data"] is None
    assert json.loads(rows[100]["_rescued_data"]).keys() == {"unheard_of"} and rows[100]["unheard_of"]["deep"] is None
    assert json.loads(rows[101]["_rescued_data"]) == {"later": "[1]"} and rows[None]["_corrupt_record"] == "broken"
    assert stored_versions(spark, f"{tmp}/schema") == [1]

import json
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.schemas import RAW_EVENT
from lakeshift.sources.files import load_schema, merge_schemas, read_csv_evolving, read_json


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_rescue_semantics(spark, tmp):
    good = {"id": "1", "type": "PushEvent", "actor": {"login": "a", "id": 1}, "repo": {"name": "r", "id": 2},
            "created_at": "2024-01-01T00:00:00Z", "public": True}
    lines = [
        json.dumps(good),
        json.dumps({**good, "id": "2", "extra": 5}),                                   # unknown key
        json.dumps({**good, "id": "3", "public": "yes"}),                              # mistyped top-level
        json.dumps({**good, "id": "4", "actor": {"login": "a", "id": "bad"}}),         # mistyped inside struct
        json.dumps({**good, "id": "5", "actor": {"login": "a", "id": 1, "x": 1}}),     # unknown sub-field
        json.dumps({**good, "id": "6", "public": None}),                               # null is not rescued
        "not json at all",
    ]
    _write(tmp, "a.json", lines)
    rows = {r.id: r for r in read_json(spark, tmp, RAW_EVENT, rescue=True).collect()}
    assert rows["1"]._rescued_data is None
    assert json.loads(rows["2"]._rescued_data) == {"extra": "5"}
    assert json.loads(rows["3"]._rescued_data) == {"public": "yes"} and rows["3"].public is None
    assert "actor" in json.loads(rows["4"]._rescued_data) and rows["4"].actor.login == "a"
    assert "actor" in json.loads(rows["5"]._rescued_data)
    assert rows["6"]._rescued_data is None
    bad = [r for r in read_json(spark, tmp, RAW_EVENT).collect() if r._corrupt_record is not None]
    assert len(bad) == 1 and bad[0].id is None


def test_rescue_reaches_every_level_and_arrays(spark, tmp):
    inner = T.StructType([T.StructField("n", T.LongType())])
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("a", T.StructType([T.StructField("b", T.StructType([T.StructField("c", inner)]))])),
            T.StructField("xs", T.ArrayType(T.LongType())),
            T.StructField("ys", T.ArrayType(inner)),
        ]
    )
    cases = {
        "clean": {"a": {"b": {"c": {"n": 1}}}, "xs": [1, None, 2], "ys": [{"n": 1}, {"n": None}, None]},
        "deep mistype": {"a": {"b": {"c": {"n": "x"}}}},
        "deep unknown": {"a": {"b": {"c": {"n": 1}, "new": 2}}},
        "struct as text": {"a": {"b": "text"}},
        "array element": {"xs": [1, "x"]},
        "struct in array": {"ys": [{"n": 1}, {"n": 1, "new": 2}]},
        "nulls": {"a": None, "xs": None, "ys": None},
    }
    _write(tmp, "a.json", [json.dumps({"id": k, **v}) for k, v in cases.items()])
    got = {r.id: r._rescued_data and sorted(json.loads(r._rescued_data)) for r in read_json(spark, tmp, schema).collect()}
    assert got == {
        "clean": None, "deep mistype": ["a"], "deep unknown": ["a"], "struct as text": ["a"],
        "array element": ["xs"], "struct in array": ["ys"], "nulls": None,
    }


def test_rescue_parses_a_line_twice_and_a_struct_once(spark, tmp):
    _write(tmp, "a.json", ["{}"])
    plan = read_json(spark, tmp, RAW_EVENT)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2 + 3


def test_csv_headers_matched_by_name(spark, tmp):
    _write(tmp, "1.csv", ["id,name,amount", "1,a,1.5", "2,b,2.5"])
    _write(tmp, "2.csv", ["amount,id,name,extra", "3.5,3,c,x"])
    store = os.path.join(tmp, "_schema")
    files = [os.path.join(tmp, "1.csv"), os.path.join(tmp, "2.csv")]
    df = read_csv_evolving(spark, files, store)
    got = sorted(tuple(r) for r in df.select("id", "name", "amount", "extra").collect())
    assert got == [(1, "a", 1.5, None), (2, "b", 2.5, None), (3, "c", 3.5, "x")]
    assert [f.name for f in load_schema(spark, store).fields] == ["id", "name", "amount", "extra"]
    # a later file with a mistyped known column widens the stored type
    _write(tmp, "3.csv", ["id,name,amount", "x9,d,4.5"])
    df2 = read_csv_evolving(spark, [os.path.join(tmp, "3.csv")], store)
    assert df2.schema["id"].dataType == T.StringType()
    assert df2.filter(F.col("name") == "d").first().id == "x9"


def test_merge_schemas_widening():
    a = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    b = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("z", T.LongType())])
    m = merge_schemas(a, b)
    assert [(f.name, f.dataType) for f in m.fields] == [("x", T.DoubleType()), ("y", T.StringType()), ("z", T.LongType())]


def test_header_readers_agree(spark, tmp):
    from lakeshift.sources.files import file_headers, file_headers_by_scan

    _write(tmp, "a.csv", ["﻿x,y", "1,2"])
    with open(os.path.join(tmp, "b.csv"), "w", newline="") as fh:
        fh.write("p,q,r\r\n1,2,3\r\n")
    files = [os.path.join(tmp, "a.csv"), os.path.join(tmp, "b.csv")]
    fast = {os.path.basename(r.file_path): r.header for r in file_headers(spark, files).collect()}
    assert fast == {"a.csv": "x,y", "b.csv": "p,q,r"}
    scan = {os.path.basename(r.file_path): r.header.removeprefix("﻿").rstrip("\r") for r in file_headers_by_scan(spark, files).collect()}
    assert scan == fast


def _load_csv(spark, tmp):
    from lakeshift.plans.csv_autoload import run_csv_autoload

    return run_csv_autoload(spark, f"{tmp}/drop", f"{tmp}/table", f"{tmp}/_schema", f"{tmp}/_ckpt")


def test_csv_table_reads_back_after_a_type_widens(spark, tmp):
    os.makedirs(f"{tmp}/drop")
    _write(f"{tmp}/drop", "1.csv", ["id,a.b", "007,1", "8,2"])
    first = _load_csv(spark, tmp)
    assert first.schema["id"].dataType == T.IntegerType()
    assert sorted(map(tuple, first.collect())) == [(7, 1), (8, 2)]
    _write(f"{tmp}/drop", "2.csv", ["id,a.b,more", "x9,2.5,true"])
    second = _load_csv(spark, tmp)
    assert [f.dataType for f in second.schema.fields] == [T.StringType(), T.DoubleType(), T.BooleanType()]
    assert sorted(map(tuple, second.collect())) == [("007", 1.0, None), ("8", 2.0, None), ("x9", 2.5, True)]


def test_csv_column_without_values_keeps_its_type(spark, tmp):
    os.makedirs(f"{tmp}/drop")
    _write(f"{tmp}/drop", "1.csv", ["id,day,code", "1,2024-01-01,a"])
    _load_csv(spark, tmp)
    _write(f"{tmp}/drop", "2.csv", ["id,day,code", ",,007"])
    table = _load_csv(spark, tmp)
    assert [f.dataType for f in table.schema.fields] == [T.IntegerType(), T.DateType(), T.StringType()]
    assert table.filter("id is null").first().code == "007"


def test_unreadable_csv_file_fails(spark, tmp):
    from lakeshift.sources.files import file_headers

    with open(os.path.join(tmp, "bad.csv"), "wb") as fh:
        fh.write(b"\xff\xfe\xfa,x\n1,2\n")
    with pytest.raises(Exception, match="UnicodeDecodeError|decode"):
        file_headers(spark, [os.path.join(tmp, "bad.csv")]).collect()

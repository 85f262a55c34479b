"""Mixed CSV headers in one scan."""

import os
import random

import pytest

from lakeshift.plans import fixtures as fx
from lakeshift.sources.files import header_names, read_csv_evolving, read_csv_text


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as fh:
        fh.write(text)
    return os.path.join(folder, name)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_500_headers_in_a_plan_of_constant_size(spark, tmp):
    rng, names = random.Random(1), [f"col{i}" for i in range(8)]
    want, paths = [], []
    for f in range(500):
        header = rng.sample(names, rng.randint(1, 8))
        rows = [[f"{f}.{r}.{n}" for n in header] for r in range(2)]
        want += [{**dict.fromkeys(names), **dict(zip(header, row, strict=True))} for row in rows]
        paths.append(_write(f"{tmp}/many", f"{f}.csv", "\n".join(",".join(x) for x in [header, *rows]) + "\n"))
    text, schema = read_csv_text(spark, paths)
    assert sorted(schema.names) == names
    got = [r.asDict() for r in text.collect()]
    key = lambda r: tuple(r[n] or "" for n in names)
    assert sorted(got, key=key) == sorted(want, key=key)
    plan = _plan(text)
    assert plan.count("Relation [") == 1 and "Union" not in plan
    few, _ = read_csv_text(spark, [_write(f"{tmp}/few", "a.csv", ",".join(names) + "\n1,2,3,4,5,6,7,8\n")])
    assert len(_plan(few).splitlines()) == len(plan.splitlines())


def test_quoted_line_breaks_and_odd_names(spark, tmp):
    a = _write(f"{tmp}/a b+c%20é", "one.csv", 'id,"a ""quoted"" name",id\n1,"line\nbreak",x\n2,"a,b",y\n')
    b = _write(f"{tmp}/a b+c%20é", "two.csv", '"multi\nline",id0,\n"p",7,q\n')
    df = read_csv_evolving(spark, [a, b], multiLine="true")
    rows = sorted((r.asDict() for r in df.collect()), key=lambda r: str(r["id0"]))
    assert df.columns == ["id0", 'a "quoted" name', "id2", "multi\nline", "_c2"]
    assert [r['a "quoted" name'] for r in rows] == ["line\nbreak", "a,b", None]
    assert rows[2]["multi\nline"] == "p" and rows[2]["_c2"] == "q" and rows[2]["id0"] == 7
    assert header_names("a;B;b", {"sep": ";"}) == ["a", "B1", "b2"] and header_names("") == []


def test_header_only_files_short_rows_and_long_rows(spark, tmp):
    paths = [_write(tmp, "1.csv", "a,b\n"), _write(tmp, "2.csv", "b,a\n1\n2,3,4\n"), _write(tmp, "3.csv", "a,b\na,b\n")]
    got = sorted(map(tuple, read_csv_evolving(spark, paths, infer=False).select("a", "b").collect()), key=str)
    assert got == [("3", "2"), ("a", "b"), (None, "1")]  # a row like the header is a row
    with pytest.raises(ValueError):
        read_csv_text(spark, [])


def test_files_of_a_drop_grow_in_rows_and_not_in_number(spark, tmp):
    """A stream takes a fixed number of files a batch: a larger table gives larger batches, and no more of them."""
    columns = "id AS c_custkey, 'n' AS c_name, 1.5 AS c_acctbal, 's' AS c_mktsegment, 3 AS c_nationkey"
    files = {}
    for n in (1000, 300_000):
        folder = fx.write_customer_csv_drop(spark.range(n, numPartitions=2).selectExpr(*columns.split(", ")), f"{tmp}/{n}")
        files[n] = [f for f in os.listdir(folder) if f.endswith(".csv")]
        assert read_csv_evolving(spark, [f"{folder}/{f}" for f in files[n]]).select("customer_id").distinct().count() == n
    assert len(files[1000]) == 6 and len(files[300_000]) <= fx.FILES_PER_DROP + 6

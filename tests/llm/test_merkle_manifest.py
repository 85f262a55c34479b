"""The manifest against trees built in plain Python, and its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from lakeshift.llm import merkle_manifest as m

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def kin(levels, i):
    out = []
    for nodes in levels[:-1]:
        a = i - i % 16
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + 16])))
        i //= 16
    return out


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    first = lambda v: (v is not None, v if v is not None else 0)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda r: (*first(r[0]), leaf(r)))
        trees[s] = tree([leaf(r) for r in by_source[s]])
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, row in enumerate(by_source[s]):
            path = kin(trees[s], i) + kin(top, k)
            own = leaf(row)
            folded = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                folded = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for b, a in path:
                folded = H(b + folded + a)
            root = top[-1][0]
            out.append((row[0], own, trees[s][-1][0], root, H("".join(b + a for b, a in path)), folded, folded == root))
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def manifest(spark, rows, schema=SCHEMA):
    return ordered(tuple(r[c] for c in NAMES) for r in m.manifest(spark.createDataFrame(rows, schema)).collect())


def made(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice(["Some Text É", "lower only é", "", None, "X" * rng.randint(1, 50)])
            rows.append((rng.randint(-50, 10**6), source, rng.choice(["en", "é", None]), rng.choice([None, 0, 12]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        {"one": 1},
        {"a": 16, "b": 17, None: 1, "é": 2, "z" * 3: 256, "Z": 257},
        {"hot": 4200, "b": 300, **{f"s{i}": 1 + i % 3 for i in range(300)}},
    ],
)
def test_equals_plain_trees(spark, sizes):
    rows = made(sizes)
    assert manifest(spark, rows) == brute(rows)


def test_sql_equals_plain_trees(spark):
    rows = made({"a": 40, "b": 300, None: 3, "c": 1, **{f"s{i}": 2 for i in range(20)}}, 2)
    frame = spark.createDataFrame(rows, SCHEMA).toPandas()
    con = duckdb.connect()
    con.register("frame", frame.assign(doc_id=frame["doc_id"].astype("Int64"), n_chars=frame["n_chars"].astype("Int64")))
    con.sql(f"CREATE VIEW documents AS SELECT doc_id, source, lang, n_chars, text FROM frame")
    assert ordered(con.sql(f"SELECT {', '.join(NAMES)} FROM ({m.ORACLE})").fetchall()) == brute(rows)


def test_tampering_is_seen_and_nothing_else(spark):
    rows = [(i, f"s{i % 7}", "en", 3, "Abc" if i % 2 else "abc") for i in range(700)]
    got = manifest(spark, rows)
    seen = [r[0] for r in got if not r[6]]
    assert seen == [i for i in range(700) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0] and seen
    assert all(r[3] == r[5] for r in got if r[6])


def test_defined_cases(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string, node string, tree int, rank array<int>, grp double"
    assert manifest(spark, [], schema) == []
    extra = ("n", 1, [1], 2.0)
    rows = [(None, None, None, None, None), (7, "s", "en", 1, "T"), (7, "s", "en", 1, "T"), (7, "s", None, 1, "U"), (None, "s", "en", None, "x" * 200_000)]
    assert manifest(spark, [(*r, *extra) for r in rows], schema) == brute(rows)


def test_copies_of_one_row(spark):
    rows = [(1, "s", "en", 1, "T")] * 3000 + [(2, "t", "en", 1, "T")]
    assert manifest(spark, rows) == brute(rows)

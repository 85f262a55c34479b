"""Positions without copies, hot ids and keys, repetitive texts, clashing names, and a group of near copies."""

import random
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshift.llm import brown_lm, common, extendible_sharding, order_minhash, overlap_tokens, quality_bayes, rows, source_mixing, spaced_decontam

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _vocabulary(rng, n=800):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def test_positions_of_a_stored_table_do_not_depend_on_splits(spark, tmp):
    spark.range(5000).withColumn("doc_row", F.col("id") % 3).repartition(7).write.option("parquet.block.size", 4096).parquet(f"{tmp}/t")
    docs = spark.read.parquet(f"{tmp}/t")
    read = lambda: {(r[0], r[1]) for r in rows.positioned(docs, "t").select("doc.id", "doc_row").collect()}
    whole = read()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert read() == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({p for _, p in whole}) == len(whole) == 5000 and min(p for _, p in whole) >= 0
    gone = spark.createDataFrame([(p,) for i, p in whole if i % 3 == 0], "p long")
    left = rows.without(rows.positioned(docs, "t"), gone, "gone").select("doc.*")
    assert sorted(r["id"] for r in left.collect()) == [i for i in range(5000) if i % 3]
    assert rows.without(rows.positioned(docs, "t"), gone.limit(0), "none").count() == 5000
    other = docs.unionByName(docs)  # not one stored table: rows of its own
    assert rows.positioned(other, "u").select("doc_row").distinct().count() == 10_000


def test_temporary_tables_go_and_kept_ones_stay(spark):
    with common.temporary(spark):
        a = common.stored(spark.range(3), "a")
        with common.temporary(spark):
            b = common.stored(spark.range(4), "b", keep=True)
        c = common.stored(spark.range(5), "c", keep=True)
        files = a.inputFiles() + b.inputFiles()
        assert b.count() == 4
    assert c.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(*files).count()


def test_mixture_takes_what_the_plan_says_also_of_hot_ids(spark, tmp):
    rng = random.Random(8)
    words = _vocabulary(rng)
    made = []
    for i in range(900):
        doc_id = 7 if i % 3 == 0 else None if i % 7 == 0 else i
        text = None if i % 50 == 0 else " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 10, 40])))
        made.append((doc_id, text, "en", rng.choice(["a", "b", "c", None]) if i % 2 else "a", i))
    spark.createDataFrame(made, SCHEMA).repartition(5).write.parquet(f"{tmp}/documents.parquet")
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    plan = source_mixing.mixed(docs).groupBy("doc_id", "size").agg(F.sum("taken").alias("taken"))
    wanted = {(r[0], r[1]): r[2] for r in plan.collect() if r[2]}
    mix = source_mixing.mixture(docs)
    assert mix.columns == docs.columns
    got = Counter()
    for r in mix.collect():
        n = len((r["text"] or "").split())
        got[r["doc_id"], n] += n
    assert {k: v for k, v in got.items() if v} == wanted
    assert sorted(map(repr, mix.collect())) == sorted(map(repr, source_mixing.mixture(docs).collect()))
    sums = source_mixing.mixed(docs).agg(F.sum("taken"), F.sum("size")).first()
    assert abs(sums[0] - 1.5 * sums[1]) < 200
    many = spark.createDataFrame([(1, "w " * (i % 9 + 1), "en", "s", i) for i in range(3000)], SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    try:
        lined = source_mixing.lined(source_mixing.mix_rows(many))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in lined.groupBy("part").count().collect()) < 1500


def test_sharding_replaces_columns_of_its_names(spark, tmp):
    docs = spark.createDataFrame([(i, "x" * 100, "mine", i, True) for i in range(200)], "doc_id long, text string, shard string, Shard_Bytes int, oversized boolean")
    out = extendible_sharding.sharded(docs, 2000)
    assert out.columns == ["doc_id", "text", "shard", "shard_bytes", "shard_rows", "oversized"]
    out.write.parquet(f"{tmp}/s")
    extendible_sharding.write_shards(docs, 2000, f"{tmp}/shards")
    stored = spark.read.parquet(f"{tmp}/s")
    assert stored.groupBy("shard").agg(F.sum(F.length("text")).alias("b")).filter("b > 2000").count() == 0
    assert spark.read.parquet(f"{tmp}/shards").count() == 200


def test_directory_equals_a_reference(spark, tmp):
    """The shards of a plain recursive split of the same addresses."""
    rng = random.Random(3)
    docs = spark.createDataFrame([(rng.choice([i, 5]), "y" * rng.randint(0, 90)) for i in range(600)], "doc_id long, text string")
    docs.write.parquet(f"{tmp}/d")
    docs = spark.read.parquet(f"{tmp}/d")
    where = rows.positioned(docs, "d").select("doc_row", F.octet_length("doc.text").alias("b"), *extendible_sharding.addressed(F.col("doc.doc_id"), F.col("doc_row")))
    bits = {r[0]: (f"{r.a1 & (2**64 - 1):064b}{r.a2 & (2**64 - 1):064b}", r.b) for r in where.collect()}

    def split(members, prefix):
        if sum(b for _, b in members) <= 700 or len(members) <= 1:
            return {prefix: (sum(b for _, b in members), len(members))} if members else {}
        k = len(prefix)
        return split([m for m in members if m[0][k] == "0"], prefix + "0") | split([m for m in members if m[0][k] == "1"], prefix + "1")

    got = extendible_sharding.sharded(docs, 700).groupBy("shard", "shard_bytes", "shard_rows").count().collect()
    assert {r["shard"]: (r["shard_bytes"], r["shard_rows"]) for r in got} == split(list(bits.values()), "")
    assert all(r["count"] == r["shard_rows"] for r in got)


def test_million_equal_words_in_seconds(spark):
    docs = spark.createDataFrame([(1, "a " * 1_000_000), (2, "a " * 15 + "b " * 20), (3, "c " * 100)], "doc_id long, text string")
    bench = spark.createDataFrame([(0, "a " * 20), (1, "d e f g h i j k l m n o p q")], "item_id long, text string")
    spaced_decontam.contamination(docs.limit(0), bench).count()
    start = time.time()
    got = {r["doc_id"]: (r["contaminated"], r["equal_words"]) for r in spaced_decontam.contamination(docs, bench).collect()}
    assert time.time() - start < 60
    assert got == {1: (True, 20), 2: (True, 15), 3: (False, 0)}


def test_overlaps_of_repetitive_texts_equal_brute_force(spark):
    rng = random.Random(6)
    words = ["a", "b", "c d", "e"]
    text = lambda n: " ".join(rng.choice(words[: rng.choice([1, 2, 4])]) for _ in range(n))
    items = [text(rng.randint(13, 30)).split()[:40] for _ in range(12)]
    texts = [text(rng.randint(0, 120)).split() for _ in range(60)] + [text(30).split() + items[k] + text(30).split() for k in range(6)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")

    def best(t, item):
        out = 0
        for d in range(-len(item), len(t)):
            lo, hi = max(0, -d), min(len(item), len(t) - d)
            if lo < hi:
                out = max(out, spaced_decontam.most_equal(np.array([t[d + p] == item[p] for p in range(lo, hi)]), 0.8))
        return out if out >= min(13, len(item)) else 0

    want = {i: {k for k, item in enumerate(items) if best(t, item)} for i, t in enumerate(texts)}
    got = {r["doc_id"]: {int(x) for x in r["item_ids"].split(",") if x} for r in spaced_decontam.contamination(docs, bench).collect()}
    assert got == want and sum(map(bool, want.values())) > 10


def test_labelled_id_of_many_rows(spark):
    rng = random.Random(4)
    words, bad = _vocabulary(rng), ["vile", "slur", "hateful"]
    made = [(i, " ".join(rng.choice(bad if i % 4 == 0 and rng.random() < 0.4 else words) for _ in range(60)), "en", "s", 1) for i in range(400)]
    made += [(3, f"hot {i} " + " ".join(rng.choice(words) for _ in range(10)), "en", "s", 1) for i in range(300)] + [(3, None, "en", "s", 1)] * 50
    docs = spark.createDataFrame(made, SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(0, 400, 1) if i % 5], "doc_id long, quality int, toxic int")
    size = []
    real = common.stored
    quality_bayes.stored = lambda df, name, **k: size.append((name, out := real(df, name, **k))) or out
    try:
        judged = quality_bayes.judged(docs, labels, *quality_bayes.source_site())
    finally:
        quality_bayes.stored = real
    assert next(df for name, df in size if name == "quality-train").count() == 320
    got = judged.filter("doc_id <> 3").select("doc_id", "keep").collect()
    right = sum(r["keep"] == (r["doc_id"] % 4 != 0) for r in got)
    assert right / len(got) > 0.95 and judged.count() == len(made)


def test_group_of_near_copies_equals_all_pairs(spark, monkeypatch):
    """Texts with places of their own changed, around the threshold: classes are those of all pairs."""
    rng = random.Random(11)
    words = _vocabulary(rng, 3000)
    base = [rng.choice(words) for _ in range(100)]

    def changed(n, of):
        out = list(of)
        for p in rng.sample(range(100), n):
            out[p] = rng.choice(words)
        return out

    texts = [changed(rng.choice([0, 1, 2, 3, 4, 5, 6, 8]), base) for _ in range(130)]
    family = changed(6, base)  # a family of its own within the group, linked inside and not to the rest
    texts += [changed(rng.choice([0, 1]), family) for _ in range(15)]
    texts += [[rng.choice(words) for _ in range(100)] for _ in range(20)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")

    def shingles(t):
        return {tuple(t[i : i + 5]) for i in range(len(t) - 4)}

    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        common_ = len(sets[i] & sets[j])
        if common_ >= 0.8 * (len(sets[i]) + len(sets[j]) - common_):
            parent[find(j)] = find(i)
    want = Counter(frozenset(k for k in range(len(texts)) if find(k) == r) for r in range(len(texts)) if find(r) == r)
    pairs = []
    real = order_minhash._overlapping
    monkeypatch.setattr(order_minhash, "_overlapping", lambda entries: pairs.append(out := common.stored(real(entries), "seen", keep=True)) or out)
    got = {}
    for r in order_minhash.near_duplicates(docs).collect():
        got.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert Counter(map(frozenset, got.values())) == want
    assert len(want) > 40 and pairs[0].count() < 400  # of about 10,000


def test_families_of_one_group_meet_once_and_equal_all_pairs(spark, monkeypatch):
    """Families that share a long passage, of texts of several lengths: the hubs of a group share members, and each text is compared once."""
    rng = random.Random(23)
    words = _vocabulary(rng, 3000)
    passage = [rng.choice(words) for _ in range(90)]
    texts = []
    for _ in range(4):
        family = passage + [rng.choice(words) for _ in range(rng.choice([15, 30, 45]))]
        for _ in range(40):
            text = list(family[: rng.randint(len(family) - 12, len(family))])
            for p in rng.sample(range(len(text)), rng.randint(0, 5)):
                text[p] = rng.choice(words)
            texts.append(text)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        common_ = len(sets[i] & sets[j])
        if common_ >= 0.8 * (len(sets[i]) + len(sets[j]) - common_):
            parent[find(j)] = find(i)
    tables = {}
    real = order_minhash.stored

    def seen(df, name, **k):
        out = tables[name] = real(df, name, keep=True)
        return out

    monkeypatch.setattr(order_minhash, "stored", seen)
    got = {}
    for r in order_minhash.near_duplicates(docs).collect():
        got.setdefault(r["class_id"], set()).add(r["doc_id"])
    want = Counter(frozenset(k for k in range(len(texts)) if find(k) == r) for r in range(len(texts)) if find(r) == r)
    assert Counter(map(frozenset, got.values())) == want
    members = tables["open-members"]
    assert members.count() == members.select("rep").distinct().count() > 100
    assert tables["open-entries"].count() > 3 * members.count()  # each text is a member of several hubs


def test_model_without_training_texts_gives_every_text_probability_one(spark):
    held = next(i for i in range(100) if brown_lm is not None and __import__("zlib").crc32(str(i).encode()) % 10 == 0)
    docs = spark.createDataFrame([(held, "some words of a held out text"), (held, None)], "doc_id long, text string")
    for r in brown_lm.lm_scores(docs).collect():
        assert (r["score"], r["base_score"], r["n_known"], r["train_tokens"], r["held_out"]) == (0.0, 0.0, 0, 0, True)


def test_wrong_splice_changes_the_count(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    rng = random.Random(9)
    text = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 14))) for _ in range(4000))
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    right = len(tokenizer.encode(text, add_special_tokens=False).ids)
    count = overlap_tokens.Counter(tokenizer, True, chunk=4096, overlap=256)
    assert count.counts([text.encode()]) == [right]
    count.splice = lambda data, begin, at: at + 1 if data[at + 1 : at + 2] != b" " else at + 2
    assert count.counts([text.encode()]) != [right]

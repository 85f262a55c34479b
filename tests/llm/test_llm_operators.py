"""The operators of lakeshift.llm against brute force on small tables, with nulls, empties, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeshift.llm import (
    brown_lm,
    chat_format,
    crf_pii,
    digest_dedup,
    extendible_sharding,
    order_minhash,
    overlap_tokens,
    quality_bayes,
    source_mixing,
    spaced_decontam,
    textnum,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, run int, row_id string, doc string, leaf string, value long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = [prose(rng, rng.choice((3, 8, 60, 200))) for _ in range(40)]
    near = [b.split() for b in base if len(b.split()) > 50][:6]
    for w in near:
        w[7] = "changed"
    odd = [None, "", " \t\n", "Ünï cödé  A", "x" * 30000, "a b " * 9000]
    texts = [*odd, *base, *base[:9], *[" ".join(w) for w in near], base[3].replace(" ", "\n ")]
    out = [(i, t, "en", rng.choice(("s1", "s2", None)), 0, 1, "r", "d", "l", 2) for i, t in enumerate(texts)]
    return [*out, out[8], out[8], (None, base[0], None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def squeezed(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


def test_exact_dedup(docs, empty, rows):
    got = digest_dedup.exact_dedup(docs).collect()
    groups = {}
    for r in rows:
        groups.setdefault(squeezed(r[1]), []).append(r)
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        members = by_sha[r.text_sha256]
        best = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        assert (r.group_size, r.keep_id) == (len(members), best[0])
    assert sum(r.kept for r in got) == len(groups)
    assert digest_dedup.exact_dedup(empty).count() == 0


def reshared(sizes, weights, total):
    target, open_, left = {}, set(sizes), total
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > 2 * sizes[s]}
        if not full:
            return target | {s: unit * weights[s] for s in open_}
        target |= {s: 2 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def test_mixing(docs, empty, rows):
    got = source_mixing.mixed(docs).collect()
    size = Counter()
    for r in rows:
        size[r[3]] += len((r[1] or "").encode().split())
    names = [*sorted(s for s in size if s is not None), None]
    target = reshared(size, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(size.values()))
    taken, largest = Counter(), Counter()
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r.doc_id]
        assert r.target == pytest.approx(target[s]) and r.source_size == size[s]
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in names)
    mix = source_mixing.mixture(docs)
    assert mix.columns == docs.columns
    assert mix.agg(F.sum(source_mixing.word_count())).first()[0] == sum(taken.values())
    assert source_mixing.mixed(empty).count() == 0 and source_mixing.mixture(empty).count() == 0


def test_sharding(spark, docs, empty, rows):
    limit = 4000
    out = extendible_sharding.sharded(docs, limit)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() == len(rows)
    size = F.sum(extendible_sharding.n_bytes()).alias("b")
    shards = out.groupBy("shard").agg(size, F.count("*").alias("n"), F.first("shard_bytes").alias("sb")).collect()
    assert all(s.b == s.sb and (s.b <= limit or s.n == 1) for s in shards)
    names = [s.shard for s in shards]
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    assert extendible_sharding.shard_ids(empty, limit).count() == 0
    same = spark.range(600).select(F.lit(5).cast("long").alias("doc_id"), F.repeat(F.lit("ab "), 100).alias("text"))
    split = extendible_sharding.shard_ids(same, limit).groupBy("shard").agg(F.sum("n_bytes").alias("b")).collect()
    assert len(split) > 40 and max(s.b for s in split) <= limit


def test_chat_round_trip(spark):
    hostile = "a\\<|end|>\\\\[INST]</s><s>\\|[/INST]<|turn|>x<|text|><|also|>\n"
    turns = [
        (1, 0, "user", hostile),
        (1, 1, "user", None),
        (1, 2, "assistant", hostile),
        (1, 3, "assistant", ""),
        (1, 4, None, "é\U0001f600"),
        (2, 0, "assistant", "only"),
        (None, 0, "<|end|>", "x"),
        (1, 2, "assistant", "tie"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.chat_digests(df).collect()}
    for c in (1, 2, None):
        mine = sorted((t, r or "", x or "") for i, t, r, x in turns if i == c)
        assert got[c].n_turns == len(mine)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest()
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    text = chat_format.formatted(df).filter("conv_id = 1").first().formatted
    assert not re.search(r"</?s>|\[/?INST\]", text) and text.count("<|turn|>") == 3 and got[1].n_blocks == 3
    many = spark.range(700).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.col("id").cast("string").alias("text"),
    )
    loss = "".join(str(i) for i in range(700) if i % 3)
    assert chat_format.chat_digests(many).first().loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.chat_digests(df.limit(0)).count() == 0


def test_words_and_hashes():
    texts = ["Hello  the world\tA", "", None, "x", "é the hello", "w" * 50]
    seen = {}
    for block in (8, 1 << 20):
        for a, _, data, offsets in textnum.slices(pa.array(texts), block):
            s, e, r = textnum.words(data, offsets)
            found = [bytes(data[i:j]).lower() for i, j in zip(s, e, strict=True)]
            for w, h, row in zip(found, textnum.word_hashes(data, s, e).tolist(), r, strict=True):
                assert seen.setdefault(w, h) == h and w in (texts[a + row] or "").encode().lower().split()
    assert len(set(seen.values())) == len(seen) == 7


def test_token_counts_are_those_of_whole_texts(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    odd = ["a\x1cd\x85e don't I'LL <|endoftext|>x", "x" * 9000, "ab. " * 4000, "中" * 5000, "́ é Σσ 12", ""]
    count = overlap_tokens.Counter(t, True, chunk=2000, overlap=16)
    assert count.counts([x.encode() for x in odd]) == [len(t.encode(x, add_special_tokens=False).ids) for x in odd]
    assert count.widened
    want = {r.doc_id: len(t.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()}
    for r in overlap_tokens.token_counts(docs).collect():
        assert r.n_tokens == want[r.doc_id] and r.over_limit == (r.n_tokens > 2048)
    assert overlap_tokens.token_counts(empty).count() == 0


def test_decontamination(spark, docs, empty):
    rng = random.Random(1)
    items = [(i, prose(rng, n)) for i, n in enumerate((15, 40, 30, 8, 3))] + [(9, None), (None, "a b"), (8, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    subs = items[1][1].split()
    subs[5] = subs[20] = subs[31] = "zz"
    extra = [
        (500, "Start. " + items[0][1].upper() + "! end"),
        (501, prose(rng, 90) + " " + " ".join(subs)),
        (502, prose(rng, 100)),
        (502, items[2][1]),
        (503, None),
    ]
    test = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    found = Counter(r.doc_id for r in spaced_decontam.contamination(test, bench).filter("contaminated").collect())
    assert found == {500: 1, 501: 1, 502: 1}
    assert spaced_decontam.decontaminated(test, bench).count() == test.count() - 3
    assert spaced_decontam.decontaminated(docs, bench.limit(0)).columns == docs.columns
    assert spaced_decontam.contamination(empty, bench).count() == 0


def test_a_run_is_not_diluted_by_what_follows(spark):
    rng = random.Random(6)
    for _ in range(300):
        equal = np.array([rng.random() < 0.75 for _ in range(rng.randint(1, 40))])
        runs = [equal[i:j] for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)]
        assert spaced_decontam.most_equal(equal, 0.8) == max((int(x.sum()) for x in runs if 5 * x.sum() >= 4 * len(x)), default=0)
    assert spaced_decontam.most_equal(np.zeros(0, bool), 0.8) == 0
    item = [f"w{i}" for i in range(108)]
    same = {1: "e" * 13 + "xeexeexeee" * 3, 2: "e" * 20 + "xeee" * 22, 3: "e" * 12 + "x"}
    texts = [(k, " ".join(w if c == "e" else "zz" for w, c in zip(item, p, strict=False))) for k, p in same.items()]
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    out = spaced_decontam.contamination(spark.createDataFrame(texts, "doc_id long, text string"), bench)
    assert {r.doc_id: r.contaminated for r in out.collect()} == {1: True, 2: True, 3: False}


def test_case_and_punctuation_of_any_script_do_not_hide_a_passage(spark):
    text = "¿Où est l’élève? Die große Straße führt «über» den Fluß – ΟΔΟΣ és Čeština, naïve Übung; हिन्दी शब्द"
    plain = "où est l élève die große straße führt über den fluß οδος és čeština naïve übung हिन्दी शब्द"
    copies = [
        text,
        text.upper(),
        plain,
        plain.title(),
        unicodedata.normalize("NFD", text),
        plain.replace(" ", "\u00a0"),
        " ".join(f"“{w}”—" for w in plain.split()),
        text.replace("große", "gro\u00adße"),
    ]
    hashes = [[h.tolist() for _, h, _ in spaced_decontam._hashed(pa.array(["x y", t, ""]))] for t in copies]
    assert all(h == hashes[0] for h in hashes) and len(hashes[0][0]) == 2 + len(plain.split())
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    docs = spark.createDataFrame([*enumerate(copies), (99, "é " * 40)], "doc_id long, text string")
    found = {r.doc_id for r in spaced_decontam.contamination(docs, bench).filter("contaminated").collect()}
    assert found == set(range(len(copies)))


def test_every_item_and_every_run_of_the_rule_is_searched(spark):
    rng = random.Random(8)
    for n, misses in [(13, 0), (14, 1), (15, 2), (16, 3), (17, 3), (18, 3), (20, 4)]:
        for at in combinations(range(1, n - 1), misses):
            assert any(all(m[i] == "0" or p + i not in at for i in range(len(m))) for m in spaced_decontam.MASKS for p in range(n - len(m) + 1)), at
    items = [(None, prose(rng, 30)), (None, prose(rng, 30)), (4, prose(rng, 30)), (4, prose(rng, 30)), (5, prose(rng, 16))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    missed = " ".join("zz" if i in (6, 8, 11) else w for i, w in enumerate(items[4][1].split()))
    texts = [items[0][1], items[1][1] + " " + items[2][1], items[3][1] + " " + items[2][1], missed, prose(rng, 30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_ids) for r in spaced_decontam.contamination(docs, bench).collect()}
    assert got == {0: (True, 1, ""), 1: (True, 2, "4"), 2: (True, 1, "4"), 3: (True, 1, "5"), 4: (False, 0, "")}


def test_near_duplicates(docs, empty, rows):
    got = order_minhash.near_duplicates(docs).collect()
    shingles = {}
    for r in rows:
        w = (r[1] or "").encode().lower().split()
        seen, out = Counter(), []
        for i in range(max(1, len(w) - 4)):
            g = tuple(w[i : i + 5])
            out.append((g, seen[g]))
            seen[g] += 1
        shingles[r[0]] = set(out)
    ids = list(shingles)
    parent = {i: i for i in ids}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = shingles[a], shingles[b]
            if len(x & y) >= 0.8 * len(x | y):
                parent[root(a)] = root(b)
    assert all((root(a.doc_id) == root(b.doc_id)) == (a.class_id == b.class_id) for a in got for b in got)
    assert sum(r.kept for r in got) == len({r.class_id for r in got})
    out = order_minhash.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == len({r.class_id for r in got})
    assert order_minhash.near_duplicates(empty).count() == 0


def test_alignment_is_sensitive_to_order():
    x = np.arange(200)
    assert order_minhash.similarity(x, x) == 1.0 and order_minhash.similarity(x, np.roll(x, 100)) < 0.8
    assert order_minhash.similarity(x, np.delete(x, [5, 50])) == pytest.approx(0.99)


def test_language_model(docs, empty, rows):
    def fold(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0

    got = brown_lm.lm_scores(docs).collect()
    counts = Counter()
    for r in rows:
        if not fold(r[0]):
            counts.update((r[1] or "").encode().lower().split())
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        w = [*(texts[r.doc_id] or "").encode().lower().split(), None]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        known = sum(counts[x] > 0 for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(w), known, n, fold(r.doc_id))
        assert r.base_score == pytest.approx(base) and r.score <= 1e-9
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert brown_lm.lm_scores(empty).count() == 0


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(0)
    n = np.zeros((41, 41))
    for a in range(1, 41):
        for b in range(1, 41):
            n[a, b] = rng.poisson(20 if a % 2 != b % 2 else 0.2)
    classes = np.concatenate([[0], 1 + np.arange(40) // 20])

    def side(m, c):
        return np.stack([m[:, c == k].sum(1) for k in range(brown_lm.CLASSES)], 1)

    def bigrams(c):
        g = np.zeros((brown_lm.CLASSES, brown_lm.CLASSES))
        np.add.at(g, c, side(n, c))
        return g

    new = brown_lm.exchange(side(n.T, classes), side(n, classes), classes, np.arange(1, 41))
    assert brown_lm.likelihood(bigrams(new)) > brown_lm.likelihood(bigrams(classes))


def test_base_patterns_match_the_plain_expressions():
    rng = random.Random(3)
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for _ in range(5000):
        t = "".join(rng.choice("0123456789.@+- ()aZ_%\n") for _ in range(rng.randint(0, 40)))
        want = [(k, m.start(), m.end()) for k in crf_pii.KINDS for m in re.finditer(plain[k], t) if crf_pii.valid(k, m[0])]
        assert crf_pii.base_spans(t) == want


def test_personal_data(spark, empty):
    field = crf_pii.train(crf_pii.labelled_table())
    held = crf_pii.labelled_table(200, seed=77)
    found = crf_pii.added_spans(field, [t for t, _ in held], [[] for _ in held])
    hits = sum(len(set(s) & set(f)) for (_, s), f in zip(held, found, strict=True))
    assert hits >= 0.85 * sum(len(s) for _, s in held) and hits >= 0.95 * sum(map(len, found))
    text = "call 4111111111111111 4111111111111111 now, mail a.b@c.org or +1 (523) 555-1055 from 10.2.3.4."
    df = spark.createDataFrame([(1, text), (2, None), (2, "plain words"), (None, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in crf_pii.personal_data(df).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 0, 1)
    assert "card:5:21" in got[1].spans and "card:22:38" in got[1].spans
    assert got[2].spans == "" and got[None].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert crf_pii.personal_data(empty).count() == 0


def test_long_sequences_are_decoded_whole():
    field = crf_pii.train(crf_pii.labelled_table())
    rng = random.Random(2)
    for n in (96, 97, 98, 99, 100, 101, 199):
        text = " ".join(["12,"] * n + ["(555) 123-4567", *["12,"] * 30])
        at = text.index("(")
        assert crf_pii.added_spans(field, [text], [[]]) == [[("phone", at, at + 14)]], n
    words = [rng.choice(("12,", "(555)", "123-4567", "1.2.3.4", "a@b", "x", "4111")) for _ in range(350)]
    assert [f for a in range(0, 350, 40) for f in crf_pii.word_features(words, a, a + 40)] == crf_pii.word_features(words)
    many = [words[: rng.randint(1, 350)] for _ in range(40)]
    for w, tags in zip(many, field.viterbi(many), strict=True):
        e = field.emissions([crf_pii.word_features(w)])[0][0]
        best, backs = field.start + e[0], []
        for x in e[1:]:
            backs.append((best[:, None] + field.trans).argmax(0))
            best = (best[:, None] + field.trans).max(0) + x
        path = [int(best.argmax())]
        for b in reversed(backs):
            path.append(int(b[path[-1]]))
        assert tags == path[::-1]
    lengths = sorted(rng.choice((3, 50, 5000, 300_000, 500_000)) for _ in range(300))
    cut = list(crf_pii.batches_of(lengths, 100))
    assert [i for a, b in cut for i in range(a, b)] == list(range(300))
    assert all(b - a <= 100 and (b - a == 1 or (b - a) * lengths[b - 1] <= crf_pii.CELLS) for a, b in cut)


def test_all_matches_of_a_tagged_run_are_tried():
    def exact(kind, text):
        return [text[a:b] for a, b in crf_pii.exact_spans(kind, text, [m.span() for m in crf_pii.WORD.finditer(text)])]

    assert exact("card", "4111111111111112 4111111111111111 4111 1111 1111 1111") == ["4111111111111111", "4111 1111 1111 1111"]
    assert exact("ip", "999.1.1.1 10.2.3.4,10.2.3.5") == ["10.2.3.4", "10.2.3.5"]
    assert exact("phone", "(555) 123-4567 (555) 987-6543 12") == ["(555) 123-4567", "(555) 987-6543 12"]
    assert exact("phone", "555-123-4567 555-987-6543 555-987-6544") == ["555-123-4567", "555-987-6543", "555-987-6544"]
    assert exact("phone", "1234567890123456 555-123-4567") == ["555-123-4567"] and exact("phone", "12 34") == []
    assert exact("email", "x" * 90 + " [at] home.org") == ["x" * 90 + " [at] home.org"] and exact("email", "y" * 50_000) == []
    assert crf_pii.shape("ab12-" * 9 + "4111") != crf_pii.shape("ab12-" * 9 + "word") and crf_pii.shape("aaaaaaB12345é") == "aaaaA9999a"
    assert crf_pii.shape("ab1-" * 50 + "1") != crf_pii.shape("ab1-" * 50 + "a")

    class Tags:
        def viterbi(self, batch):
            return [[crf_pii.TAGS.index("B-card"), *[crf_pii.TAGS.index("I-card")] * (len(x) - 1)] for x in batch]

    text = "4111111111111112 4111111111111111 5500005555555559"
    assert crf_pii.added_spans(Tags(), [text], [[("card", 17, 33)]]) == [[("card", 34, 50)]]


def test_quality_held_out_accuracy(spark, empty, docs):
    d = "/root/testdata/sf0.1"
    table, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = quality_bayes.fit(table, labels.filter(~fold))
    out = quality_bayes.judged(table, labels, *quality_bayes.source_site(), model=model)
    truth = labels.filter(fold).select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    held = out.join(truth, "doc_id").select("keep", "bad").toPandas()
    assert held.keep[~held.bad].mean() > 0.98 and (~held.keep[held.bad]).mean() > 0.9
    none = labels.limit(0)
    kept = quality_bayes.kept(docs, none, *quality_bayes.source_site())
    assert kept.columns == docs.columns
    assert quality_bayes.kept(empty, none, *quality_bayes.source_site()).count() == 0


def test_near_rows_found_by_bitmaps(spark, monkeypatch):
    """``among`` keeps exactly the named rows: at the edges of a bitmap, over partitions, repeated, absent, and by the join."""
    from lakeshift.llm import order_minhash

    high = 3 << 33
    rows = [0, 1, 7, 8, 32_767, 32_768, 32_769, high, high + 1, high + 32_768]
    sketched = spark.createDataFrame([(r, r + 1) for r in rows], "doc_row long, n long")
    for limit in (order_minhash.BROADCAST_BITMAPS, 0):
        monkeypatch.setattr(order_minhash, "BROADCAST_BITMAPS", limit)
        for wanted in ([], [0], [1, 8], [32_768, 32_768, 5], [32_769, high], rows):
            named = spark.createDataFrame([(w,) for w in wanted], "row long")
            got = sorted(r.doc_row for r in order_minhash.among(sketched, named).collect())
            assert got == sorted(set(wanted) & set(rows))

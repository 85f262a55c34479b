"""corpus_pipeline.run() on a small fixture, stage by stage against brute force over the rows that the stage before handed over."""

import random
import re
from collections import Counter
from itertools import combinations

import corpus_pipeline
from lakeshift.llm import extendible_sharding


def test_pipeline_against_brute_force(spark, tmp, monkeypatch):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(900)]

    def prose(n, extra=()):
        return [rng.choice(extra) if extra and rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(n)]

    def changed(words):
        return [*words[:50], "other", *words[51:]]

    bad = ("vile", "awful", "hateful", "slur")
    items = [prose(20) for _ in range(3)]
    clean = [prose(rng.randint(100, 150)) for _ in range(160)]
    toxic = [prose(rng.randint(100, 150), bad) for _ in range(80)]
    copies = [changed(w) for w in clean[:12]]
    leaks = [prose(60) + items[k % 3] + prose(60) for k in range(9)]
    leaks += [changed(w) for w in leaks[:4]]
    leaky_toxic = [prose(100, bad) + items[0]]
    texts = [" ".join(w) for w in [*clean, *toxic, *copies, *leaks, *leaky_toxic]]
    kinds = ["clean"] * 160 + ["toxic"] * 80 + ["clean"] * 12 + ["clean"] * 13 + ["toxic"]
    rows = [(i, t, "en", f"src{rng.randint(0, 2)}", len(t)) for i, t in enumerate(texts)]
    rows += [(9000, None, "en", "src0", 0), (9001, "", None, None, 0)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(f"{tmp}/documents.parquet")
    labels = [(i, 0 if kinds[i] == "toxic" and i % 2 else 1, int(kinds[i] == "toxic")) for i in range(240) if i % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")

    handed, real = [], corpus_pipeline.stored
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: handed.append((name, real(df, name))) or handed[-1][1])
    last = corpus_pipeline.run(spark, tmp)
    assert [n for n, _ in handed] == ["pipeline-quality-classifier", "pipeline-near-dedup", "pipeline-decontamination", "pipeline-source-mixing"]
    assert all(df.columns == last.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] for _, df in handed)
    quality, unique, decontaminated, mix = ([tuple(r) for r in df.collect()] for _, df in handed)
    final = last.collect()
    by_id = {r[0]: r for r in rows}
    assert all(r == by_id[r[0]] for stage in (quality, unique, decontaminated, mix) for r in stage)

    # Quality: what was planted as toxic goes, labelled or not, all else stays.
    assert sorted(r[0] for r in quality) == sorted(r[0] for r in rows if r[0] >= 9000 or kinds[r[0]] == "clean")

    # Near dedup: one row of each connected component of pairs of at least 0.8 similarity.
    def shingles(text):
        w, seen, out = (text or "").lower().split(), Counter(), set()
        for i in range(max(1, len(w) - 4)):
            g = tuple(w[i : i + 5])
            out.add((g, seen[g]))
            seen[g] += 1
        return out

    sets, parent = {r[0]: shingles(r[1]) for r in quality}, {r[0]: r[0] for r in quality}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in combinations(sets, 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    assert sorted(root(r[0]) for r in unique) == sorted({root(i) for i in sets})
    assert len(quality) - len(unique) == 12 + 4 + 1  # the planted copies, and one of the two empty texts

    # Decontamination: any run of at least 13 equal words and 80 % on any diagonal.
    def overlaps(text):
        w = re.findall(r"[a-z0-9]+", (text or "").lower())
        for t in items:
            for d in range(-len(t), len(w)):
                equal = [0 <= i + d < len(w) and w[i + d] == x for i, x in enumerate(t)]
                if sum(equal) >= 13 and any(
                    sum(equal[i:j]) >= 13 and 5 * sum(equal[i:j]) >= 4 * (j - i) for i in range(len(t)) for j in range(i + 13, len(t) + 1)
                ):
                    return True
        return False

    assert sorted(r[0] for r in decontaminated) == sorted(r[0] for r in unique if not overlaps(r[1]))
    assert len(unique) - len(decontaminated) == 9

    # Mixing: whole documents, at most twice, each source within half a document of its target of 3 : 1 : 2 parts.
    size, taken, largest = Counter(), Counter(), Counter()
    for r in decontaminated:
        n = len((r[1] or "").split())
        size[r[3]] += n
        largest[r[3]] = max(largest[r[3]], n)
    for r in mix:
        taken[r[3]] += len((r[1] or "").split())
    names = [*sorted(s for s in size if s is not None), *([None] if None in size else [])]
    weights, target, left = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {}, 1.5 * sum(size.values())
    while len(target) < len(names):
        rest = [s for s in names if s not in target]
        unit = left / sum(weights[s] for s in rest)
        full = [s for s in rest if unit * weights[s] > 2 * size[s]]
        target |= {s: 2 * size[s] for s in full} or {s: unit * weights[s] for s in rest}
        left -= sum(2 * size[s] for s in full)
    assert {r[0] for r in mix} <= {r[0] for r in decontaminated} and max(Counter(r[0] for r in mix).values()) <= 2
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in names)

    # Sharding: every row with a shard, the shard's bytes those of its rows.
    assert Counter(tuple(r)[:5] for r in final) == Counter(mix)
    shards = last.withColumn("b", extendible_sharding.n_bytes()).groupBy("shard", "shard_bytes").sum("b").collect()
    assert all(s["sum(b)"] == s.shard_bytes <= corpus_pipeline.SHARD_BYTES for s in shards) and len({s.shard for s in shards}) == len(shards)

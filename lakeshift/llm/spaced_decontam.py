"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a run of words: the words under its ones are
hashed together, those under its zeros are ignored, so one or two substituted
words in a passage leave some seed untouched.  Benchmark and documents are
hashed with the same masks; documents drop the hashes that a bitmap of the
benchmark's hashes (of fixed size) excludes, and the rest are joined exactly.
Around every hit the two texts are laid over each other on the hit's diagonal:
a document is contaminated if any run of words there has at least
``min_words`` equal words (all words of a shorter item) and at least
``min_share`` of its words are equal.

Words are case-folded runs of letters, digits and marks of any script in
compatibility composition (NFKC), so case, punctuation, kinds of blanks and
quotes, and the encoding of accents do not hide a passage.  Defined cases: a null or empty text on either side
matches nothing; items of fewer words than the shortest mask spans (7) are
not searched; items are told apart by row, so those of a null id are searched
too (``n_items`` counts null as one id, ``item_ids`` leaves it out); repeated
rows are judged row by row; empty tables give no matches; columns other than
ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm import textnum
from lakeshift.llm.common import stored, temporary, unpacked
from lakeshift.llm.rows import positioned, without
from lakeshift.session import ship_package

#: Words used (1) and ignored (0).  By enumeration some mask fits every run of up to 32 words that meets the rule of 13 words
#: and 80 %; a longer one has a half that meets it too.
MASKS = ("1111011", "11010111", "110011101", "1110100111", "11100101011")
MIN_WORDS = 13
MIN_SHARE = 0.8
#: The bitmap that excludes hashes no benchmark item has: 2**BITMAP_BITS bits, whatever the benchmark's size.
BITMAP_BITS = 25
#: Words kept on either side of a document's hits, so that the overlap can be followed to its ends.
MARGIN = 64


def seed_hashes(h: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(mask number, hashes, positions) of all places where a mask fits into one row."""
    for m, mask in enumerate(MASKS):
        n = len(h) - len(mask) + 1
        if n <= 0:
            continue
        fits = np.flatnonzero(rows[:n] == rows[len(mask) - 1 :])
        out, power = np.full(len(fits), m + 1, np.uint64), 2 * m + 1
        for i, used in enumerate(mask):
            if used == "1":
                power = power * 0x9E3779B97F4A7C15 % (1 << 64)
                out += h[fits + i] * np.uint64(power)
        yield m, textnum.mixed(out), fits


def _hashed(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for a, _, data, offsets in textnum.slices(texts):
        data, offsets = textnum.one_spelling(data, offsets)
        starts, ends, rows = textnum.words(data, offsets, textnum.PLAIN)
        yield a, textnum.word_hashes(data, starts, ends), rows


def _lists(values: np.ndarray, cuts: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int64()))


ITEMS = "item_row long, item_id long, words array<long>, seeds array<struct<hash:long,at:int>>"
REGION_NAMES = ["doc_row", "doc_id", "start", "words", "hits"]
REGION_WORDS = pa.list_(pa.int64())
REGION_HITS = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32())]))
REGIONS = "doc_row long, doc_id long, start int, words array<long>, hits array<struct<hash:long,at:int>>"


def _seed_lists(hash_: np.ndarray, at: np.ndarray, cuts: list[int]) -> pa.Array:
    pairs = pa.StructArray.from_arrays([pa.array(hash_.view(np.int64)), pa.array(at.astype(np.int32))], ["hash", "at"])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pairs)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, h, rows in _hashed(batch.column("text")):
            seeds = list(seed_hashes(h, rows))
            for r in np.unique(rows):
                lo, hi = np.searchsorted(rows, [r, r + 1])
                found = [(x[i], p[i] - lo) for _, x, p in seeds for i in [slice(*np.searchsorted(p, [lo, hi]))]]
                x, p = (np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.zeros(0, np.uint64), np.zeros(0, int))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(a + r, 1) for c in ("item_row", "item_id")], _lists(h[lo:hi].view(np.int64), [0, hi - lo]), _seed_lists(x, p, [0, len(x)])],
                    ["item_row", "item_id", "words", "seeds"],
                )


def bench_bitmap(seeds: DataFrame) -> np.ndarray:
    """Bits of the hash prefixes that occur: 4 MB at any size of the benchmark, gathered in blocks of 8 KB."""
    block = 1 << 16
    slot = F.shiftrightunsigned("hash", 64 - BITMAP_BITS)

    def bits_of_block(key, pdf):
        out = np.zeros(block, bool)
        out[pdf["bit"].to_numpy()] = True
        return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(out, bitorder="little").tobytes()]})

    by_block = (
        seeds.select(F.shiftright(slot, 16).cast("int").alias("block"), (slot % block).cast("int").alias("bit"))
        .distinct()
        .groupBy("block")
        .applyInPandas(bits_of_block, "block int, bits binary")
    )
    out = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for b in by_block.toLocalIterator():
        out[b.block * block // 8 : (b.block + 1) * block // 8] = np.frombuffer(b.bits, np.uint8)
    return out


def _regions(bitmap) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in batches:
            doc_row, doc_id = batch.column("doc_row").to_numpy(), batch.column("doc_id")
            # One row for every document, so that its id is known beside the regions, and one for each region.
            none = pa.nulls(len(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_row"), doc_id, none.cast(pa.int32()), none.cast(REGION_WORDS), none.cast(REGION_HITS)], REGION_NAMES
            )
            for a, h, rows in _hashed(batch.column("text")):
                hash_, at = [], []
                for _, x, p in seed_hashes(h, rows):
                    slot = x >> np.uint64(64 - BITMAP_BITS)
                    keep = (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    hash_.append(x[keep])
                    at.append(p[keep])
                if not hash_ or not sum(map(len, at)):
                    continue
                hash_, at = np.concatenate(hash_), np.concatenate(at)
                order = np.argsort(at, kind="stable")
                hash_, at = hash_[order], at[order]
                # Hits further apart than two margins, or in another document, are regions of their own.
                new = np.flatnonzero((np.diff(at) > 2 * MARGIN) | (np.diff(rows[at]) != 0)) + 1
                cuts = np.concatenate([[0], new, [len(at)]])
                row = rows[at[cuts[:-1]]]
                first, last = np.searchsorted(rows, row), np.searchsorted(rows, row + 1)
                lo = np.maximum(first, at[cuts[:-1]] - MARGIN)
                hi = np.minimum(last, at[cuts[1:] - 1] + MARGIN)
                within = at - np.repeat(lo, np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_row[a + row]),
                        doc_id.take(pa.array(a + row)),
                        pa.array((lo - first).astype(np.int32)),
                        _lists(
                            np.concatenate([h[i:j] for i, j in zip(lo, hi, strict=True)]).view(np.int64),
                            np.concatenate([[0], np.cumsum(hi - lo)]).tolist(),
                        ),
                        _seed_lists(hash_, within, cuts.tolist()),
                    ],
                    REGION_NAMES,
                )

    return run


def most_equal(equal: np.ndarray, min_share: float) -> int:
    """The most equal words that any run holds of which at least ``min_share`` are equal."""
    share = Fraction(min_share).limit_denominator(10_000)
    total = np.concatenate([[0], np.cumsum(np.where(equal, share.denominator, 0) - share.numerator)])
    count = np.concatenate([[0], np.cumsum(equal)])
    # A run may end at j and begin at i if total[i] <= total[j]; the first such i is where the running minimum gets there.
    first = np.searchsorted(-np.minimum.accumulate(total), -total)
    return int((count - count[first]).max())


def _hit_diagonals(hits: tuple, seeds: tuple, n_words: int, n_item: int) -> np.ndarray:
    """The diagonals (place in the text less place in the item) on which a hit and a seed of equal hash lie."""
    (hash_, at), (seed, item_at) = hits, seeds
    order = np.argsort(hash_, kind="stable")
    hash_, at = hash_[order], at[order]
    marked = np.zeros(n_words + n_item + 1, bool)
    lo, hi = np.searchsorted(hash_, seed, "left"), np.searchsorted(hash_, seed, "right")
    for i, j, q in zip(lo.tolist(), hi.tolist(), item_at.tolist(), strict=True):
        marked[at[i:j] - q + n_item] = True
    return np.flatnonzero(marked) - n_item


def best_overlap(words: np.ndarray, item: np.ndarray, diagonals: np.ndarray, least: int, min_share: float) -> int:
    """The most equal words of a run on any of the ``diagonals`` (0: fewer than ``least`` on all)."""
    equal = np.zeros(len(diagonals), np.int64)
    for p in range(len(item)):
        at = diagonals + p
        inside = (at >= 0) & (at < len(words))
        equal += inside & (words[np.where(inside, at, 0)] == item[p])
    best = 0
    # A run holds no more equal words than its diagonal.
    for k in np.argsort(-equal, kind="stable"):
        if equal[k] < least or equal[k] <= best:
            break
        d = int(diagonals[k])
        lo, hi = max(0, -d), min(len(item), len(words) - d)
        best = max(best, most_equal(words[lo + d : hi + d] == item[lo:hi], min_share))
    return best if best >= least else 0


def _pairs_of(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for value in column:
        yield value.values.field("hash").to_numpy(), value.values.field("at").to_numpy().astype(np.int64)


def _verified(min_words: int, min_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, n = [], []
            words, item = batch.column("words"), batch.column("item_words")
            for i, (hits, seeds) in enumerate(zip(_pairs_of(batch.column("hits")), _pairs_of(batch.column("item_seeds")), strict=True)):
                w, t = words[i].values.to_numpy(), item[i].values.to_numpy()
                equal = best_overlap(w, t, _hit_diagonals(hits, seeds, len(w), len(t)), min(min_words, len(t)), min_share)
                if equal:
                    keep.append(i)
                    n.append(equal)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_row").take(pa.array(keep, pa.int64())), batch.column("item_id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int32())],
                ["doc_row", "item_id", "equal_words"],
            )

    return run


def overlaps(
    docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE
) -> tuple[DataFrame, DataFrame]:
    """All rows (doc_row, doc_id) of ``docs`` (doc_row, doc_id, text), and the verified overlaps (doc_row, item_id, equal_words)."""
    spark = docs.sparkSession
    ship_package(spark)
    bench = benchmark.select(F.monotonically_increasing_id().alias("item_row"), F.col("item_id").cast("long").alias("item_id"), "text")
    items = stored(bench.mapInArrow(_items, ITEMS), "bench-items")
    seeds = stored(items.select("item_row", F.explode("seeds").alias("s")).select("s.hash", "item_row", F.col("s.at").alias("item_at")), "bench-seeds")
    shared = spark.sparkContext.broadcast(bench_bitmap(seeds))
    slim = docs.select("doc_row", F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(slim.mapInArrow(_regions(shared), REGIONS), "doc-regions")
    regions = found.filter(F.col("start").isNotNull())
    # Which regions and items have a hash in common; their words are sent once, however many diagonals they meet on.
    hits = regions.select("doc_row", "start", F.explode(F.array_distinct(F.transform("hits", lambda h: h["hash"]))).alias("hash"))
    candidates = hits.join(seeds.select("hash", "item_row").distinct(), "hash").select("doc_row", "start", "item_row").distinct()
    laid = (
        candidates.join(regions.select("doc_row", "start", "words", "hits"), ["doc_row", "start"])
        .join(items.select("item_row", "item_id", F.col("words").alias("item_words"), F.col("seeds").alias("item_seeds")), "item_row")
        .select("doc_row", "item_id", "words", "hits", "item_words", "item_seeds")
    )
    verified = laid.mapInArrow(_verified(min_words, min_share), "doc_row long, item_id long, equal_words int")
    return found.filter(F.col("start").isNull()).select("doc_row", "doc_id"), verified


def contamination(docs: DataFrame, benchmark: DataFrame, **rule) -> DataFrame:
    """(doc_id, contaminated, n_items, equal_words, item_ids) for every row of ``docs``."""
    rows, verified = overlaps(
        docs.select(F.monotonically_increasing_id().alias("doc_row"), "doc_id", "text"), benchmark, **rule
    )
    found = verified.groupBy("doc_row").agg(
        F.countDistinct(F.struct("item_id")).alias("n_items"),
        F.max("equal_words").cast("long").alias("equal_words"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )
    return rows.join(found, "doc_row", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("equal_words", F.lit(0)).cast("long").alias("equal_words"),
        F.coalesce(F.array_join(F.col("item_ids").cast("array<string>"), ","), F.lit("")).alias("item_ids"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **rule) -> DataFrame:
    """The rows of ``docs`` without a verified overlap, columns as they are.

    Rows are told apart by their positions, also those of equal ids.
    """
    whole = positioned(docs, "decontam-docs")
    with temporary(docs.sparkSession):
        slim = whole.select("doc_row", "doc.doc_id", "doc.text")
        found = overlaps(slim, benchmark, **rule)[1].select("doc_row").distinct()
        clean = without(whole, found, "contaminated")
    return unpacked(clean, docs.columns)

"""Near-dedup by order MinHash.

A text is its sequence of five-word shingles, each labelled with its
occurrence number.  For each of ``SKETCHES`` hash functions the ``l`` shingles
of smallest hash are sampled and kept in text order; the hash of that short
sequence is one sketch value.  Two texts agree in a value only if the sampled
shingles and their order agree, so moved passages count as edits.  ``l`` is 2
for short and 6 for long texts; the two kinds overlap, so that any two texts
that can be similar share a kind.

Texts that agree in a value are candidates.  Every candidate pair that is used
is verified by a banded alignment: the longest common subsequence of the
labelled shingles within the band that a similarity of 0.8 leaves, divided by
the shingles of either; 0.8 or more is a link.

No group is compared all with all.  Equal word sequences are one
representative first.  Each bucket then compares its members with one hub (the
member first in one order of all texts, so the buckets of a group share hubs);
a linked pair agrees in at least ``FEWEST`` values but with a probability below
0.001, and pairs with the hub are sorted out by that before their texts are
fetched.  Where this leaves a hub with members of several classes, it makes one
group with the hubs that share members with it.  Its members meet its central
text, and those that still are of another class each other by their differences
from the shingles that most of the group hold: linked ones share so many that
they meet in a short prefix of their rarest ones (exact; near copies that differ
in places of their own do not meet).

Words are split at white space and compared in lower case (A-Z).  Defined
cases: a null text counts as empty; all texts without words are one class; a
text of fewer than five words is one shingle; repeated rows are members of one
class; a null ``doc_id`` never names a class unless all its ids are null; an
empty table gives an empty result; columns other than ``doc_id`` and ``text``
are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.llm import textnum
from lakeshift.llm.common import stored, temporary, unpacked
from lakeshift.llm.graph import components
from lakeshift.llm.rows import BROADCAST_BITMAPS, positioned, without
from lakeshift.session import ship_package

WORDS = 5
SIMILARITY = 0.8
#: Of two texts' shingles together, those that are in common where the similarity is just reached.
SHARE = SIMILARITY / (1 + SIMILARITY)
SKETCHES = 40
#: (shingles sampled, fewest and most shingles of a text): similar texts differ in length by a quarter at most.
KINDS = ((2, 1, 60), (6, 40, 2**62))
#: Values in which two linked texts agree at least, for each kind.
FEWEST = (14, 3)
#: Bytes of text that a task sketches together (numpy holds many times as much meanwhile).
SLICE = 256 << 10

_MULTIPLIERS = np.random.default_rng(20_011).integers(1, 2**63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OCCURRENCE = np.uint64(0x9E3779B97F4A7C15)


def labelled(hash_: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes of (shingle, occurrence number within its row)."""
    order = np.lexsort((hash_, rows))
    h, r = hash_[order], rows[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])) if len(h) else np.zeros(0, int)
    occurrence = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    out = np.empty_like(hash_)
    out[order] = textnum.mixed(h + occurrence.astype(np.uint64) * _OCCURRENCE)
    return out


def sketch(x: np.ndarray, kind: int) -> np.ndarray | None:
    """The sketch values of a text's labelled shingles, or None if the text is not of this kind."""
    take, least, most = KINDS[kind]
    if not least <= len(x) <= most:
        return None
    take = min(take, len(x))
    picked = np.empty((SKETCHES, take), np.int64)
    step = max(1, (1 << 20) // len(x))
    for a in range(0, SKETCHES, step):
        h = x[None, :] * _MULTIPLIERS[a : a + step, None]
        picked[a : a + step] = np.argpartition(h, take - 1, axis=1)[:, :take] if take < len(x) else np.arange(take)
    picked.sort(axis=1)
    value = np.arange(SKETCHES, dtype=np.uint64) + np.uint64(1000 * kind + 1)
    for i in range(take):
        value = textnum.mixed(value * np.uint64(31) + x[picked[:, i]])
    return value


SKETCHED = "doc_row long, doc_id long, text_key binary, n int, kind0 array<long>, kind1 array<long>, shingles array<int>"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in textnum.slices(batch.column("text"), SLICE):
            starts, ends, rows = textnum.words(data, offsets)
            h, at = textnum.shingles(textnum.word_hashes(data, starts, ends, SLICE), rows, WORDS)
            rows = rows[at]
            x = labelled(h, rows)
            cuts = np.searchsorted(rows, np.arange(b - a + 1))
            each = [x[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
            kinds = [[None if (v := sketch(s, k)) is None else v.view(np.int64) for s in each] for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_row").slice(a, b - a),
                    batch.column("doc_id").slice(a, b - a),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in each], pa.binary()),
                    pa.array([len(s) for s in each], pa.int32()),
                    *[pa.array(v, pa.list_(pa.int64())) for v in kinds],
                    pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array((x >> np.uint64(32)).astype(np.uint32).view(np.int32))),
                ],
                ["doc_row", "doc_id", "text_key", "n", "kind0", "kind1", "shingles"],
            )


def similarity(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> float:
    """Banded alignment: common subsequence of the labelled shingles over the shingles of either.

    A pair of similarity ``least`` leaves so many shingles unmatched that no
    matched one is displaced beyond the band; pairs below it may come out lower.
    """
    band = (1 - 2 * least / (1 + least)) * (len(x) + len(y)) + 1
    if min(len(x), len(y)) < least * max(len(x), len(y)):
        return 0.0
    _, i, j = np.intersect1d(x, y, return_indices=True)
    near = np.abs(i - j) <= band
    j = j[near][np.argsort(i[near])]
    length = len(j)
    if length < 2 * least / (1 + least) / 2 * (len(x) + len(y)):
        return length / max(1, len(x) + len(y) - length) if length else 0.0
    if (np.diff(j) <= 0).any():
        tails: list[int] = []
        for p in j.tolist():
            k = bisect_left(tails, p)
            tails[k : k + 1] = [p]
        length = len(tails)
    return length / max(1, len(x) + len(y) - length)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        xs, ys = (batch.column(c) for c in ("x", "y"))
        (xv, xo), (yv, yo) = ((c.flatten().to_numpy(), c.offsets.to_numpy() - c.offsets[0].as_py()) for c in (xs, ys))
        s = [similarity(xv[xo[i] : xo[i + 1]], yv[yo[i] : yo[i + 1]]) for i in range(len(batch))]
        keep = pa.array([v >= SIMILARITY - 1e-12 for v in s], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _agreements(x: str, y: str) -> list[Column]:
    """For each kind, which sketch values of the columns ``kind{k}{x}`` and ``kind{k}{y}`` are equal (null: not of this kind)."""
    return [F.zip_with(f"kind{k}{x}", f"kind{k}{y}", lambda p, q: p == q) for k in range(len(KINDS))]


def _enough(agree: list[Column]) -> Column:
    """Whether two texts agree in as many values as linked ones do."""
    counts = [F.size(F.filter(agree[k], lambda e: e)) >= FEWEST[k] for k in range(len(KINDS))]
    return F.coalesce(counts[0], F.lit(False)) | F.coalesce(counts[1], F.lit(False))


def among(sketched: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of ``sketched`` whose position is the one column of ``rows``, sorted out before any shuffle.

    Positions are dense within a scan partition, so one 4 KiB bitmap stands for
    up to 32,768 of them, exactly.  Beyond ``BROADCAST_BITMAPS`` (about 5e8
    documents) the rows are found by a shuffled join.
    """
    row = F.col(rows.columns[0])
    bitmaps = stored(
        rows.groupBy(F.bitmap_bucket_number(row).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(row)).alias("bits")),
        "bitmaps",
    )
    if bitmaps.count() > BROADCAST_BITMAPS:
        return sketched.join(rows.select(row.alias("doc_row")).distinct(), "doc_row", "left_semi")
    byte = F.expr("conv(hex(substring(bits, cast(bitmap_bit_position(doc_row) div 8 as int) + 1, 1)), 16, 10)").cast("int")
    bit = F.call_function("shiftright", byte, F.expr("cast(bitmap_bit_position(doc_row) % 8 as int)")).bitwiseAND(F.lit(1)) == 1
    return sketched.join(F.broadcast(bitmaps), F.bitmap_bucket_number("doc_row") == F.col("bucket")).filter(bit).select(sketched.columns)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("row"))


def promising(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs (a, b) that agree in enough sketch values; compares sketches, which are much smaller than texts."""
    sketched = among(sketched, _ends(pairs))
    of = lambda c: sketched.select(F.col("doc_row").alias(c), *[F.col(f"kind{k}").alias(f"kind{k}_{c}") for k in range(len(KINDS))])
    return pairs.join(of("a"), "a").join(of("b"), "b").filter(_enough(_agreements("_a", "_b"))).select("a", "b")


def verified(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs (a, b) whose alignment reaches the similarity."""
    sketched = among(sketched, _ends(pairs))
    of = lambda who, what: sketched.select(F.col("doc_row").alias(who), F.col("shingles").alias(what))
    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").mapInArrow(_linked, "a long, b long")


def _open_entries(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(hub, rep, comp) of the hubs whose members are of several classes."""
    own = members.select("hub", "rep").distinct().join(comps, F.col("rep") == F.col("node"), "left")
    own = own.select("hub", "rep", F.coalesce("comp", "rep").alias("comp"))
    return stored(_several(own, "hub"), "open-entries")


def _several(rows: DataFrame, by: str) -> DataFrame:
    """The rows whose group ``by`` holds several classes (``comp``)."""
    several = rows.groupBy(by).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
    return rows.join(several.select(by), by, "left_semi")


def _differences(both: DataFrame) -> DataFrame:
    """Open members with their differences from their group's common shingles (``diff``: shingles of one and not of the
    other, told apart by which) and the numbers that bound a link: two linked members share at least q + q' - r differences.

    Members x and y of a group of r common shingles lack l and l' of them.  They have r - l - l' shingles in common,
    plus every difference that they share; a link asks for s / (1 + s) of both texts' shingles in common.
    """
    lacks, adds = F.array_except("h", "x"), F.array_except("x", "h")
    of = lambda a, k: F.transform(a, lambda s: s.cast("long") * 2 + k)
    return both.select("grp", "rep", "comp", "own_comp", "n", "q", "q_own", F.size("h").alias("r"), F.concat(of(lacks, 0), of(adds, 1)).alias("diff"))


def _overlapping(entries: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes and one group whose differences from it may overlap as much as a link asks.

    A prefix join: differences are ordered from rare to frequent; two sets of d and d' elements with at least
    ``need`` in common share one among the first d - need + 1 of either.  The first that they share leaves
    enough behind it.  Members of the center's class (``own_comp``) meet members of others only, others all of another class.

    ``need`` is bounded by the least q that the other side has, and by the member's own: a linked text of n' shingles
    lacks at most n' - s / (1 + s) * (n + n') fewer common shingles, and n' is n / s at most.
    """
    others = F.col("comp") != F.col("own_comp")
    least = entries.filter(others).groupBy("grp").agg(F.min("q").alias("q_least"))
    alike = F.col("q") - (1 - 2 * SHARE) / SIMILARITY * F.col("n")
    need = lambda q: F.ceil(F.col("q") + F.greatest(F.col(q), alike) - F.col("r") - 1e-9)
    sized = entries.join(least, "grp").withColumn("d", F.size("diff"))
    sized = sized.select(
        "grp", "rep", "comp", "q", "r", "d", "diff", others.alias("other"),
        (F.col("d") - F.when(others, need("q_own")).otherwise(need("q_least")) + 1).alias("to_own"),
        F.when(others, F.col("d") - need("q_least") + 1).alias("to_others"),
    )
    each = stored(sized.select("grp", "rep", "other", F.explode("diff").alias("token")), "open-differences")
    # A difference counts that two members have, one of them of another class than the center's.
    held = each.groupBy("grp", "token").agg(F.count("*").alias("holders"), F.count_if("other").alias("others"))
    held = held.filter("holders > 1 AND others > 0").select("grp", "token", (F.col("holders") * F.col("others")).alias("often"))
    ranks = Window.partitionBy("grp", "rep")
    shared = each.drop("other").join(held, ["grp", "token"]).withColumn("place", F.row_number().over(ranks.orderBy("often", "token")))
    shared = shared.withColumn("held", F.count("*").over(ranks))
    # All other differences come first.
    placed = shared.join(sized.drop("diff"), ["grp", "rep"]).withColumn("place", F.col("place") + F.col("d") - F.col("held"))
    placed = stored(placed.filter(F.col("place") <= F.greatest("to_own", "to_others")).drop("held", "often"), "open-prefixes")
    side = lambda rows, s: rows.select("grp", "token", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "comp", "q", "d", "place")], *(["r"] if s == "x" else []))
    foreign = placed.filter("other")
    left = F.col("q_x") + F.col("q_y") - F.col("r") - 1e-9 <= 1 + F.least(F.col("d_x") - F.col("place_x"), F.col("d_y") - F.col("place_y"))
    pairs = [
        side(foreign.filter("place <= to_own"), "x").join(side(placed.filter("NOT other AND place <= to_own"), "y"), ["grp", "token"]).filter(left),
        side(foreign.filter("place <= to_others"), "x").join(side(foreign.filter("place <= to_others"), "y"), ["grp", "token"]).filter(
            (F.col("rep_x") < F.col("rep_y")) & (F.col("comp_x") != F.col("comp_y")) & left
        ),
    ]
    ends = [p.select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b")) for p in pairs]
    return ends[0].unionByName(ends[1]).distinct()


def _bucket_pairs(loose: DataFrame, members: DataFrame, comps: DataFrame, fit: DataFrame) -> DataFrame:
    """Pairs of different classes in one bucket, one end in ``loose`` (rep), that the sketches' agreement leaves."""
    # Only the buckets that hold a loose text.
    values = members.join(loose, "rep", "left_semi").select("value").distinct()
    fitting = stored(members.select("value", "rep").join(values, "value", "left_semi").join(fit, "rep"), "moved-members")
    rows = fitting.join(comps, F.col("rep") == F.col("node"), "left").withColumn("comp", F.coalesce("comp", "rep"))
    side = lambda rows, s: rows.select(*[F.col(c).alias(f"{c}_{s}") for c in ("value", "rep", "comp", "n", "held", "kind0", "kind1")])
    common = F.least("held_x", "held_y")
    agree = _agreements("_x", "_y")
    first = [
        F.coalesce(F.array_position(f"kind{k}_x", F.col("value_x")) == F.array_position(agree[k], F.lit(True)), F.lit(False))
        for k in range(len(KINDS))
    ]
    # A pair is taken in the first bucket that it shares.
    return (
        side(rows.join(loose, "rep", "left_semi"), "x")
        .join(
            side(rows, "y"),
            (F.col("value_x") == F.col("value_y"))
            & (F.col("comp_x") != F.col("comp_y"))
            & (common >= SIMILARITY * (F.col("n_x") + F.col("n_y") - common))
            & (first[0] | first[1])
            & _enough(agree),
        )
        .select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b"))
        .distinct()
    )


def _open_members(members: DataFrame, comps: DataFrame, sketched: DataFrame) -> DataFrame:
    """(grp, rep, comp, n, held, kind0, kind1, x, h, q) of the hubs whose members are of several classes, each member once.

    A text whose shingles other open texts hold too rarely is out.  Hubs that share a member are one group (``grp``),
    so that no text is compared once for each of its hubs; ``x`` are the shingles of the member and ``h`` those that
    more than half of the group's members hold.
    """
    open_ = _open_entries(members, comps)
    texts = stored(among(sketched, open_.select("rep")).select(F.col("doc_row").alias("rep"), "n", "kind0", "kind1", "shingles"), "open-texts")
    each = texts.select("rep", F.explode("shingles").alias("shingle"))
    again = each.groupBy("shingle").agg(F.count("*").alias("c")).filter("c > 1").select("shingle")
    held = each.join(again, "shingle", "left_semi").groupBy("rep").agg(F.count("*").alias("held"))
    fit = stored(texts.join(held, "rep").filter(F.col("held") >= SIMILARITY * F.col("n")), "open-fit")
    kept = stored(_several(open_.join(fit.select("rep"), "rep", "left_semi"), "hub"), "open-kept")
    groups = components(kept.select(F.col("hub").alias("a"), F.col("rep").alias("b")).filter("a <> b"))
    grouped = kept.select("rep", "comp").distinct().join(groups.select(F.col("node").alias("rep"), F.col("comp").alias("grp")), "rep")
    entries = stored(grouped.join(fit.withColumnRenamed("shingles", "x"), "rep"), "open-grouped")
    size = entries.groupBy("grp").agg(F.count("*").alias("size"))
    common = entries.select("grp", F.explode(F.array_distinct("x")).alias("shingle")).groupBy("grp", "shingle").agg(F.count("*").alias("c"))
    common = common.join(size, "grp").filter("2 * c > size").groupBy("grp").agg(F.sort_array(F.collect_list("shingle")).alias("h"))
    whole = entries.join(common, "grp", "left").withColumn("h", F.coalesce("h", F.array().cast("array<int>")))
    return stored(whole.withColumn("q", F.size(F.array_except("h", "x")) + SHARE * F.col("n")), "open-members")


def _centers(open_: DataFrame) -> DataFrame:
    """(grp, center, q_own): each group's member of the least q, which bounds the other members' links the least."""
    first = open_.groupBy("grp").agg(F.min(F.struct("q", "rep")).alias("first"))
    return stored(first.select("grp", F.col("first.rep").alias("center"), F.col("first.q").alias("q_own")), "centers")


def _central_pairs(open_: DataFrame, centers: DataFrame) -> DataFrame:
    """Each open member with its group's center, where their shingles allow a link."""
    center = open_.select(F.col("rep").alias("center"), F.col("x").alias("c"), F.col("comp").alias("center_comp")).join(centers, "center")
    enough = F.size(F.array_intersect("x", "c")) >= SHARE * (F.size("x") + F.size("c")) - 1e-9
    pairs = open_.join(center, "grp").filter(F.col("comp") != F.col("center_comp")).filter(enough)
    return pairs.select(F.least("rep", "center").alias("a"), F.greatest("rep", "center").alias("b")).distinct()


def _open_pairs(open_: DataFrame, centers: DataFrame, members: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs of different classes of one group that the bounds leave, each once.

    Members are compared by their differences from the group's common shingles
    (``_overlapping``), exactly and without a pair per two members.  A text that
    shares as many of them with the center as a link asks and yet is not linked
    to it (moved passages) has no such bound: its pairs are those of its buckets.
    """
    of = lambda c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_of"))
    centers = centers.join(of("center"), "center", "left").select("grp", "q_own", F.coalesce("center_of", "center").alias("own_comp"))
    named = open_.drop("comp").join(of("rep"), "rep", "left").withColumn("comp", F.coalesce("rep_of", "rep"))
    entries = stored(_differences(_several(named, "grp").join(centers, "grp")), "open-differing")
    loose = (F.col("comp") != F.col("own_comp")) & (F.col("q") + F.col("q_own") - F.col("r") <= 1e-9)
    pairs = _overlapping(entries.filter(~loose))
    moved = stored(entries.filter(loose).select("rep").distinct(), "open-moved")
    if moved.limit(1).count():
        fit = open_.select("rep", "n", "held", "kind0", "kind1")
        pairs = pairs.unionByName(_bucket_pairs(moved, members, comps, fit)).distinct()
    return pairs


def _joined(comps: DataFrame, more: DataFrame) -> DataFrame:
    """``comps`` (node, comp) after the links ``more`` (a, b): whole classes are joined, the nodes are the classes so far."""
    if not more.limit(1).count():
        return comps
    as_class = lambda c: F.coalesce(F.col(f"{c}_comp"), F.col(c))
    of = lambda c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp"))
    merged = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(as_class("a").alias("a"), as_class("b").alias("b"))
    top = components(merged)
    into = top.select(F.col("node").alias("of"), F.col("comp").alias("into"))
    joined = (
        comps.unionByName(top.select(F.col("node"), F.col("node").alias("comp")))
        .groupBy("node")
        .agg(F.min("comp").alias("comp"))
        .join(into, F.col("comp") == F.col("of"), "left")
        .select("node", F.coalesce("into", "comp").alias("comp"))
    )
    return stored(joined, "joined-classes")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_row, doc_id, class_row) for ``docs`` (doc_row, doc_id, text): rows of one class have one ``class_row``."""
    ship_package(docs.sparkSession)
    slim = docs.select("doc_row", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = stored(slim.mapInArrow(_sketched, SKETCHED), "sketched")
    groups = stored(sketched.groupBy("text_key").agg(F.min("doc_row").alias("rep")), "texts")
    values = (
        among(sketched, groups.select("rep"))
        .select(F.col("doc_row").alias("rep"), F.explode(F.concat(F.coalesce("kind0", F.array()), F.coalesce("kind1", F.array()))).alias("value"))
    )
    hubs = (
        values.groupBy("value")
        .agg(F.max(F.struct(F.xxhash64("rep").alias("h"), "rep")).alias("hub"), F.count("*").alias("members"))
        .filter("members > 1")
        .select("value", F.col("hub.rep").alias("hub"))
    )
    members = stored(values.join(hubs, "value"), "bucket-members")
    star = members.filter("rep <> hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    star = stored(promising(stored(star, "star-pairs"), sketched), "promising-pairs")
    links = stored(verified(star, sketched), "star-links")
    comps = components(links)
    open_ = _open_members(members, comps, sketched)
    # First all meet the group's central text: what can be linked to it is, and few stay open.
    centers = _centers(open_)
    comps = _joined(comps, stored(verified(stored(_central_pairs(open_, centers), "central-pairs"), sketched), "central-links"))
    open_pairs = stored(_open_pairs(open_, centers, members, comps), "open-pairs")
    more = stored(verified(open_pairs, sketched), "open-links")
    comps = _joined(comps, more)
    rep_class = stored(
        groups.join(comps, F.col("rep") == F.col("node"), "left").select("text_key", F.coalesce("comp", "rep").alias("class_row")), "classes"
    )
    return sketched.select("doc_row", "doc_id", "text_key").join(rep_class, "text_key").drop("text_key")


def _keepers(rows: DataFrame) -> DataFrame:
    """(class_row, class_id, class_size, keep_row): the member with the smallest id, then position, stays."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_row"))
    return rows.groupBy("class_row").agg(first.alias("k"), F.count("*").alias("class_size")).select(
        "class_row", F.col("k.doc_id").alias("class_id"), "class_size", F.col("k.doc_row").alias("keep_row")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, class_size, kept) for every row of ``docs``; the class is named by its smallest ``doc_id``."""
    with temporary(docs.sparkSession):
        rows = stored(classes(docs.select(F.monotonically_increasing_id().alias("doc_row"), "doc_id", "text")), "doc-classes", keep=True)
    keepers = stored(_keepers(rows), "keepers")
    return rows.join(keepers, "class_row").select(
        "doc_id", "class_id", "class_size", (F.col("doc_row") == F.col("keep_row")).alias("kept")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class, columns as they are."""
    whole = positioned(docs, "near-docs")
    with temporary(docs.sparkSession):
        rows = stored(classes(whole.select("doc_row", "doc.doc_id", "doc.text")), "doc-classes")
        keepers = stored(_keepers(rows).filter("class_size > 1"), "keepers")
        drop = rows.join(keepers, "class_row").filter("doc_row <> keep_row").select("doc_row")
        unique = without(whole, drop, "copies")
    return unpacked(unique, docs.columns)

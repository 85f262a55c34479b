"""Mixing sources to target weights.

Every document gets a hash-random key (MD5 of a seed and its ``doc_id``).
Within its source the documents are ordered by that key and a distributed
prefix sum of their word counts says where the source's budget is cut: whole
passes over the source first, then the documents whose words lie within the
rest.  The document on which the cut falls is taken if at least half of it
lies within the budget, so a source misses its target by at most half a
document.

The prefix sum never sorts a source in one task: all rows are range-sorted by
source and key, sums per source and range are prefix-summed, and only the rows
of one range are summed one by one.  A source of any size, and an id that
repeats any number of times, is spread over ranges.

Defined cases: a null text has no words; a null source is a source of its own,
last; documents without words are taken zero words; a table without any word
has targets of 0; rows repeated with the same ``doc_id`` are separate
documents; ties of the key (rows of one id) are broken by size; an empty table
gives an empty result.  Targets are worked out on one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import WORD_PATTERN, stored, temporary, unpacked
from lakeshift.llm.rows import positioned

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"
#: Sources up to this many (about 150 bytes each) are broadcast, else joined.
BROADCAST_SOURCES = 100_000


def word_count(text: Column | None = None) -> Column:
    return F.regexp_count(_text(text), F.lit(WORD_PATTERN)).cast("long")


def _text(text: Column | None = None) -> Column:
    return F.coalesce(F.col("text") if text is None else text, F.lit(""))


def mix_key(doc_id: str = "doc_id") -> Column:
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: its size, target, whole passes and the rest of its budget.

    Weights repeat in the order of the source names.  Resharing the excess of
    full sources by weight until none is above its cap ends where every source
    gets min(cap, level * weight); the level is found from the sources in the
    order of cap / weight.  Works on one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    filling = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = filling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("caps_before", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(upto) + F.col("weight"))
        .withColumn("level", (F.col("total") - F.col("caps_before")) / F.col("weight_left"))
        # The first source whose own level stays below its ratio sets the level of all after it; levels fall from there.
        .withColumn("open_level", F.max(F.when(F.col("level") < F.col("ratio"), F.col("level"))).over(everything))
        .withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("open_level") * F.col("weight"), F.col("cap"))))
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return s.select(
        "source",
        "source_size",
        "target",
        passes.cast("long").alias("passes"),
        (F.col("target") - passes * F.col("source_size")).alias("budget"),
    )


def mix_rows(docs: DataFrame, *also: str) -> DataFrame:
    """Slim rows (doc_id, source, size, key): the only pass over the texts."""
    return docs.select(
        F.col("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size"), mix_key().alias("key"), *also
    )


def lined(rows: DataFrame, *last: str) -> DataFrame:
    """``rows`` (doc_id, source, size, key) range-sorted by (source, key) and stored, with the range (``part``) and the place in it (``at``).

    Ties of the key (rows of one id) go by size, then by the columns ``last`` (by
    position without any), so the rows of an id that repeats are spread over
    ranges, too.
    """
    order = [F.col("source").asc_nulls_first(), "key", "size", *(last or ["salt"])]
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    sorted_ = salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt").withColumn("at", F.monotonically_increasing_id())
    return stored(sorted_.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}), "mix-lined")


def mixed_sizes(rows: DataFrame, **shares) -> DataFrame:
    """``rows`` (see ``lined``) with ``source_size``, ``target`` and ``copies``: how often the mix takes each document.

    ``until`` is the prefix sum of a source's sizes in the order of the keys:
    what the ranges before hold of the source (one row per source and range), and
    a running sum within the range.
    """
    columns = [c for c in rows.columns if c not in ("part", "at")]
    per_range = stored(rows.groupBy("source", "part").agg(F.sum("size").alias("size")), "mix-ranges")
    targets = source_targets(per_range, **shares)
    in_source = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        per_range.select(F.col("source").alias("of"), F.col("part").alias("range"), F.coalesce(F.sum("size").over(in_source), F.lit(0)).alias("before"))
        .join(targets, F.col("of").eqNullSafe(F.col("source")))
        .drop("source")
    )
    in_range = Window.partitionBy("source", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.withColumn("within", F.sum("size").over(in_range)).join(
        ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("range"))
    )
    taken = F.col("before") + F.col("within") - F.col("size") / 2 <= F.col("budget")
    return joined.select(
        *columns,
        "source_size",
        "target",
        "passes",
        (taken & (F.col("budget") > 0) & (F.col("size") > 0)).alias("extra"),
    ).withColumn("copies", F.col("passes") + F.col("extra").cast("long"))


def mixed(docs: DataFrame, **shares) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of ``docs``."""
    return mixed_sizes(lined(stored(mix_rows(docs), "mix-rows")), **shares).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixture(docs: DataFrame, **shares) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns as in ``docs``.

    The documents that a source's rest of its budget takes are the first ones in
    the order of the keys, so one cut per source tells them; the texts are read
    once more and not shuffled (beyond ``BROADCAST_SOURCES`` they meet the cuts
    by a join on the source).
    """
    whole = positioned(docs, "mix-docs")
    with temporary(docs.sparkSession):
        rows = stored(mix_rows(whole.select("doc.doc_id", "doc.source", "doc.text", "doc_row"), "doc_row"), "mix-rows")
        plan = mixed_sizes(lined(rows, "doc_row"), **shares)
        last = F.max(F.when(F.col("extra"), F.struct("key", "size", "doc_row"))).alias("last")
        cuts = stored(plan.groupBy("source").agg(F.max("passes").alias("passes"), last).select(F.col("source").alias("of"), "passes", "last"), "mix-cuts", keep=True)
    cuts = F.broadcast(cuts) if cuts.count() <= BROADCAST_SOURCES else cuts
    found = whole.withColumn("of_source", F.col("doc.source").cast("string")).withColumn("key", mix_key("doc.doc_id"))
    found = found.join(cuts, F.col("of_source").eqNullSafe(F.col("of")))
    at_cut = F.struct(word_count(F.col("doc.text")).alias("size"), "doc_row") <= F.struct(F.col("last.size").alias("size"), F.col("last.doc_row").alias("doc_row"))
    extra = F.when(F.col("last").isNull(), F.lit(False)).when(F.col("key") != F.col("last.key"), F.col("key") < F.col("last.key")).otherwise(at_cut)
    some = _text(F.col("doc.text")).rlike(WORD_PATTERN)
    copies = F.col("passes") + (extra & some).cast("long")
    taken = found.select("doc", copies.alias("copies")).filter("copies > 0")
    return unpacked(taken.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), docs.columns)


ORACLE = rf"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}'))::BIGINT AS size,
               md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS k
        FROM documents),
    s AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
        FROM d GROUP BY source),
    f AS (
        SELECT *, 2.0::DOUBLE * source_size AS cap, (1.5::DOUBLE * sum(source_size) OVER ()) AS total,
               sum(2.0::DOUBLE * source_size) OVER w - 2.0::DOUBLE * source_size AS caps_before,
               sum(weight) OVER () - sum(weight) OVER w + weight AS weight_left
        FROM s
        WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    l AS (
        SELECT *, max(CASE WHEN (total - caps_before) / weight_left < cap / weight
                           THEN (total - caps_before) / weight_left END) OVER () AS level
        FROM f),
    t AS (
        SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM l),
    b AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes FROM t),
    r AS (
        SELECT d.doc_id, d.size, b.source_size, b.target, b.passes, b.target - b.passes * b.source_size AS budget,
               sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
        FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
    SELECT doc_id, size, source_size, target,
           (size * (passes + CASE WHEN size > 0 AND budget > 0 AND until - size / 2.0 <= budget THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM r
"""

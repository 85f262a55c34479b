"""Exact dedup: binomial tree-merge of sorted digest runs.

Every scan partition is a *run*: its rows reduced to (SHA-256 digest of the
text without white space, check values, best row, count).  In each round runs
``r`` with the same ``r >> bits`` meet: their sorted rows are merged, equal
digests become one row that keeps the best identifier and the summed count.
After ``ceil(log(runs) / log(fan_in))`` rounds one row per text is left.  The
winners then travel back down to the (run, digest) rows, so the join with the
documents is spread by run however many copies one text has.

Two rows merge only if the digest, the normalised length and an independent
64-bit hash of the normalised text agree (the verification).

Defined cases: a null text counts as empty; empty texts are equal to each
other; a null ``doc_id`` loses against any other; rows repeated with the same
``doc_id`` are separate rows of which one is kept; an empty table gives an
empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import WHITE_SPACE, stored, text_or_empty

KEY = ["digest", "norm_chars", "norm_check"]


def digest_rows(docs: DataFrame) -> DataFrame:
    """One slim row per document with its run; the only pass over the texts."""
    norm = F.translate(text_or_empty(), WHITE_SPACE, "")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text_or_empty()).cast("long").alias("n_chars"),
        norm.alias("norm"),
    ).select(
        "doc_id",
        "n_chars",
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row_id"),
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.length("norm").alias("norm_chars"),
        F.xxhash64("norm").alias("norm_check"),
    )


def merge_round(runs: DataFrame, bits: int) -> DataFrame:
    """Merge the runs that share ``run >> bits``: sorted by key, best row kept, counts summed."""
    return (
        runs.withColumn("run", F.shiftright("run", bits))
        .groupBy("run", *KEY)
        .agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    )


def exact_dedup(docs: DataFrame, fan_in_bits: int = 3) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    ``fan_in_bits``: 2**bits runs are merged at once.  Of equal texts the row
    with the most code points stays, then the smallest ``doc_id``.
    """
    rows = stored(digest_rows(docs), "digest-rows")
    # ~x reverses the order of a long, so that max() prefers the smallest id.
    best = F.struct("n_chars", F.bitwise_not("doc_id").alias("neg_id"), F.bitwise_not("row_id").alias("neg_row"))
    leaf = rows.groupBy("run", *KEY).agg(F.max(best).alias("best"), F.count("*").alias("n"))
    last_run = rows.agg(F.max("run").alias("r")).first().r or 0

    merged = rows.select("run", *KEY, best.alias("best"), F.lit(1).cast("long").alias("n"))
    while True:
        merged = merge_round(merged, fan_in_bits)
        last_run >>= fan_in_bits
        if last_run == 0:
            break

    winners = stored(
        merged.select(
            *KEY,
            F.bitwise_not("best.neg_id").alias("keep_id"),
            F.bitwise_not("best.neg_row").alias("keep_row"),
            F.col("n").alias("group_size"),
        ),
        "digest-winners",
    )
    down = leaf.select("run", *KEY).join(winners, KEY)
    return rows.join(down, ["run", *KEY]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE = r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n_chars,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
        FROM documents),
    w AS (
        SELECT doc_id, norm,
               first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size
        FROM d)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM w
"""

"""Sharding by extendible hashing.

Every row has a 128-bit address: the hash of its ``doc_id``, then the hash of
its position.  A directory is indexed by address prefixes; a bucket whose
bytes exceed the limit is split on its next bit, all others stay as they are,
until each fits (or holds a single row, which no bit can split; it is flagged
``oversized``).  The directory is built in rounds of eight bits: one grouped
aggregation gives the bytes of the 256 cells of every bucket that is still too
large, and sums over their common prefixes say at which bit each cell becomes
part of a shard.  Only rows of oversized buckets are looked at again.

Because the second half of the address differs for every row, even a
``doc_id`` repeated in a third of all rows is split.

Defined cases: a null text has 0 bytes; null ids hash alike and are split by
position; an empty table gives an empty result; the shard of a table that fits
as a whole is the empty prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import stored, temporary, unpacked
from lakeshift.llm.rows import positioned

BITS = 8  # address bits per round
CELLS = 1 << BITS
ROUNDS = 128 // BITS
#: Cells of a directory level up to this many (about 100 bytes each) are broadcast, else shuffled.
BROADCAST_CELLS = 100_000


def n_bytes(column: str = "text") -> Column:
    return F.octet_length(F.coalesce(F.col(column), F.lit(""))).cast("long")


def addressed(doc_id: Column, row_id: Column) -> list[Column]:
    return [F.xxhash64(doc_id).alias("a1"), F.xxhash64(row_id, F.lit("position")).alias("a2")]


def cell(level: int) -> Column:
    """The address digit that round ``level`` looks at."""
    word, at = ("a1", level) if level < ROUNDS // 2 else ("a2", level - ROUNDS // 2)
    return F.shiftrightunsigned(F.col(word), 64 - BITS * (at + 1)).bitwiseAND(F.lit(CELLS - 1)).cast("int")


def path(level: int) -> Column:
    """The address bits before round ``level``, as text of 0 and 1."""
    bits = lambda word, n: F.substring(F.lpad(F.bin(F.col(word)), 64, "0"), 1, n)
    half = ROUNDS // 2
    if level <= half:
        return bits("a1", BITS * level)
    return F.concat(bits("a1", 64), bits("a2", BITS * (level - half)))


def split_round(pending: DataFrame, limit: int) -> DataFrame:
    """Cells of the buckets in ``pending`` with the shard each belongs to (null: split in the next round)."""
    cells = pending.groupBy("path", "cell").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")).repartition("path")
    shard = F.lit(None)
    for bits in range(BITS, -1, -1):
        prefix = F.shiftright("cell", BITS - bits)
        node = Window.partitionBy("path", prefix)
        cells = cells.withColumn(f"b{bits}", F.sum("b").over(node)).withColumn(f"n{bits}", F.sum("n").over(node))
        name = F.concat("path", F.substring(F.lpad(F.bin("cell"), BITS, "0"), 1, bits))
        fits = (F.col(f"b{bits}") <= limit) | (F.col(f"n{bits}") <= 1)
        found = F.struct(name.alias("shard"), F.col(f"b{bits}").alias("shard_bytes"), F.col(f"n{bits}").alias("shard_rows"))
        shard = F.when(fits, found).otherwise(shard) if bits < BITS else F.when(fits, found)
    return cells.select("path", "cell", shard.alias("leaf"))


class Directory:
    """The levels of the directory: level ``k`` holds the cells of the buckets that round ``k`` had to split."""

    def __init__(self, rows: DataFrame, limit: int):
        self.limit, self.levels = limit, []
        pending = rows
        for level in range(ROUNDS):
            cells = stored(
                split_round(pending.select(path(level).alias("path"), cell(level).alias("cell"), "n_bytes"), limit),
                f"shard-cells-{level}",
                keep=True,
            )
            n, n_open = cells.agg(F.count("*"), F.count_if(F.col("leaf").isNull())).first()
            self.levels.append((cells, n))
            if not n_open:
                break
            still = cells.filter(F.col("leaf").isNull()).select(
                F.concat("path", F.lpad(F.bin("cell"), BITS, "0")).alias("open_path")
            )
            still = F.broadcast(still) if n <= BROADCAST_CELLS else still
            pending = stored(
                pending.join(still, path(level + 1) == F.col("open_path"), "left_semi"), f"shard-pending-{level}"
            )

    def assign(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``leaf``: a row's address is looked up level by level."""
        leaf = []
        for level, (cells, n) in enumerate(self.levels):
            cells = cells.select(F.col("path").alias(f"p{level}"), F.col("cell").alias(f"c{level}"), F.col("leaf").alias(f"l{level}"))
            cells = F.broadcast(cells) if n <= BROADCAST_CELLS else cells
            rows = rows.join(cells, (path(level) == F.col(f"p{level}")) & (cell(level) == F.col(f"c{level}")), "left")
            leaf.append(F.col(f"l{level}"))
        return rows.withColumn("leaf", F.coalesce(*leaf))

    def columns(self) -> tuple[Column, ...]:
        return (
            F.col("leaf.shard").alias("shard"),
            F.col("leaf.shard_bytes").alias("shard_bytes"),
            F.col("leaf.shard_rows").alias("shard_rows"),
            (F.col("leaf.shard_bytes") > self.limit).alias("oversized"),
        )


def shard_ids(docs: DataFrame, limit: int) -> DataFrame:
    """(doc_id, n_bytes, shard, shard_bytes, shard_rows, oversized) for every row of ``docs``."""
    slim = docs.select("doc_id", n_bytes().alias("n_bytes"), F.monotonically_increasing_id().alias("row_id"))
    rows = stored(slim.select("doc_id", "n_bytes", *addressed(F.col("doc_id"), F.col("row_id"))), "shard-rows")
    directory = Directory(rows, limit)
    return directory.assign(rows).select("doc_id", "n_bytes", *directory.columns())


def sharded(docs: DataFrame, limit: int) -> DataFrame:
    """``docs`` with the columns shard, shard_bytes, shard_rows and oversized (its own columns of these names go).

    The directory and the final lookup see the same addresses: those of the ids and of the rows' positions.
    """
    whole = positioned(docs, "shard-docs")
    with temporary(docs.sparkSession):
        rows = whole.select(n_bytes("doc.text").alias("n_bytes"), *addressed(F.col("doc.doc_id"), F.col("doc_row")))
        directory = Directory(stored(rows, "shard-rows"), limit)
    found = directory.assign(whole.select("doc", *addressed(F.col("doc.doc_id"), F.col("doc_row"))))
    own = ("shard", "shard_bytes", "shard_rows", "oversized")
    return unpacked(found, [c for c in docs.columns if c.lower() not in own], extra=directory.columns())


def write_shards(docs: DataFrame, limit: int, folder: str) -> None:
    """Write one folder per shard, rows dealt to writers by shard."""
    sharded(docs, limit).repartition("shard").write.partitionBy("shard").parquet(folder)

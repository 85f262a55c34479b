"""Positions of the rows of a table, and rows told apart by sets of positions, without a copy of the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import packed, stored

#: Bitmaps of positions up to this many (4 KiB each) are broadcast.
BROADCAST_BITMAPS = 16_384
_FILE_BITS, _ROW_BITS = 31, 32


def _is_parquet_scan(docs: DataFrame) -> bool:
    plan = docs._jdf.queryExecution().analyzed()
    return plan.getClass().getSimpleName() == "LogicalRelation" and plan.relation().toString().lower() == "parquet"


def positioned(docs: DataFrame, name: str) -> DataFrame:
    """(doc, doc_row): the rows of ``docs`` packed, with a position that is the same whenever they are read.

    Rows of a stored Parquet table are known by their file (a hash of its name,
    checked to be of one file only) and their place in it, however the files are
    split: nothing is stored.  Any other DataFrame is stored with its positions.
    """
    if not _is_parquet_scan(docs) or "_metadata" in docs.columns:
        return stored(docs.select(packed(docs), F.monotonically_increasing_id().alias("doc_row")), name)
    path = F.col("_metadata.file_path")
    files = stored(docs.select(path.alias("path")).distinct(), f"{name}-files")
    n, seed = files.count(), 0
    while files.select(_file_number(F.col("path"), seed)).distinct().count() < n:
        seed += 1
    row = F.shiftleft(_file_number(path, seed), _ROW_BITS) + F.col("_metadata.row_index")
    return docs.select(packed(docs), row.alias("doc_row"))


def _file_number(path: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(path, F.lit(seed)), F.lit(1 << _FILE_BITS))


def without(df: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` whose ``doc_row`` is not the one column of ``rows``.

    Positions are dense within a file, so one bitmap of 4 KiB stands for up to
    32,768 of them, exactly, and ``df`` is not shuffled; beyond
    ``BROADCAST_BITMAPS`` (about 5e8 rows) it is a shuffled join.
    """
    row = F.col(rows.columns[0])
    bitmaps = stored(
        rows.groupBy(F.bitmap_bucket_number(row).alias("bitmap_no")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(row)).alias("bitmap")),
        name,
        keep=True,
    )
    if bitmaps.count() > BROADCAST_BITMAPS:
        gone = stored(rows.select(row.alias("gone_row")).distinct(), f"{name}-rows", keep=True)
        return df.join(gone, F.col("doc_row") == F.col("gone_row"), "left_anti")
    byte = F.expr("conv(hex(substring(bitmap, cast(bitmap_bit_position(doc_row) div 8 as int) + 1, 1)), 16, 10)").cast("int")
    bit = F.call_function("shiftright", byte, F.expr("cast(bitmap_bit_position(doc_row) % 8 as int)")).bitwiseAND(F.lit(1)) == 1
    held = df.join(F.broadcast(bitmaps), F.bitmap_bucket_number("doc_row") == F.col("bitmap_no"), "left")
    return held.filter(F.col("bitmap").isNull() | ~bit).select(df.columns)

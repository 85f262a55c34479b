"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.session import scratch_dir
from lakeshift.sources.files import delete_path

# White space of every contract here: blank, tab, line feed, vertical tab, form feed, carriage return.
WHITE_SPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tables stored within the open blocks of ``temporary``, innermost last.
_TEMPORARY: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Hand-over tables stored in this block are deleted at its end, but for those stored with ``keep``.

    What leaves the block may read kept tables only.
    """
    _TEMPORARY.append([])
    try:
        yield
    finally:
        done = _TEMPORARY.pop()
    for path in done:
        delete_path(spark, path)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` once under the cluster's checkpoint folder and read it back.

    The hand-over table cuts the lineage: a lost executor costs the tasks that
    were running, never the stages before the table.  Copies of whole texts are
    most of what is written: Zstandard takes a third less room than Spark's default.
    ``keep``: the table outlives the innermost block of ``temporary``.
    """
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    blocks = _TEMPORARY[:-1] if keep else _TEMPORARY
    if blocks:
        blocks[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def packed(docs: DataFrame, name: str = "doc") -> Column:
    """All columns of ``docs`` as one struct, so that working columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], name: str = "doc", extra: tuple[Column, ...] = ()) -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in columns], *extra)

"""Inferred schema of JSON lines, stored in versions.

The first run infers the types of the files that are there (every line of every
file, by Spark: a schema per task, merged) and stores them as version 1; later runs read with the newest stored version, and what it
does not hold (unknown keys, mistyped values) goes to the rescue column.  A
stored version never changes; ``evolve_json_schema`` adds the next one, widened
by what given files hold, for the runs after it.

Lattice of a merge: null < all; bigint < double < string; boolean < string; structs merge field by field,
arrays element by element; any other two types meet in string.  A column that is
null in all lines is text.  Field order is that of the first version, then name.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from lakeshift.sources.files import list_names
from lakeshift.sources.rescue import CORRUPT, RESCUED

_VERSION = "version="
_NUMBERS = (T.LongType(), T.DoubleType())


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider_type(a.elementType, b.elementType))
    if a in _NUMBERS and b in _NUMBERS:
        return T.DoubleType()
    return T.StringType()


def merged_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """Both structs' fields: those of ``a`` keep their place, new ones follow by name."""
    other = {f.name: f.dataType for f in b.fields}
    kept = [T.StructField(f.name, wider_type(f.dataType, other.pop(f.name, T.NullType()))) for f in a.fields]
    return T.StructType(kept + [T.StructField(name, other[name]) for name in sorted(other)])


def _settled(dtype: T.DataType) -> T.DataType:
    """Without null types (text) and empty structs (text)."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in dtype.fields]) if dtype.fields else T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_settled(dtype.elementType))
    return T.StringType() if isinstance(dtype, T.NullType) else dtype


def infer_json_schema(spark: SparkSession, paths: str | Sequence[str]) -> T.StructType:
    """The merged schema of all lines of JSON-lines files: Spark's own inference, a schema per task merged to one.

    Names that the rescue reader adds itself are not columns of it."""
    reader = spark.read.options(inferTimestamp="false", prefersDecimal="false", columnNameOfCorruptRecord=CORRUPT)
    found = reader.json(paths if isinstance(paths, str) else list(paths)).schema
    return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in found.fields if f.name not in (RESCUED, CORRUPT)])


def stored_versions(spark: SparkSession, store: str) -> list[int]:
    """Versions whose file is complete, in order."""
    numbers = [int(n.removeprefix(_VERSION)) for n in list_names(spark, store) if n.startswith(_VERSION)]
    return sorted(n for n in numbers if "_SUCCESS" in list_names(spark, f"{store}/{_VERSION}{n}"))


def load_json_schema(spark: SparkSession, store: str, version: int | None = None) -> T.StructType | None:
    """The newest stored version (or a given one); None without any."""
    versions = stored_versions(spark, store)
    if not versions:
        return None
    text = spark.read.text(f"{store}/{_VERSION}{version or versions[-1]}").first()[0]
    return T.StructType.fromJson(json.loads(text))


def _save(spark: SparkSession, schema: T.StructType, store: str, version: int) -> None:
    spark.createDataFrame([(schema.json(),)], "v string").coalesce(1).write.mode("overwrite").text(f"{store}/{_VERSION}{version}")


def infer_or_load_json_schema(spark: SparkSession, paths: str | Sequence[str], store: str) -> T.StructType:
    """The newest stored version, else the schema of ``paths``, stored as version 1.

    A drop without any object is refused: its schema would send every later key to
    the rescue column."""
    stored = load_json_schema(spark, store)
    if stored is not None:
        return stored
    schema = infer_json_schema(spark, paths)
    if not schema.fields:
        raise ValueError(f"no JSON object to infer a schema from: {paths}")
    _save(spark, schema, store, 1)
    return schema


def evolve_json_schema(spark: SparkSession, paths: str | Sequence[str], store: str) -> T.StructType:
    """The newest version widened by what ``paths`` hold; stored as the next version where that differs."""
    old = infer_or_load_json_schema(spark, paths, store)
    new = merged_schema(old, infer_json_schema(spark, paths))
    if new != old:
        _save(spark, new, store, stored_versions(spark, store)[-1] + 1)
    return new

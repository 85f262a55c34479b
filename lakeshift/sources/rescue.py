"""Rescue column for schema-on-read JSON.

``from_json`` with a fixed schema silently turns unknown keys and mistyped
values into nothing / NULL.  The rescue column keeps them: the line is also
parsed as ``map<string,string>`` (every value as its JSON text) and the top-level
entries the typed parse lost are kept as JSON text in ``_rescued_data``:

* keys the schema does not have;
* keys whose text is non-NULL but whose typed value is NULL (mistyped);
* structs at any depth: an unknown or mistyped sub-field rescues the whole
  top-level value (the typed struct keeps what did parse);
* arrays: an element that did not parse, or a struct element that lost
  something, likewise.

A JSON ``null`` is not rescued.  A line that is not a JSON object yields NULL
columns and ``_corrupt_record`` = the line.  Pure expressions: no shuffle, works
in batch and streaming plans.

Every parse is a column of its own projection and read from there, so a line is
parsed twice (typed, as a map) and a struct column once more; structs within
arrays are parsed per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
CORRUPT = "_corrupt_record"
_TEXT_MAP = "map<string,string>"
_TYPED, _TEXTS = "__typed", "__texts"


def _struct_levels(schema: T.StructType) -> list[list[tuple[str, ...]]]:
    """Paths of the struct columns, by depth (through structs only)."""
    levels, level = [], [((), schema)]
    while level:
        level = [
            ((*path, f.name), f.dataType) for path, s in level for f in s.fields if isinstance(f.dataType, T.StructType)
        ]
        if level:
            levels.append([path for path, _ in level])
    return levels


def _lost(dtype: T.DataType, typed: Column, text: Column, path: tuple[str, ...] = (), maps=None) -> Column:
    """Whether a value with JSON text ``text`` did not survive the typed parse.

    ``maps`` holds the staged text maps of the struct columns by path; within
    arrays (``maps`` is None) a struct is parsed in place.
    """
    gone = text.isNotNull() & typed.isNull()
    if isinstance(dtype, T.StructType):
        texts = F.from_json(text, _TEXT_MAP) if maps is None else maps[path]
        inner = F.size(_unknown(dtype, texts)) > 0
        for f in dtype.fields:
            inner = inner | _lost(f.dataType, typed[f.name], texts[f.name], (*path, f.name), maps)
    elif isinstance(dtype, T.ArrayType):
        pairs = F.arrays_zip(typed.alias("v"), F.from_json(text, "array<string>").alias("t"))
        inner = F.exists(pairs, lambda p: _lost(dtype.elementType, p["v"], p["t"]))
    else:
        return gone
    return gone | (typed.isNotNull() & F.coalesce(inner, F.lit(False)))


def _unknown(dtype: T.StructType, texts: Column) -> Column:
    return F.array_except(F.map_keys(texts), F.array(*[F.lit(f.name) for f in dtype.fields]).cast("array<string>"))


def parse_json_with_rescue(
    lines: DataFrame, schema: T.StructType, carried: tuple[str, ...] = (), text: str = "value"
) -> DataFrame:
    """``lines`` parsed: the columns of ``schema``, ``_rescued_data``, ``_corrupt_record`` and those named in ``carried``."""
    df = lines.select(
        text, *carried, F.from_json(text, schema).alias(_TYPED), F.from_json(text, _TEXT_MAP).alias(_TEXTS)
    )
    maps = {(): F.col(_TEXTS)}
    for depth, paths in enumerate(_struct_levels(schema)):
        names = {path: f"{_TEXTS}_{depth}_{i}" for i, path in enumerate(paths)}
        df = df.withColumns({n: F.from_json(maps[p[:-1]][p[-1]], _TEXT_MAP) for p, n in names.items()})
        maps |= {p: F.col(n) for p, n in names.items()}

    top, typed = F.col(_TEXTS), F.col(_TYPED)
    flags = [
        F.when(_lost(f.dataType, typed[f.name], top[f.name], (f.name,), maps), F.lit(f.name)) for f in schema.fields
    ]
    df = df.withColumn("__lost", F.concat(_unknown(schema, top), F.array_compact(F.array(*flags))))
    kept = F.map_filter(top, lambda k, v: F.array_contains(F.col("__lost"), k))
    return df.select(
        f"{_TYPED}.*",
        F.when(F.size("__lost") > 0, F.to_json(kept)).alias(RESCUED),
        F.when(F.col(text).isNotNull() & top.isNull(), F.col(text)).alias(CORRUPT),
        *carried,
    )

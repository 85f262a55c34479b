"""File sources: JSON lines with rescue, header-aware CSV with a stored and
evolving schema, stored tables as batch or stream, ingestion metadata."""

from __future__ import annotations

import csv
import io
import json
import os
from collections import Counter
from collections.abc import Mapping, Sequence
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.sources.rescue import parse_json_with_rescue

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"


# ------------------------------------------------------------------------ metadata
def with_ingest_metadata(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add ``_ingested_at`` (processing time, or a given value) and
    ``_source_file`` (the hidden ``_metadata.file_path`` of file sources)."""
    return df.withColumns(
        {
            INGESTED_AT: ingested_at if ingested_at is not None else F.current_timestamp(),
            SOURCE_FILE: F.col("_metadata.file_path"),
        }
    )


# ------------------------------------------------------------------------ JSON lines
def _json_lines(text_df: DataFrame, schema: T.StructType, rescue: bool, metadata: bool) -> DataFrame:
    carried = (INGESTED_AT, SOURCE_FILE) if metadata else ()
    lines = with_ingest_metadata(text_df) if metadata else text_df
    if not rescue:
        return lines.select(F.from_json("value", schema).alias("__p"), *carried).select("__p.*", *carried)
    return parse_json_with_rescue(lines, schema, carried)


def read_json(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, rescue: bool = True, metadata: bool = False
) -> DataFrame:
    """Batch read of JSON-lines files with a fixed schema (+ rescue column).

    Read as text so that every line is parsed by ``from_json`` (splittable, one
    pass, no inference job); ``metadata`` adds ``_ingested_at`` and ``_source_file``.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return _json_lines(spark.read.text(paths), schema, rescue, metadata)


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rescue: bool = True,
    metadata: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Incremental JSON-lines directory stream with a fixed schema and rescue."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _json_lines(reader.load(path), schema, rescue, metadata)


# ------------------------------------------------------------------------ schema store
def save_schema(spark: SparkSession, schema: T.StructType, store: str) -> None:
    """Persist a schema as one JSON text file (shared file system)."""
    spark.createDataFrame([(schema.json(),)], "v string").coalesce(1).write.mode("overwrite").text(store)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's Hadoop file system (any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder (none if it does not exist), on any file system of the cluster."""
    fs, hpath = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    fs, hpath = _file_system(spark, path)
    return int(fs.getContentSummary(hpath).getLength())


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file whose name is the message: it exists or not, never half."""
    fs, hpath = _file_system(spark, path)
    fs.create(hpath, True).close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _file_system(spark, path)
    fs.delete(hpath, True)


def load_schema(spark: SparkSession, store: str) -> T.StructType | None:
    if not path_exists(spark, store):
        return None
    row = spark.read.text(store).first()
    return T.StructType.fromJson(json.loads(row[0])) if row else None


_WIDENING = [T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()]


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    rank = {t.simpleString(): i for i, t in enumerate(_WIDENING)}
    ia, ib = rank.get(a.simpleString()), rank.get(b.simpleString())
    if ia is None or ib is None:
        return T.StringType()
    return _WIDENING[max(ia, ib)]


def merge_schemas(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Known columns keep their position (type widened int->bigint->double->
    string on conflict); new columns are appended."""
    if old is None:
        return new
    fields = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in fields:
            fields[f.name] = T.StructField(f.name, _wider(fields[f.name].dataType, f.dataType), True)
        else:
            fields[f.name] = T.StructField(f.name, f.dataType, True)
    return T.StructType(list(fields.values()))


def infer_or_load_schema(
    spark: SparkSession, paths: Sequence[str], fmt: str, store: str, **options
) -> T.StructType:
    """Stored schema if present, else inferred once from ``paths`` and stored."""
    stored = load_schema(spark, store)
    if stored is not None:
        return stored
    inferred = spark.read.format(fmt).options(inferSchema="true", **options).load(list(paths)).schema
    save_schema(spark, inferred, store)
    return inferred


# ------------------------------------------------------------------------ CSV with evolving headers
_HEADER_CHUNK = 1 << 16


def _first_lines(batches):
    """mapInPandas body: open each file (pyarrow file systems) and read bytes up
    to the first line break outside quotes only.  Schemes without a file system
    here yield NULL (caller falls back); a file that cannot be opened or decoded
    fails the task."""
    import pandas as pd
    import pyarrow as pa
    from pyarrow import fs as pafs

    for pdf in batches:
        headers = []
        for uri in pdf["file_path"]:
            if "://" not in uri or uri.startswith("file:"):
                path = "/" + uri[len("file:") :].lstrip("/") if uri.startswith("file:") else uri
                # As a URI a path has its odd characters quoted.
                filesystem, path = pafs.LocalFileSystem(), path if os.path.exists(path) else unquote(path)
            else:
                try:
                    filesystem, path = pafs.FileSystem.from_uri(uri)
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    headers.append(None)
                    continue
            buf, end = b"", -1
            with filesystem.open_input_stream(path) as fh:
                while end < 0:
                    chunk = fh.read(_HEADER_CHUNK)
                    buf += chunk
                    end = buf.find(b"\n")
                    while end >= 0 and buf.count(b'"', 0, end) % 2:
                        end = buf.find(b"\n", end + 1)
                    if not chunk and end < 0:
                        end = len(buf)
            line = buf[:end].rstrip(b"\r").decode("utf-8")
            headers.append(line.removeprefix("\ufeff"))
        yield pd.DataFrame({"file_path": pdf["file_path"], "header": headers})


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file_path, header``: the first line of each file.

    Read on the executors: the (bounded) path list is spread over tasks and each
    file is opened and read only up to its first line break, so the cost does not
    grow with file size.  Files on a scheme the executors' file-system library
    cannot open are handled by ``file_headers_by_scan``.
    """
    from lakeshift.session import ship_package

    ship_package(spark)  # _first_lines runs in executor Python workers
    paths = list(paths)
    parts = max(1, min(len(paths), 2 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(p,) for p in paths], "file_path string").repartition(parts)
    found = listed.mapInPandas(_first_lines, "file_path string, header string")
    rows = found.collect()
    missing = [r["file_path"] for r in rows if r["header"] is None]
    done = [(r["file_path"], r["header"]) for r in rows if r["header"] is not None]
    if missing:
        done += [(r["file_path"], r["header"]) for r in file_headers_by_scan(spark, missing).collect()]
    return spark.createDataFrame(done, "file_path string, header string")


def file_headers_by_scan(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``file_path, header`` found by a Spark text scan (any Hadoop file system).

    Rows of a file's first split are read in order, so the line with the smallest
    ``monotonically_increasing_id`` of that split is the header.  One row per
    file leaves the aggregate (partial per task).
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.col("value"),
        F.monotonically_increasing_id().alias("__pos"),
    )
    return lines.filter(F.col("__block") == 0).groupBy("file_path").agg(F.min_by("value", "__pos").alias("header"))


def quoted(name: str) -> str:
    """A column name as one identifier, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def _reads_as(text: Column, dtype: T.DataType) -> Column:
    """Whether a CSV text is a value of ``dtype``."""
    if dtype == T.StringType():
        return F.lit(True)
    reads = text.try_cast(dtype).isNotNull()
    if dtype == T.BooleanType():
        return reads & F.lower(text).isin("true", "false")
    if dtype == T.DateType():
        return reads & (F.length(text) == 10)
    return reads


# Types tried for a new column, in this order; text if none holds.
_INFERRED = [T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType()]


def _candidates(known: T.DataType | None) -> list[T.DataType]:
    """Types a column may have: all for a new one, else its own and the wider ones."""
    if known is None:
        return _INFERRED
    if known in _WIDENING:
        return [t for t in _WIDENING[_WIDENING.index(known) :] if t != T.StringType()]
    return [known]


def infer_text_types(text: DataFrame, known: T.StructType | None = None) -> T.StructType:
    """The types of text columns: for each column the first type that reads all of
    its values (a known column keeps its type unless a value needs a wider one; a
    column without any value keeps its type, or is text).  One aggregate over the
    columns that are not known to be text, with a partial result per task."""
    types = {f.name: f.dataType for f in known.fields} if known else {}
    tried = {i: _candidates(types.get(c)) for i, c in enumerate(text.columns) if types.get(c) != T.StringType()}
    found = {c: types.get(c, T.StringType()) for c in text.columns}
    if tried:
        aggs = []
        for i, candidates in tried.items():
            c = F.col(quoted(text.columns[i]))
            aggs.append(F.count(c).alias(f"n{i}"))
            aggs += [F.count_if(c.isNotNull() & ~_reads_as(c, t)).alias(f"n{i}_{k}") for k, t in enumerate(candidates)]
        row = text.agg(*aggs).first()
        for i, candidates in tried.items():
            if row[f"n{i}"]:
                fits = [t for k, t in enumerate(candidates) if row[f"n{i}_{k}"] == 0]
                found[text.columns[i]] = fits[0] if fits else T.StringType()
    return T.StructType([T.StructField(c, found[c], True) for c in text.columns])


def header_names(header: str, options: Mapping[str, str] | None = None) -> list[str]:
    """Column names of a header line; empty ones are ``_c<place>``, repeated ones (in any case) get their place appended."""
    options = {k.lower(): v for k, v in (options or {}).items()}
    separator, quote = options.get("sep") or options.get("delimiter") or ",", options.get("quote") or '"'
    cells = next(csv.reader(io.StringIO(header, newline=""), delimiter=separator, quotechar=quote), [])
    cells = [c or f"_c{i}" for i, c in enumerate(cells)]
    often = Counter(c.lower() for c in cells)
    return [f"{c}{i}" if often[c.lower()] > 1 else c for i, c in enumerate(cells)]


def _spellings(path: str) -> set[str]:
    """The ways in which the path of a file may be written as a URI."""
    plain = {path, unquote(path)}
    for p in list(plain):
        if p.startswith("file:"):
            p = "/" + p[len("file:") :].lstrip("/")
        if p.startswith("/"):
            plain |= {f"file://{p}", f"file:{p}"}
    # Quoted everywhere, or in the characters only that a URI may not hold.
    legal = "".join(c for p in plain for c in p if ord(c) > 127) + ":/+!$&'()*,;=@"
    return plain | {quote(p, safe=":/") for p in plain} | {_quoted_but(p, legal) for p in plain}


def _quoted_but(path: str, legal: str) -> str:
    return "".join(c if c in legal else quote(c) for c in path)


def read_csv_text(
    spark: SparkSession,
    paths: Sequence[str],
    schema_store: str | None = None,
    infer: bool = True,
    **options,
) -> tuple[DataFrame, T.StructType]:
    """CSV files whose headers differ, as text columns matched by *name*, and the
    merged schema of their values.

    A CSV scan over files with different headers assigns values by position,
    silently.  Here one scan reads the values of all files by position, each row
    meets its file's header (a broadcast table of one entry per file), and every
    column takes the value at its place in that header, absent columns NULL: the
    plan is the same for one header or hundreds.  A row whose file has no header
    entry fails the query.  Quoted line breaks need the option ``multiLine``.
    The schema in ``schema_store`` is widened and extended by new columns; values
    stay the text of the file, so a type widened later loses nothing (``007``).
    Only the list of (file, header) pairs reaches the driver: one row per file.
    """
    paths = list(paths)
    if not paths:
        raise ValueError("no CSV files given")
    headers = {r["file_path"]: header_names(r["header"] or "", options) for r in file_headers(spark, paths).collect()}
    stored = load_schema(spark, schema_store) if schema_store else None
    names = list(dict.fromkeys([*(stored.names if stored else []), *(c for p in sorted(headers) for c in headers[p])]))
    width = max(1, *(len(h) for h in headers.values()))
    by_position = T.StructType([T.StructField(f"c{i}", T.StringType(), True) for i in range(width)])
    places = [(spelling, [h.index(n) if n in h else -1 for n in names]) for p, h in headers.items() for spelling in _spellings(p)]
    places = spark.createDataFrame(places, "__path string, __places array<int>")
    scan = spark.read.options(**{"header": "true", "enforceSchema": "true", "inferSchema": "false", **options}).schema(by_position).csv(paths)
    rows = scan.select(F.array(*by_position.names).alias("__values"), F.col("_metadata.file_path").alias("__file"))
    rows = rows.join(F.broadcast(places), F.col("__file") == F.col("__path"), "left")
    unknown = F.raise_error(F.concat(F.lit("no header known of "), "__file")).cast("array<int>")
    rows = rows.select("__values", F.coalesce("__places", unknown).alias("__places"))
    text = rows.select(*[F.get("__values", F.get("__places", F.lit(j))).alias(n) for j, n in enumerate(names)])
    if infer:
        merged = infer_text_types(text, stored)
    else:
        known = {f.name: f for f in stored.fields} if stored else {}
        merged = T.StructType([known.get(c, T.StructField(c, T.StringType(), True)) for c in names])
    if schema_store and merged != stored:
        save_schema(spark, merged, schema_store)
    return text, merged


def typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to ``schema``; columns that ``text`` lacks are NULL."""
    return text.select(
        *[
            (F.col(quoted(f.name)) if f.name in text.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_csv_evolving(
    spark: SparkSession,
    paths: Sequence[str],
    schema_store: str | None = None,
    infer: bool = True,
    **options,
) -> DataFrame:
    """Read CSV files whose headers differ, matching columns by *name*, with the
    types of the merged schema (see ``read_csv_text``)."""
    return typed(*read_csv_text(spark, paths, schema_store, infer, **options))


# ------------------------------------------------------------------------ stored tables
def read_stored(spark: SparkSession, path: str, merge_schema: bool = True) -> DataFrame:
    """Batch scan of a stored parquet table (files may carry added columns)."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def read_stored_stream(
    spark: SparkSession, path_or_table: str, schema: T.StructType | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A stored append-only table as a stream: by catalog name, or by path
    (schema taken from the stored files when not given)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if "/" not in path_or_table:
        return reader.table(path_or_table)
    schema = schema or spark.read.parquet(path_or_table).schema
    return reader.schema(schema).parquet(path_or_table)

"""Type-2 history (SCD2) from a change feed, and its current view.

Semantics
---------
* Records are grouped by ``keys`` and ordered by ``sequence_by``.
* A new version opens when any ``track`` column differs (NULL-safe) from the
  previous record of the key; the first record of a key opens one.  A value
  returning to an older value is a new version.
* Other columns update in place: a version's content is its *last* record.
* ``__START_AT`` = sequence of the version's first record, ``__END_AT`` = start
  of the next version of the key, NULL while open.
* Two records with the same (key, sequence) collapse to one, the greatest by
  ``tie_break`` (default: the greatest whole record — compared as JSON text when
  it holds a map — so the choice is deterministic).  NULL sequences are rejected.
* The result depends only on the set of records, not on arrival order.

Distribution
------------
Copies and same-(key, sequence) records are collapsed by an aggregate (partial
per task, so a hot group of copies shrinks before the shuffle).  Versions are
found with ``lag`` over windows partitioned by (key, chunk): every key with at
most ``chunk_rows`` records is one chunk, so the common case is a plain window
by key.  The records of *heavy* keys are range-sorted by (key, sequence) and cut
where they lie into chunks of at most ``chunk_rows``, so a key holding a third of
all rows is spread over many tasks however its records crowd in time.
What crosses a chunk boundary (the previous chunk's last tracked values, the
version open at the chunk's start, the next change after the chunk) comes from
a per-(key, chunk) summary with one row per chunk.  Finally a version
aggregate (partial per task again) keeps each version's last record.

The heavy-key table has at most ``rows / chunk_rows`` entries; a feed of more
than ``chunk_rows`` records is counted by key first (keys and total chunks) —
without heavy keys nothing else is needed — and the table is stored and broadcast only when its size is under
``broadcast_keys``, otherwise joined by a shuffle (AQE splits skewed
partitions).  On the chunked path the windowed rows are checkpointed
once, because the chunk summary and the final rows both read them; the summary
covers heavy keys only, so its row count (the total number of chunks) is known
before it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.session import ensure_checkpoint_dir

START_AT = "__START_AT"
END_AT = "__END_AT"

DEFAULT_CHUNK_ROWS = 2_000_000
DEFAULT_BROADCAST_KEYS = 200_000


def _check_sequence(seq_type: T.DataType) -> None:
    if not isinstance(seq_type, (T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType)):
        raise TypeError(f"unsupported sequence type {seq_type.simpleString()}")


def _orderable(dt: T.DataType) -> bool:
    """Maps have no ordering; structs and arrays are ordered by their elements."""
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def collapse_same_sequence(
    df: DataFrame, keys: Sequence[str], sequence_by: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """One record per (key, sequence): the greatest by ``tie_break``, else the
    greatest record (compared as a struct; as JSON text only when it holds a
    map, which has no ordering)."""
    others = [c for c in df.columns if c not in keys and c != sequence_by]
    if not others:
        return df.select(*keys, sequence_by).distinct()
    payload = F.struct(*[F.col(c) for c in others])
    if tie_break:
        pick = F.max_by(payload, F.struct(*[F.col(c) for c in tie_break]))
    elif all(_orderable(df.schema[c].dataType) for c in others):
        pick = F.max(payload)
    else:
        pick = F.max_by(payload, F.to_json(payload))
    return (
        df.groupBy(*keys, sequence_by)
        .agg(pick.alias("__rec"))
        .select(*keys, sequence_by, *[F.col("__rec")[c].alias(c) for c in others])
    )


def scd2(
    df: DataFrame,
    keys: Sequence[str] | str,
    sequence_by: str,
    track: Sequence[str] | None = None,
    tie_break: Sequence[str] | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    broadcast_keys: int = DEFAULT_BROADCAST_KEYS,
    start_col: str = START_AT,
    end_col: str = END_AT,
) -> DataFrame:
    """Build the SCD2 history of a change feed (see module docstring)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    seq = sequence_by
    others = [c for c in df.columns if c not in keys and c != seq]
    track = list(others if track is None else track)
    missing = [c for c in track if c not in df.columns]
    if missing:
        raise ValueError(f"tracked columns not in input: {missing}")
    _check_sequence(df.schema[seq].dataType)

    rows = df.filter(F.col(seq).isNotNull())
    recs = collapse_same_sequence(rows, keys, seq, tie_break)
    tracked = F.struct(*[F.col(c) for c in track]) if track else F.struct(F.lit(0))

    # --- heavy keys: more than chunk_rows records --------------------------------
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    n_chunks = F.ceil(F.col("__n") / F.lit(chunk_rows))
    is_heavy = F.col("__n") > F.lit(chunk_rows)
    n_heavy = total_chunks = 0
    if rows.count() > chunk_rows:  # reads the sequence column only; below it no key can be heavy
        # One small job sizes the heavy-key table: its rows and its total chunks.
        n_heavy, total_chunks = per_key.agg(
            F.count_if(is_heavy), F.coalesce(F.sum(F.when(is_heavy, n_chunks)), F.lit(0))
        ).first()

    if n_heavy == 0:
        # Every key fits one task: plain window by key.
        w = Window.partitionBy(*keys).orderBy(seq)
        marked = recs.withColumn("__chg", ~tracked.eqNullSafe(F.lag(tracked).over(w)))
        versioned = marked.select(
            "*",
            F.max(F.when(F.col("__chg"), F.col(seq))).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__vs"),
            F.min(F.when(F.col("__chg"), F.col(seq))).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("__ve"),
        )
    else:
        # Stored once: both joins below read it (broadcast or shuffled).
        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        heavy = per_key.filter(is_heavy).select(*keys).checkpoint(eager=True)
        side = F.broadcast(heavy) if n_heavy <= broadcast_keys else heavy
        light = recs.join(side, keys, "left_anti").withColumns({"__heavy": F.lit(False), "__chunk": F.lit(0).cast("long")})
        lined = recs.join(side, keys, "left_semi").repartitionByRange(*keys, seq).sortWithinPartitions(*keys, seq)
        # The row's place: its range partition in the upper bits, its position there in the lower 33.
        lined = lined.withColumn("__at", F.monotonically_increasing_id())
        low = F.lit((1 << 33) - 1)
        chunk = F.col("__at") - F.col("__at").bitwiseAND(low) + F.floor(F.col("__at").bitwiseAND(low) / F.lit(chunk_rows))
        chunked = light.unionByName(lined.select(*recs.columns, F.lit(True).alias("__heavy"), chunk.cast("long").alias("__chunk")))
        # A range boundary within a key cuts one chunk more.
        total_chunks += n_heavy + int(spark.conf.get("spark.sql.shuffle.partitions"))
        wc = Window.partitionBy(*keys, "__chunk").orderBy(seq)
        inner = chunked.select(
            "*",
            F.when(F.row_number().over(wc) > 1, ~tracked.eqNullSafe(F.lag(tracked).over(wc))).alias("__ichg"),
            F.first(seq).over(wc.rowsBetween(Window.unboundedPreceding, 0)).alias("__cfirst"),
            tracked.alias("__trk"),
        )
        inner = inner.select(
            "*",
            F.max(F.when(F.col("__ichg"), F.col(seq))).over(wc.rowsBetween(Window.unboundedPreceding, 0)).alias("__irun"),
            F.min(F.when(F.col("__ichg"), F.col(seq))).over(wc.rowsBetween(1, Window.unboundedFollowing)).alias("__inext"),
        )
        # Read twice below (chunk summary, final rows): stored once in the shared
        # checkpoint folder, which also cuts the lineage.
        inner = inner.checkpoint(eager=True)
        # One row per chunk of a heavy key: at most `total_chunks` rows (known).
        summary = (
            inner.filter(F.col("__heavy"))
            .groupBy(*keys, "__chunk")
            .agg(
                F.min(seq).alias("__first_seq"),
                F.min_by("__trk", seq).alias("__first_trk"),
                F.max_by("__trk", seq).alias("__last_trk"),
                F.min(F.when(F.col("__ichg"), F.col(seq))).alias("__first_ichg"),
                F.max(F.when(F.col("__ichg"), F.col(seq))).alias("__last_ichg"),
            )
        )
        ws = Window.partitionBy(*keys).orderBy("__chunk")
        summary = summary.withColumn("__bchg", ~F.col("__first_trk").eqNullSafe(F.lag("__last_trk").over(ws)))
        first_change = F.when(F.col("__bchg"), F.col("__first_seq")).otherwise(F.col("__first_ichg"))
        last_change = F.coalesce(F.col("__last_ichg"), F.when(F.col("__bchg"), F.col("__first_seq")))
        summary = summary.select(
            *keys,
            "__chunk",
            "__bchg",
            F.max(last_change).over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("__carried"),
            F.min(first_change).over(ws.rowsBetween(1, Window.unboundedFollowing)).alias("__after"),
        )
        side = F.broadcast(summary) if total_chunks <= broadcast_keys else summary
        joined = inner.join(side, [*keys, "__chunk"], "left")
        # A key that is not heavy is one chunk: its first record opens a version.
        bchg = F.coalesce(F.col("__bchg"), F.lit(True))
        versioned = joined.select(
            *recs.columns,
            F.coalesce(F.col("__irun"), F.when(bchg, F.col("__cfirst")), F.col("__carried")).alias("__vs"),
            F.coalesce(F.col("__inext"), F.col("__after")).alias("__ve"),
        )

    content = [*others, seq]
    return (
        versioned.groupBy(*keys, "__vs")
        .agg(
            F.max_by(F.struct(*[F.col(c) for c in content]), F.col(seq)).alias("__last"),
            F.max("__ve").alias("__ve"),
        )
        .select(
            *keys,
            *[F.col("__last")[c].alias(c) for c in content],
            F.col("__vs").alias(start_col),
            F.col("__ve").alias(end_col),
        )
    )


def latest(history: DataFrame, end_col: str = END_AT) -> DataFrame:
    """Current (open) version of every key."""
    return history.filter(F.col(end_col).isNull())

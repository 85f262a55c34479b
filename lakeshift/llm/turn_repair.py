"""Repair of conversation structure by Wagner-Fischer alignment with the grammar's strings.

A conversation's role initials are to read ``(s?(ua)+)?``.  For a given length
this grammar has one string at most, so the cheapest repair is the cheapest
alignment of the turns with one of these strings, over all feasible lengths.

*Table.*  Strings that end alike share their suffixes: cell (i, m) holds the
cost of aligning the turns from i on with the last m symbols, for every length
at once.  The row of turn i comes from the row below by numpy (delete, keep or
rerole) and a running minimum (inserts).

*Band.*  A greedy repair gives the incumbent cost.  A cell whose turns and
symbols differ by more than the incumbent pays for in inserts or deletions lies
on no cheapest alignment, so a row has only Ukkonen's band of cells.

*Audits.*  Of every length whose cost is the least the audit is traced back
(``D`` delete, ``I`` insert, ``K`` keep, ``R`` rerole; at each cell the ASCII-least
edit that is on a cheapest alignment), and the ASCII-least audit wins.  The
audit alone tells the repaired turns: its length without ``D`` names the string.

Conversations of more than ``PIECE`` turns are aligned piece by piece, from the
last to the first: for each state in which a piece may be entered (nothing yet,
``s`` taken, ``u`` or ``a`` awaited) and left, the cheapest alignments as above.
Costs add up and audits are joined, so time and memory grow with the turns and
not with their square.

*Distribution.*  Turns are range-sorted by conversation and turn and cut into
pieces where they lie, so a conversation of any size is spread over many tasks;
repeated turns are found by windows over digests.  One letter per turn describes
all that the alignment needs.  What one task sees of a whole conversation are its
pieces' audits (a letter per turn and way) and, one after another, its texts,
behind the audit, to be hashed in order.

Defined cases: null roles and texts are one blank; a null ``conv_id`` is a
conversation of its own; turns are ordered by (turn, role, text), null turns
first, so repeated rows are adjacent; an empty table gives an empty result;
columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import WHITE_SPACE, stored
from lakeshift.session import ship_package

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Turns that are aligned as one table.
PIECE = 1024
_FAR = 1 << 40

#: A turn's letter: its role's initial (``x``: none of the grammar's), a capital if its text is truncated, a digit if
#: it is blank (0-3) or a duplicate (4-7).
INITIALS = "suax"
BLANKS, DUPLICATES = "0123", "4567"
#: For the alignment every turn that must go is this letter.
MUST_GO = "-"
_ALIGNED = str.maketrans(dict.fromkeys(BLANKS + DUPLICATES, MUST_GO))
_INITIAL = str.maketrans(BLANKS + DUPLICATES + INITIALS.upper(), INITIALS * 3)


# ---------------------------------------------------------------- alignment
class _Piece:
    """The alignment tables of one piece: ``rows[e][i]`` holds the costs of turns i.. with the last m symbols of a
    string after which ``u`` (e = 0) or ``a`` (e = 1) is awaited, for m from ``low[i]`` on."""

    def __init__(self, turns: str):
        n = len(turns)
        self.turns = turns
        must = np.array([t == MUST_GO for t in turns], bool)
        self.cost = [TRUNCATED if t.isupper() else 0 for t in turns]
        self.initial = turns.lower()
        # What the turns from i on cost at least, and how many of them may stay.
        least = np.where(must, DELETE, self.cost)
        self.least = np.append(np.cumsum(least[::-1])[::-1], 0)
        self.may_stay = np.append(np.cumsum((~must)[::-1])[::-1], 0)
        self.slack = self._incumbent() - int(self.least[0])
        self.low, self.high = [], []
        for i in range(n + 1):
            q = int(self.may_stay[i])
            self.low.append(max(0, q - self.slack // (DELETE - TRUNCATED)))
            self.high.append(q + self.slack // INSERT)
        self.rows = [self._table(e) for e in (0, 1)]

    def _incumbent(self) -> int:
        """The cost of a greedy repair, from any state in which the piece may be entered to any in which it may be left."""
        cost, awaited = int(self.least[0]), None
        for t in self.initial:
            if t == MUST_GO:
                continue
            if awaited is not None and t != awaited or t not in "ua":
                cost += max(REROLE, INSERT)
            awaited = "u" if (t if t in "ua" else awaited or "u") == "a" else "a"
        return cost + 3 * INSERT

    def _table(self, e: int) -> list[np.ndarray]:
        n = len(self.turns)
        width = np.arange(self.high[n] - self.low[n] + 1)
        rows = [INSERT * (self.low[n] + width)]
        for i in range(n - 1, -1, -1):
            m = np.arange(self.low[i], self.high[i] + 1)
            below, at = rows[-1], self.low[i + 1]
            out = DELETE + self._read(below, at, m)
            if self.turns[i] != MUST_GO:
                wrong = np.full(len(m), REROLE)
                if self.initial[i] in "ua":
                    # The symbol m from the end: ``u`` where m and e differ in no parity.
                    wrong[((m + e) % 2 == 0) == (self.initial[i] == "u")] = KEEP
                out = np.minimum(out, np.where(m > 0, self._read(below, at, m - 1) + wrong + self.cost[i], _FAR))
            rows.append(np.minimum.accumulate(out - INSERT * m) + INSERT * m)
        return rows[::-1]

    @staticmethod
    def _read(row: np.ndarray, low: int, m: np.ndarray) -> np.ndarray:
        at = m - low
        return np.where((at >= 0) & (at < len(row)), row[np.clip(at, 0, len(row) - 1)], _FAR)

    def at(self, e: int, i: int, m: int) -> int:
        k = m - self.low[i]
        return int(self.rows[e][i][k]) if 0 <= k < len(self.rows[e][i]) else _FAR

    def audit(self, e: int, i: int, m: int) -> str:
        """The ASCII-least audit of a cheapest alignment of the turns from i on with the last m symbols."""
        out, n, cost = [], len(self.turns), self.at(e, i, m)
        while i < n or m:
            if i < n and cost == DELETE + (c := self.at(e, i + 1, m)):
                out.append("D")
                i, cost = i + 1, c
            elif m and cost == INSERT + (c := self.at(e, i, m - 1)):
                out.append("I")
                m, cost = m - 1, c
            else:
                awaited = "u" if (m + e) % 2 == 0 else "a"
                out.append("K" if self.initial[i] == awaited else "R")
                i, m = i + 1, m - 1
                cost = self.at(e, i, m)
        return "".join(out)

    def cheapest(self, e: int, i: int, parity: int, least_m: int) -> tuple[int, list[int]]:
        """The least cost of the turns from i on over all lengths of a parity, and the lengths that have it."""
        m = np.arange(self.low[i], self.high[i] + 1)
        costs = np.where((m >= least_m) & (m % 2 == parity), self.rows[e][i], _FAR)
        least = int(costs.min(initial=_FAR))
        return least, m[costs == least].tolist()


#: States between pieces: nothing taken yet, ``s`` taken, ``u`` awaited, ``a`` awaited.
NOTHING, AFTER_S, AWAIT_U, AWAIT_A = range(4)


def ways(piece: _Piece, state: int) -> Iterator[tuple[int, int, str]]:
    """(state after, cost, audit) of the cheapest alignments of a piece that is entered in ``state``."""
    n = len(piece.turns)
    if state in (NOTHING, AFTER_S):
        yield state, DELETE * n, "D" * n
    taken = [p for p, t in enumerate(piece.turns) if t in "sS"] if state == NOTHING else []
    for e, after in ((0, AWAIT_U), (1, AWAIT_A)):
        # Strings that start with u and end before u have even lengths, and so on; only a state that stays takes none.
        parity = (e + (state == AWAIT_A)) % 2
        cost, lengths = piece.cheapest(e, 0, parity, 0 if state in (AWAIT_U, AWAIT_A) else 1)
        found = [(cost, "", 0, lengths)]
        for p in taken:
            if DELETE * p + int(piece.least[p]) > min(f[0] for f in found):
                break
            cost, lengths = piece.cheapest(e, p + 1, e, 1)
            found.append((DELETE * p + piece.cost[p] + cost, "D" * p + "K", p + 1, lengths))
        least = min(f[0] for f in found)
        if least < _FAR:
            yield after, least, min(start + piece.audit(e, i, m) for cost, start, i, lengths in found if cost == least for m in lengths)
    if taken:
        cost, audit = min((DELETE * (n - 1) + piece.cost[p], "D" * p + "K" + "D" * (n - 1 - p)) for p in taken)
        yield AFTER_S, cost, audit


def piece_ways(letters: str) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of a piece, given by its turns' letters."""
    piece = _Piece(letters.translate(_ALIGNED))
    return [(state, *way) for state in (NOTHING, AFTER_S, AWAIT_U, AWAIT_A) for way in ways(piece, state)]


_short_ways = lru_cache(maxsize=20_000)(piece_ways)


def joined(pieces: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a conversation from the ways of its pieces in order."""
    end: dict[int, tuple[int, str]] = {NOTHING: (0, ""), AWAIT_U: (0, "")}
    for piece in reversed(pieces):
        start: dict[int, tuple[int, str]] = {}
        for state, after, cost, audit in piece:
            if after in end:
                way = (cost + end[after][0], audit + end[after][1])
                start[state] = min(start.get(state, way), way)
        end = start
    return end[NOTHING]


def repair(letters: str, piece: int = PIECE) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a conversation, given by its turns' letters."""
    return joined([piece_ways(letters[a : a + piece]) for a in range(0, len(letters), piece)])


def illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


def target(length: int) -> str:
    return "s" * (length % 2) + "ua" * (length // 2)


# ---------------------------------------------------------------- tables
def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with the faults that the checksum of (conv_id, turn) deals out."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), fault.alias("fault"))
    return (
        rows.filter("fault <> 0")
        .withColumn("text", F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", "role", "text")
    )


_WAY = "struct<before:int,after:int,cost:long,audit:string>"
PIECES = f"conv_id long, part long, no long, blank long, duplicate long, truncated long, illegal long, first string, last string, ways array<{_WAY}>"
REPAIRS = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ("before", "after", "cost", "audit")
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            letters = row["letters"]
            initials = letters.translate(_INITIAL)
            found = (_short_ways if len(letters) <= 64 else piece_ways)(letters)
            out.append(
                {k: row[k] for k in ("conv_id", "part", "no")}
                | {
                    "blank": sum(t in BLANKS for t in letters),
                    "duplicate": sum(t in DUPLICATES for t in letters),
                    "truncated": sum(t.isupper() for t in letters),
                    "illegal": illegal(initials),
                    "first": initials[0],
                    "last": initials[-1],
                    "ways": [dict(zip(fields, w, strict=True)) for w in found],
                }
            )
        yield pa.RecordBatch.from_pylist(out, PIECES_ARROW)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = ("blank", "duplicate", "truncated", "illegal")
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            pieces = row["pieces"]
            cost, audit = joined([[(w["before"], w["after"], w["cost"], w["audit"]) for w in p["ways"]] for p in pieces])
            total = {c: sum(p[c] for p in pieces) for c in counts}
            total["illegal"] += sum(illegal(a["last"] + b["first"]) for a, b in zip(pieces[:-1], pieces[1:], strict=True))
            out.append({"conv_id": row["conv_id"], **total, "cost": cost, "audit": audit})
        yield pa.RecordBatch.from_pylist(out, REPAIRS_ARROW)


_way = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_counts = [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
PIECES_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("no", pa.int64()), *_counts, ("first", pa.string()), ("last", pa.string()), ("ways", pa.list_(_way))]
)
REPAIRS_ARROW = pa.schema([("conv_id", pa.int64()), *_counts, ("cost", pa.int64()), ("audit", pa.string())])


def _letter() -> Column:
    """The letter of a turn from its columns initial, last (its text's last character that is not white space) and again."""
    kind = F.when(F.col("initial").isin(*INITIALS[:-1]), F.call_function("instr", F.lit(INITIALS), F.col("initial"))).otherwise(len(INITIALS))
    pick = lambda letters: F.substring(F.lit(letters), kind, F.lit(1))
    return (
        F.when(F.col("last") == "", pick(BLANKS))
        .when(F.col("again"), pick(DUPLICATES))
        .when(~F.col("last").isin(".", "!", "?"), pick(INITIALS.upper()))
        .otherwise(pick(INITIALS))
    )


def lined(turns: DataFrame) -> DataFrame:
    """``turns`` stored in order, with the range partition (``part``) and the place in it (``at``)."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "salt"]
    salted = turns.withColumn("salt", F.monotonically_increasing_id())
    rows = salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt").withColumn("at", F.monotonically_increasing_id())
    return stored(rows.withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}), "turns")


def repairs(rows: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) for every conversation of ``rows`` (see ``lined``)."""
    seen = Window.partitionBy("conv_id", "what").orderBy("part", "at")
    what = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    last = F.right(F.rtrim("text", F.lit(WHITE_SPACE)), F.lit(1))
    letters = (
        rows.select("conv_id", "part", "at", F.left("role", F.lit(1)).alias("initial"), last.alias("last"), what.alias("what"))
        .withColumn("again", F.row_number().over(seen) > 1)
        .select("conv_id", "part", "at", _letter().alias("letter"))
    )
    pieces = letters.groupBy("conv_id", "part", F.floor(F.col("at") / PIECE).alias("no")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "letter"))), lambda t: t["letter"]), "").alias("letters")
    )
    aligned = pieces.mapInArrow(_aligned, PIECES)
    one = F.struct("part", "no", "blank", "duplicate", "truncated", "illegal", "first", "last", "ways")
    by_conversation = aligned.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("pieces"))
    return by_conversation.mapInArrow(_joined, REPAIRS)


STREAM = "conv_id long, audit string, part long, at long, role string, text string"
_FULL = {"u": "user", "a": "assistant"}


def repaired_turns(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) turns of a conversation, from its audit and its turns in order."""
    symbols = iter(target(len(audit) - audit.count("D")))
    for edit in audit:
        if edit == "I":
            yield _FULL[next(symbols)], ""
            continue
        role, text = next(turns)
        if edit != "D":
            symbol = next(symbols)
            yield (role if edit == "K" else _FULL[symbol]), text


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256) from rows sorted by conversation: its audit, then its turns, one at a time."""
    rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")), strict=True))
    done, row = [], next(rows, None)
    while row is not None:
        conv_id, audit, digest, between = row[0], row[1], hashlib.sha256(), b""

        def turns():
            while (r := next(rows))[1] is None:  # as many as the audit asks for
                yield r[2], r[3]

        for role, text in repaired_turns(audit, turns()):
            digest.update(between + role.encode() + b":" + text.encode())
            between = b"\n"
        done.append((conv_id, digest.hexdigest()))
        row = next(rows, None)
        if len(done) == 10_000:
            yield _digests(done)
            done = []
    yield _digests(done)


def _digests(done: list[tuple[int | None, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["conv_id", "repaired_sha256"])


def structure_repairs(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every conversation of ``turns``, damaged first."""
    ship_package(turns.sparkSession)
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = lined(damaged(turns))
    found = repairs(rows)
    numbers = rows.groupBy("conv_id", "turn").count().groupBy("conv_id")
    gaps = numbers.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    zero = F.lit(0).cast("long")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    parts = [
        turns.select("conv_id").distinct().select("conv_id", *[zero.alias(c) for c in counts], F.lit("").alias("audit")),
        gaps.select("conv_id", "gaps", *[zero.alias(c) for c in counts[1:]], F.lit("").alias("audit")),
        found.select("conv_id", zero.alias("gaps"), *counts[1:], "audit"),
    ]
    # One of the three holds a conversation's value, the others zeros.
    judged = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("conv_id").agg(*[F.max(c).alias(c) for c in counts], F.max("audit").alias("audit"))
    judged = stored(judged, "turn-audits")
    none = F.lit(None).cast("string")
    stream = (
        judged.select("conv_id", "audit", F.lit(-1).cast("long").alias("part"), zero.alias("at"), none.alias("role"), none.alias("text"))
        .unionByName(rows.select("conv_id", none.alias("audit"), "part", "at", "role", "text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "at")
    )
    digests = stream.mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    digests = digests.withColumnRenamed("conv_id", "of")
    return judged.join(digests, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", *counts, "audit", "repaired_sha256")

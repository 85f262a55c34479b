"""Secrets in texts, with Spark expressions only.

Three patterns (``assign``, ``access``, ``hex``) find secrets of known forms.
The method adds those of unknown form: candidate strings are the runs of at
least ``WINDOW`` characters of ``CANDIDATE``, and over every candidate slides a
window of ``WINDOW`` characters.  For each character class the window's Shannon
entropy is kept up to date from counts: a step takes one character out of its
count and one in, and the sum of c * log2(c) changes by two table values.  (The
sum is kept in whole millionths, so that no rounding error gathers.)  A window
that lies within the class and reaches the class's bits is hot; the narrowest
class with a hot window names the span, from the first hot window's start to
the last one's end.

Allow-list: a candidate that matches one of ``ALLOWED`` (words, numbers, UUIDs,
documentation keys, alphabets), or that follows one of ``ALLOWED_BEFORE`` (names
of checksums and revisions), gives no span.  The list does not touch the three
patterns' spans; a span of the method may lie within one of theirs.

A text is one row and needs no other: the operator has no shuffle, and a long
text costs time in proportion to its length.  Positions are code points, ends
exclusive.  Defined cases: a null or empty text has no spans; repeated rows and
null ids are rows of their own; an empty table gives an empty result; columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import text_or_empty


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# ---- fixed values: patterns, classes and allow-list ------------------------------
_NAMES = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = "(?:" + "|".join(map(_either_case, _NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
#: Fewest characters: of the assigned value, of the two others' whole match.
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
BASE = ("assign", "access", "hex")

WINDOW = 20
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}" % WINDOW
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: (kind, characters of the class, bits of a hot window), narrowest first.
CLASSES = (
    ("entropy_hex", _DIGITS + "abcdefABCDEF", 3.0),
    ("entropy_alnum", _DIGITS + _LOWER + _UPPER, 3.7),
    ("entropy_base64", _DIGITS + _LOWER + _UPPER + "+/_=-", 3.8),
)
_CHECKSUM = "(?:md5|sha-?(?:1|224|256|384|512)|checksum|digest|etag|commit|revision|integrity)"
ALLOWED = (
    "(?i)^" + _CHECKSUM + "[=-]",
    "^[A-Za-z]+(?:[+/_=-]+[A-Za-z]+)*[+/_=-]*$",
    "^[0-9+/_=-]+$",
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "(?i)example|sample|dummy|placeholder|changeme|redacted",
    "(?i)0123456789|abcdefghij|qrstuvwxyz",
)
ALLOWED_BEFORE = ("(?i)" + _CHECKSUM + r"""["']?\x20*[:=(-]?\x20*["']?.$""",)
#: Characters before a candidate that ``ALLOWED_BEFORE`` sees, beside the candidate's first one.
BEFORE = 32
# -----------------------------------------------------------------------------------

_STEP = 256


def entropy_units(count: int) -> int:
    """``count * log2(count)`` in millionths."""
    return round(1e6 * count * math.log2(count)) if count else 0


def hot_limit(bits: float, window: int = WINDOW) -> int:
    """The largest sum of units that a window of at least ``bits`` of entropy has."""
    return math.floor(1e6 * window * (math.log2(window) - bits))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _sums(values: Column) -> Column:
    """The running sums of an int array, each with its own element, in steps of ``_STEP``."""
    part = lambda v, s, n: _total(F.slice(v, s + 1, n))
    of = lambda v: F.transform(
        F.array(F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / _STEP).cast("int")), lambda s: part(v, s * _STEP, F.lit(_STEP)))),
        lambda steps: F.transform(
            v,
            lambda _, i: _total(F.slice(steps, F.lit(1), F.floor(i / _STEP).cast("int")))
            + part(v, F.floor(i / _STEP).cast("int") * _STEP, i % _STEP + 1),
        ),
    )[0]
    return F.transform(F.array(values), of)[0]


def matches(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """``df`` with the array column ``name``: (start, value, before) of every leftmost non-overlapping match of ``pattern``.

    ``before`` is the text between the match before and this one.  The pieces
    between the matches and the matches themselves give the positions; texts
    without a match are looked at once.
    """
    found, between = f"{name}_found", f"{name}_between"
    df = df.withColumn(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    df = df.withColumn(between, F.when(F.size(found) > 0, F.split(text, pattern)))
    # What lies between a match's start and the start of the one before.
    advance = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        F.concat(F.array(F.lit("")), F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0)))),
        lambda b, m: F.length(b) + F.length(m),
    )
    zipped = F.transform(
        F.arrays_zip(_sums(advance).alias("start"), F.col(found).alias("value"), F.slice(between, F.lit(1), F.size(found)).alias("before")),
        lambda m: F.struct(m["start"].alias("start"), m["value"].alias("value"), m["before"].alias("before")),
    )
    none = F.array().cast("array<struct<start:int,value:string,before:string>>")
    return df.withColumn(name, F.when(F.size(found) > 0, zipped).otherwise(none)).drop(found, between)


def _hot(value: Column, alphabet: str, bits: float) -> Column:
    """(first, last): the last character of the first and of the last hot window of ``value``; null if there is none.

    Symbols are numbered from 1; 0 stands for what is not of the class, and for
    what lies before the value.
    """
    units = [entropy_units(c) for c in range(WINDOW + 1)]
    grow = F.array(*[F.lit(b - a).cast("long") for a, b in zip(units[:-1], units[1:], strict=True)])
    outside = F.array_repeat(F.lit(0), WINDOW)
    codes = F.transform(F.split(value, ""), lambda c: F.call_function("instr", F.lit(alphabet), c))
    steps = F.transform(
        F.array(codes),
        lambda v: F.arrays_zip(v.alias("into"), F.slice(F.concat(outside, v), F.lit(1), F.size(v)).alias("out")),
    )[0]
    start = F.struct(
        F.concat(F.array(F.lit(WINDOW)), F.array_repeat(F.lit(0), len(alphabet))).alias("counts"),
        F.lit(units[WINDOW]).cast("long").alias("sum"),
        F.lit(0).alias("at"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def step(state: Column, x: Column) -> Column:
        into, out = x["into"], x["out"]
        change = F.when(into == out, F.lit(0).cast("long")).otherwise(
            grow[state["counts"][into]] - grow[state["counts"][out] - 1]
        )
        moved = F.transform(state["counts"], lambda c, k: c + (k == into).cast("int") - (k == out).cast("int"))
        return F.struct(moved.alias("counts"), (state["sum"] + change).alias("sum"), state["at"].alias("at"), state["first"].alias("first"), state["last"].alias("last"))

    def judged(state: Column) -> Column:
        hot = (state["counts"][0] == 0) & (state["sum"] <= hot_limit(bits))
        return F.struct(
            state["counts"].alias("counts"),
            state["sum"].alias("sum"),
            (state["at"] + 1).alias("at"),
            F.coalesce(state["first"], F.when(hot, state["at"])).alias("first"),
            F.when(hot, state["at"]).otherwise(state["last"]).alias("last"),
        )

    # The new state is bound once: judging reads its counts and its sum.
    end = F.aggregate(steps, start, lambda state, x: F.transform(F.array(step(state, x)), judged)[0])
    return F.transform(F.array(end), lambda e: F.when(e["first"].isNotNull(), F.struct(e["first"].alias("first"), e["last"].alias("last"))))[0]


def _span(start: Column, end: Column, kind: int | Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, int) else kind
    return F.struct(start.cast("int").alias("start"), kind.cast("int").alias("kind"), end.cast("int").alias("end"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*BASE, *[c[0] for c in CLASSES])])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def secrets(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED, allowed_before: tuple[str, ...] = ALLOWED_BEFORE) -> DataFrame:
    """``doc_id, base, added`` for every row of ``docs``: the patterns' and the method's spans (start, kind, end) in order."""
    df = docs.select("doc_id", text_or_empty().cast("string").alias("t"))
    for name, pattern in (*zip(BASE, (ASSIGN, ACCESS, HEX.replace("+", "{%d,}" % HEX_LEAST)), strict=True), ("candidate", CANDIDATE)):
        df = matches(df, "t", pattern, name)
    valid = {
        "assign": lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 1)) >= ASSIGN_LEAST,
        "access": lambda m: F.length(m["value"]) >= ACCESS_LEAST,
        "hex": lambda m: F.length(m["value"]) >= HEX_LEAST,
    }

    def whole(kind: int):
        return lambda m: _span(m["start"], m["start"] + F.length(m["value"]), kind)

    base = [F.transform(F.filter(name, valid[name]), whole(k)) for k, name in enumerate(BASE)]

    def suspicious(m: Column) -> Column:
        out = F.lit(True)
        for pattern in allowed:
            out = out & ~m["value"].rlike(pattern)
        for pattern in allowed_before:
            out = out & ~F.concat(F.right(m["before"], F.lit(BEFORE)), F.left(m["value"], F.lit(1))).rlike(pattern)
        return out

    def within(m: Column, kind: int):
        return lambda h: F.when(h.isNotNull(), _span(m["start"] + h["first"] - (WINDOW - 1), m["start"] + h["last"] + 1, kind))

    def hot_span(m: Column) -> Column:
        tried = [
            F.transform(F.array(_hot(m["value"], alphabet, bits)), within(m, len(BASE) + k))[0]
            for k, (_, alphabet, bits) in enumerate(CLASSES)
        ]
        return F.coalesce(*tried)

    added = F.filter(F.transform(F.filter("candidate", suspicious), hot_span), lambda s: s.isNotNull())
    return df.select("doc_id", F.array_sort(F.concat(*base)).alias("base"), F.array_sort(added).alias("added"))


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans) for every row of ``docs``."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return secrets(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(BASE)],
        F.size("added").cast("long").alias("n_entropy"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _oracle() -> str:
    """The same in DuckDB: every window's entropy is counted anew."""

    def found(name: str, pattern: str) -> str:
        p = _quoted(pattern)
        return f"""
        {name}_m AS (SELECT row_no, unnest(m) AS value, generate_subscripts(m, 1) AS i, s, m AS all_m
            FROM (SELECT row_no, regexp_extract_all(t, {p}, 0) AS m, string_split_regex(t, {p}) AS s FROM d)),
        {name} AS (SELECT row_no, value, s[i] AS before,
            (list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(all_m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start
            FROM {name}_m)"""

    hot = []
    for k, (_, alphabet, bits) in enumerate(CLASSES):
        inside = _quoted("[" + alphabet.replace("-", "") + ("-" if "-" in alphabet else "") + "]+")
        hot.append(f"(SELECT row_no, start, {k} AS class, w FROM windows WHERE regexp_full_match(win, {inside}) AND units <= {hot_limit(bits)})")
    allowed = " AND ".join(
        [f"NOT regexp_matches(value, {_quoted(p)})" for p in ALLOWED] + [f"NOT regexp_matches(right(before, {BEFORE}) || left(value, 1), {_quoted(p)})" for p in ALLOWED_BEFORE]
    )
    names = "[" + ", ".join(_quoted(k) for k in (*BASE, *[c[0] for c in CLASSES])) + "]"
    joined = f"string_agg({names}[kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop)"
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t FROM documents),
        {found("assign", ASSIGN)}, {found("access", ACCESS)}, {found("hex", HEX)}, {found("candidate", CANDIDATE)},
        spans AS (
            SELECT row_no, start, start + length(value) AS stop, 0 AS kind FROM assign
                WHERE length(regexp_extract(value, {_quoted(ASSIGN)}, 1)) >= {ASSIGN_LEAST}
            UNION ALL SELECT row_no, start, start + length(value), 1 FROM access WHERE length(value) >= {ACCESS_LEAST}
            UNION ALL SELECT row_no, start, start + length(value), 2 FROM hex WHERE length(value) >= {HEX_LEAST}),
        places AS (SELECT row_no, start, value, unnest(range(length(value) - {WINDOW - 1})) AS w FROM candidate WHERE {allowed}),
        windows AS (
            SELECT row_no, start, w, win, sum(round(1e6 * c * log2(c)))::BIGINT AS units
            FROM (SELECT row_no, start, w, win, ch, count(*) AS c
                  FROM (SELECT row_no, start, w, substr(value, w + 1, {WINDOW}) AS win, unnest(string_split(win, '')) AS ch FROM places)
                  GROUP BY ALL) GROUP BY ALL),
        hot AS ({" UNION ALL ".join(hot)}),
        added AS (
            SELECT row_no, start + min(w) AS start, start + max(w) + {WINDOW} AS stop, {len(BASE)} + class AS kind
            FROM hot JOIN (SELECT row_no, start, min(class) AS class FROM hot GROUP BY ALL) USING (row_no, start, class)
            GROUP BY row_no, hot.start, class),
        base AS (SELECT row_no, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c, {joined} AS j
                 FROM spans GROUP BY row_no),
        whole AS (SELECT row_no, {joined} AS j FROM (FROM spans UNION ALL SELECT row_no, start, stop, kind FROM added) GROUP BY row_no),
        more AS (SELECT row_no, count(*) AS n FROM added GROUP BY row_no)
    SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, coalesce(n, 0) AS n_entropy,
           sha256(coalesce(base.j, '')) AS base_sha256, coalesce(whole.j, '') AS spans
    FROM d LEFT JOIN base USING (row_no) LEFT JOIN whole USING (row_no) LEFT JOIN more USING (row_no)
    """


ORACLE = _oracle()

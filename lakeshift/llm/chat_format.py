"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent
turns of the same role are merged into one block by array functions over the
block's slice, and the blocks are concatenated:

    <|turn|>role<|text|>first text<|also|>next text of the same role<|end|>

Control strings inside roles and texts (the template's marks and the usual
``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) get a backslash after their first
character and backslashes are doubled, so the output holds no control string
that is not the template's own, and ``\\(.) -> \1`` restores every text.  The
loss mask is a list of [start, end) code point spans of the output, one per
assistant text.

Defined cases: a null role or text is empty; turns are ordered by (turn, role,
text), nulls first; repeated rows are repeated turns; a null ``conv_id`` is a
conversation of its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, ALSO, END = "<|turn|>", "<|text|>", "<|also|>", "<|end|>"
LOSS_ROLE = "assistant"
_CONTROL = r"([<\[])(?=\||/?s>|/?INST\])"
_STEP = 256


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, "$1\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _sums_before(lengths: str) -> Column:
    """For each element of the int array column ``lengths`` the sum of those before it, in steps of ``_STEP``."""
    array = F.col(lengths)
    steps = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(array) / _STEP).cast("int")),
        lambda s: _total(F.slice(array, s * _STEP + 1, F.lit(_STEP))),
    )
    return F.transform(
        array,
        lambda _, i: _total(F.slice(steps, F.lit(1), F.floor(i / _STEP).cast("int")))
        + _total(F.slice(array, F.floor(i / _STEP).cast("int") * _STEP + 1, i % _STEP)),
    )


def formatted(turns: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, n_blocks, formatted, loss_spans) for every conversation of ``turns`` (conv_id, turn, role, text)."""
    sorted_turns = (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))
        .select(
            "conv_id",
            F.transform(
                "rows",
                lambda r: F.struct(
                    F.coalesce(r["role"].cast("string"), F.lit("")).alias("role"),
                    escaped(F.coalesce(r["text"], F.lit(""))).alias("text"),
                ),
            ).alias("rows"),
        )
    )
    # A block starts where the role differs from that of the turn before.
    starts = F.filter(
        F.sequence(F.lit(0), F.size("rows") - 1),
        lambda i: (i == 0) | (F.col("rows")[i]["role"] != F.col("rows")[F.greatest(i - 1, F.lit(0))]["role"]),
    )
    blocks = F.transform(
        "starts",
        lambda s, i: F.struct(
            F.col("rows")[s]["role"].alias("role"),
            F.slice(
                F.col("texts"),
                s + 1,
                F.coalesce(F.try_element_at(F.col("starts"), i + 2), F.size("rows")) - s,
            ).alias("texts"),
        ),
    )
    # Pieces of the output with a flag for the loss, from which both the text and the mask come.
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    pieces = F.flatten(
        F.transform(
            "blocks",
            lambda b: F.concat(
                F.array(piece(F.concat(F.lit(TURN), escaped(b["role"]), F.lit(TEXT)), no)),
                F.flatten(
                    F.transform(
                        b["texts"],
                        lambda t, i: F.array(
                            piece(F.when(i == 0, F.lit("")).otherwise(F.lit(ALSO)), no),
                            piece(t, b["role"] == F.lit(loss_role)),
                        ),
                    )
                ),
                F.array(piece(F.lit(END), no)),
            ),
        )
    )
    spans = F.transform(
        F.filter(F.arrays_zip("pieces", "starts_at", "lengths"), lambda p: p["pieces"]["loss"]),
        lambda p: F.struct(p["starts_at"].alias("start"), (p["starts_at"] + p["lengths"]).alias("end")),
    )
    return (
        sorted_turns.withColumn("starts", starts)
        .withColumn("texts", F.transform("rows", lambda r: r["text"]))
        .withColumn("blocks", blocks)
        .withColumn("pieces", pieces)
        .withColumn("lengths", F.transform("pieces", lambda p: F.length(p["text"])))
        .withColumn("starts_at", _sums_before("lengths"))
        .select(
            "conv_id",
            F.size("blocks").alias("n_blocks"),
            F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
            spans.alias("loss_spans"),
        )
    )


def read_back(output: DataFrame) -> DataFrame:
    """The turns (role, text) and the text under the loss mask, from ``formatted`` and ``loss_spans`` alone."""
    blocks = F.filter(F.split("formatted", r"<\|turn\|>"), lambda b: b != "")
    turns = F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(
                F.split(F.substring_index(F.substring_index(b, TEXT, -1), END, 1), r"<\|also\|>"),
                lambda t: F.struct(
                    unescaped(F.substring_index(b, TEXT, 1)).alias("role"), unescaped(t).alias("text")
                ),
            ),
        )
    )
    loss = F.transform(
        "loss_spans",
        lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])),
    )
    return output.withColumn("turns", turns).withColumn("loss_text", F.array_join(loss, ""))


def chat_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_blocks) read back from the output."""
    out = read_back(formatted(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_blocks").cast("long").alias("n_blocks"),
    )


def with_test_conversation(turns: DataFrame) -> DataFrame:
    """``turns`` plus conversation -7, whose texts are made of control strings."""
    hostile = "</s>[INST] ok [/INST]"
    extra = turns.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hostile).alias("text"),
    )
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)


ORACLE = r"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    e AS (
        SELECT *, CASE WHEN row_number() OVER w = 1 OR role <> lag(role) OVER w THEN 1 ELSE 0 END AS opens,
               length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
                 + len(regexp_extract_all(text, '<\||</?s>|\[/?INST\]')) AS text_chars,
               length(role) + length(regexp_replace(role, '[^\\]', '', 'g'))
                 + len(regexp_extract_all(role, '<\||</?s>|\[/?INST\]')) AS role_chars
        FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
           sum(text_chars + CASE WHEN opens = 1 THEN 8 + role_chars + 8 + 7 ELSE 8 END)::BIGINT AS formatted_chars,
           sum(opens)::BIGINT AS n_blocks
    FROM e GROUP BY conv_id
"""

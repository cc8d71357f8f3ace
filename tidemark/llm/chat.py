"""Chat formatting with DataFrame expressions only.

The turns of a conversation are collected as structs, sorted, merged into blocks of one role, and
written between markers::

    user       [INST] text [/INST]
    assistant  <s>text</s>
    any other  [ROLE:name] text [/ROLE]

Turns merged into one block stay apart by ``[NEXT]``. A marker inside a text gets a backslash behind
its first character, and one more if it has some already, so unescaping takes exactly one away and
every text comes back. ``segments`` holds the same output in pieces; those with ``in_loss`` are the
assistant texts.

Edge cases: NULL text and NULL role are empty; equal turn numbers are ordered by role, then text;
a NULL turn comes first; a NULL conv_id is a conversation; repeated rows are repeated turns; an
empty table gives no row; other columns are ignored. A conversation is one output row, so it has to fit
into a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let

_TAIL = r"/?s>|/?INST\]|NEXT\]|ROLE:|/ROLE\]"
_BLOCK = r"(?s)(?:<s>|\[INST\] |\[ROLE:[^\]]*\] ).*?(?:</s>| \[/INST\]| \[/ROLE\])"
_NEXT = "[NEXT]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_TAIL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_TAIL})", "$1$2$3")


def _opening(role: Column) -> Column:
    return (
        F.when(role == "assistant", F.lit("<s>"))
        .when(role == "user", F.lit("[INST] "))
        .otherwise(F.concat(F.lit("[ROLE:"), F.url_encode(role), F.lit("] ")))
    )


def _closing(role: Column) -> Column:
    return F.when(role == "assistant", F.lit("</s>")).when(role == "user", F.lit(" [/INST]")).otherwise(F.lit(" [/ROLE]"))


def _segment(text: Column, in_loss: Column) -> Column:
    return F.struct(text.alias("text"), in_loss.alias("in_loss"))


def _blocks(turns: Column) -> Column:
    """Adjacent turns of one role as (role, array of escaped texts)."""

    def build(turns: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(turns) - 1),
            lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
        )
        return let(
            starts,
            lambda starts: F.transform(
                starts,
                lambda s, k: F.struct(
                    F.get(turns, s)["role"].alias("role"),
                    F.transform(
                        F.slice(turns, s + 1, F.coalesce(F.get(starts, k + 1), F.size(turns)) - s),
                        lambda t: escape(t["text"]),
                    ).alias("texts"),
                ),
            ),
        )

    return let(turns, build)


def _segments(block: Column) -> Column:
    trained = block["role"] == "assistant"
    no = F.lit(False)
    pieces = F.flatten(
        F.transform(
            block["texts"],
            lambda t, i: F.when(i == 0, F.array(_segment(t, trained))).otherwise(
                F.array(_segment(F.lit(_NEXT), no), _segment(t, trained))
            ),
        )
    )
    return F.concat(
        F.array(_segment(_opening(block["role"]), no)), pieces, F.array(_segment(_closing(block["role"]), no))
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, segments) of (conv_id, turn, role, text)."""
    turn = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = rows.select("conv_id", F.flatten(F.transform(_blocks(F.col("turns")), _segments)).alias("segments"))
    return rows.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def _read_block(block: Column) -> Column:
    """The turns of one block of the formatted text."""
    role = (
        F.when(F.startswith(block, F.lit("<s>")), F.lit("assistant"))
        .when(F.startswith(block, F.lit("[INST] ")), F.lit("user"))
        .otherwise(F.url_decode(F.regexp_extract(block, r"^\[ROLE:([^\]]*)\] ", 1)))
    )

    def turns(role: Column) -> Column:
        before, behind = F.length(_opening(role)), F.length(_closing(role))
        body = F.substring(block, before + 1, F.length(block) - before - behind)
        return F.transform(
            F.split(body, r"\[NEXT\]", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return let(role, turns)


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> back from a formatted conversation."""
    return F.flatten(F.transform(F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(0)), _read_block))


def loss_text(segments: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["in_loss"]), lambda s: unescape(s["text"])), "")

"""Conversation structure repair by iterative-deepening A*.

A repaired conversation has roles with the initials ``(s?(ua)+)?``: at most one system turn, then pairs of user and assistant. Edits
turn the rows of a conversation into one: Keep a row (K, cost 0), Rerole it to user or assistant (R, 1), Delete it
(D, 2), Insert an empty user or assistant turn anywhere (I, 5). Blank and duplicate rows have to be deleted; a truncated row that
stays costs 5 more.

The cheapest edits are found by depth-first search in the ASCII order of the edits under a cost bound, which starts at
the estimate for the whole conversation and rises to the least cost that exceeded it. The first accepting path within
the bound is the answer: no bound before it could reach an end, and the order makes it the least of equal cost. A
state is a row number and the role of the last turn. A state that failed enters the transposition table with
the cost that any way from it must exceed, and is not opened again until the bound allows more. The estimate for a state
is the cost of the same rows under weaker rules (turns alternate, with any beginning and end, and a system turn fits
anywhere); it never exceeds the real cost, so the search opens few states: work grows about in proportion to the rows.

Rows of a conversation are taken by turn (NULL first), then role and text. They stream through one task sorted by
conversation, so a task holds the rows of one conversation at a time, which have to fit.

Edge cases: NULL role and text are one blank, so such a text is a blank row; a NULL conv_id is a conversation;
repeated rows are duplicates; turns whose role begins with none of s, u, a can only be reroled or deleted;
a conversation whose rows are all marked as gone has zeros, no edits and the hash of an empty text; an empty table gives no row;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ACCEPTING = (_START, _ASSISTANT)
#: the state behind a user or assistant turn put behind a state
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_LEGAL = {"su", "ua", "au"}


class Row(NamedTuple):
    role: str
    text: str
    #: blank, duplicate, truncated or None
    fault: str | None


def _steps(row: Row, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, following state) of the edits that use a row, in ASCII order. Insert stands between Delete and these."""
    if row.fault in ("blank", "duplicate"):
        return
    more = TRUNCATED if row.fault == "truncated" else 0
    following = _NEXT[state]
    initial = row.role[:1]
    if initial == "s" and state == _START:
        yield "K", more, _SYSTEM
    elif initial == "ua"[following == _ASSISTANT]:
        yield "K", more, following
    yield "R", more + REROLE, following


def _estimates(rows: list[Row]) -> list[tuple[int, int, int, int]]:
    """Least cost of the rows from each place on, by state, under weaker rules; see the module text."""
    user, assistant = 0, 0  # the next turn has to be a user, an assistant; both ends are free
    out = [(user, user, assistant, user)]
    for row in reversed(rows):
        best = []
        for role, stay, change in (("u", user, assistant), ("a", assistant, user)):
            cost = DELETE + stay
            if row.fault not in ("blank", "duplicate"):
                more = TRUNCATED if row.fault == "truncated" else 0
                cost = min(cost, more + REROLE + change)
                if row.role[:1] == role:
                    cost = min(cost, more + change)
                elif row.role[:1] == "s":
                    cost = min(cost, more + stay)
            best.append(cost)
        user, assistant = min(best[0], best[1] + INSERT), min(best[1], best[0] + INSERT)
        out.append((user, user, assistant, user))
    return out[::-1]


def _edges(rows: list[Row], at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, place, state) of all edits from a state, in ASCII order."""
    if at < len(rows):
        yield "D", DELETE, at + 1, state
    yield "I", INSERT, at, _NEXT[state]
    if at < len(rows):
        for edit, cost, following in _steps(rows[at], state):
            yield edit, cost, at + 1, following


def search(rows: list[Row]) -> tuple[int, str]:
    """(cost, edits) of the cheapest repair, the ASCII-least of equal cost."""
    estimates = _estimates(rows)
    least: dict[tuple[int, int], int] = {}  # transposition table: cost that a failed state needs at least
    bound = estimates[0][_START]
    while True:
        # a stack of open states: place, state, cost so far, edits still to try, least cost over the bound seen below
        path: list[str] = []
        stack = [[0, _START, 0, _edges(rows, 0, _START), None]]
        if not rows:
            return 0, ""
        while stack:
            top = stack[-1]
            at, state, cost = top[0], top[1], top[2]
            for edit, price, to, following in top[3]:
                spent = cost + price
                rest = least.get((to, following), estimates[to][following])
                if spent + rest > bound:
                    top[4] = price + rest if top[4] is None else min(top[4], price + rest)
                    continue
                path.append(edit)
                if to == len(rows) and following in _ACCEPTING:
                    return spent, "".join(path)
                stack.append([to, following, spent, _edges(rows, to, following), None])
                break
            else:
                least[at, state] = top[4]
                stack.pop()
                if stack:
                    path.pop()
                    edge = cost - stack[-1][2] + top[4]
                    stack[-1][4] = edge if stack[-1][4] is None else min(stack[-1][4], edge)
        bound = least[0, _START]


def apply_edits(rows: list[Row], edits: str) -> list[tuple[str, str]]:
    """(role, text) of each turn after the edits."""
    state, at, out = _START, 0, []
    for edit in edits:
        role = "assistant" if _NEXT[state] == _ASSISTANT else "user"
        if edit == "I":
            out.append((role, ""))
            state = _NEXT[state]
            continue
        row, at = rows[at], at + 1
        if edit == "K":
            out.append((row.role, row.text))
            state = _SYSTEM if row.role[:1] == "s" else _NEXT[state]
        elif edit == "R":
            out.append((role, row.text))
            state = _NEXT[state]
    return out


_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def with_faults(turns: list[tuple[str, str]]) -> list[Row]:
    """Rows with their first fault: blank, seen earlier, or not ended by a mark."""
    seen, rows = set(), []
    for role, text in turns:
        body = text.rstrip(_SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        rows.append(Row(role, text, fault))
    return rows


def report(turns: list[tuple[int | None, str, str]]) -> dict[str, object]:
    """Gaps, faults, cheapest edits and repaired turns of the rows (turn, role, text) of one conversation."""
    numbers = {t for t, _, _ in turns if t is not None}
    rows = with_faults([(role, text) for _, role, text in turns])
    cost, edits = search(rows)
    initials = [r.role[:1] for r in rows]
    count = lambda fault: sum(r.fault == fault for r in rows)
    return {
        "gaps": max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
        "blank": count("blank"),
        "duplicate": count("duplicate"),
        "truncated": count("truncated"),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": edits,
        "repaired": [{"role": role, "text": text} for role, text in apply_edits(rows, edits)],
    }


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = pa.schema(
    [(name, pa.int64()) for name in _COUNTS]
    + [("audit", pa.string()), ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]
)
_CHARACTERS = 4_000_000


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[int | None, str, str]]]]:
    """(conv_id, rows that are not gone) of sorted batches, one conversation at a time."""
    current, rows, begun = None, [], False
    for batch in batches:
        for conv, turn, role, text, gone in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if begun and conv != current:
                yield current, rows
                rows = []
            current, begun = conv, True
            if not gone:
                rows.append((turn, role, text))
    if begun:
        yield current, rows


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired: one row per conversation.

    ``turns`` has conv_id, turn, role, text; rows with a true ``gone``, if there is that column, only name
    their conversation.
    """
    gone = F.coalesce("gone", F.lit(False)) if "gone" in turns.columns else F.lit(False)
    text_of = lambda name: F.coalesce(F.col(name), F.lit(" ")).alias(name)
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), text_of("role"), text_of("text"), gone.alias("gone"))
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, size, kind = [], [], 0, None

        def flushed() -> pa.RecordBatch:
            body = pa.RecordBatch.from_pylist(found, _REPORT)
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), *body.columns], names=["conv_id", *_REPORT.names])

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field(0).type
                yield batch

        for conv, each in _conversations(typed()):
            ids.append(conv)
            found.append(report(each))
            size += sum(len(text) for _, _, text in each) + 100
            if size > _CHARACTERS:
                yield flushed()
                ids, found, size = [], [], 0
        if ids:
            yield flushed()

    fields = ", ".join(f"{name} bigint" for name in _COUNTS)
    schema = f"conv_id {id_type}, {fields}, audit string, repaired array<struct<role:string,text:string>>"
    # not to a number of partitions: AQE may join small ones, and sorting happens behind that
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInArrow(run, schema)


def repaired_digest() -> Column:
    """Hash of the repaired turns as ``role:text`` lines."""
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return F.sha2(F.array_join(lines, "\n"), 256)

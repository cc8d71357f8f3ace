"""Repeated passages by sparse suffix arrays.

Suffixes are kept at content-selected places only: where the hash of the next ``anchor`` words is the smallest of a
window, with the window so wide that every passage of ``least`` words has such a place with the anchor inside
the passage. Equal passages so have equal suffixes. Suffixes whose anchor occurs once are left out; the
others take the hashed words around along: up to ``least`` words from the place on and those before it that
can belong to a passage with it. They are sorted by anchor and content, neighbours are compared and the
matches extended to the left and right. For each length to the left, suffixes that agree on that many words before
their place are neighbours in the order of their right sides, and the nearest neighbour has the longest match: so
every passage of ``least`` words or more that occurs twice, in one document or in two, is found, and
nothing else. ``spans`` unites the matches of a document.

Equal texts are one text with its suffixes. An anchor with more than ``largest`` suffixes is not compared in one
task: its passages are counted by hash instead, which finds the same spans, sums up before the shuffle and can be
split.

Words are compared as 64-bit hashes of their lower-case bytes. Edge cases: NULL and empty texts and texts shorter than a
passage have no span; a NULL doc_id is a document; repeated rows repeat each other's passages; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_key
from tidemark.llm.mixing import size_of
from tidemark.llm.runs import complete_runs, with_neighbours
from tidemark.llm.shingles import Words, minima, mixed, rolling
from tidemark.session import stored

LEAST = 50
ANCHOR = 26


def places(words: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash of the anchor there) of the suffixes kept of a text."""
    if len(words) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = rolling(words, anchor)
    kept = minima(hashes, least - anchor + 1)
    return kept, hashes[kept]


def contexts(words: np.ndarray, at: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) words around each place, 0 where the text ends: ``least - anchor`` before it, nearest first,
    and ``least`` from it on."""
    before = least - anchor
    padded = np.concatenate([np.zeros(before, np.uint64), words, np.zeros(least, np.uint64)])
    left = padded[at[:, None] + np.arange(before - 1, -1, -1)[None, :]]
    right = padded[at[:, None] + before + np.arange(least)[None, :]]
    return left, right


class Seen(set):
    """Texts a task has met, by hash; emptied when it holds too many."""

    def first(self, key: tuple[int, int]) -> bool:
        if key in self:
            return False
        if len(self) >= 500_000:
            self.clear()
        self.add(key)
        return True


def _anchor_batches(least: int, anchor: int):
    """(anchor, ka, kb, place) of the suffixes of (ka, kb, text); each different text once a task."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = Words(), Seen()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = [c.to_pylist() for c in batch.slice(at, 256).columns]
                found = [
                    (a, b, *places(words.of(text), least, anchor)) for a, b, text in zip(*rows, strict=True) if seen.first((a, b))
                ]
                sizes = [len(f[2]) for f in found]
                if not sum(sizes):
                    continue
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([f[3] for f in found]).view(np.int64)),
                        pa.array(np.repeat(np.array([f[0] for f in found], np.int64), sizes)),
                        pa.array(np.repeat(np.array([f[1] for f in found], np.int64), sizes)),
                        pa.array(np.concatenate([f[2] for f in found]).astype(np.int32)),
                    ],
                    names=["anchor", "ka", "kb", "place"],
                )

    return batches_of


def _repeated_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from with_neighbours(batches, "anchor")


def binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]).cast(pa.binary())


def _suffix_batches(least: int, anchor: int):
    """(anchor, content, ka, kb, place, is_hot) of (ka, kb, text, wanted places with their anchor and is_hot)."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for ka, kb, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashed = words.of(text)
                for i in range(0, len(wanted), 2000):
                    some = wanted[i : i + 2000]
                    left, right = contexts(hashed, np.array([w["place"] for w in some], np.int64), least, anchor)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([w["anchor"] for w in some], pa.int64()),
                            binary(np.concatenate([right, left], axis=1)),
                            pa.array([ka] * len(some), pa.int64()),
                            pa.array([kb] * len(some), pa.int64()),
                            pa.array([w["place"] for w in some], pa.int32()),
                            pa.array([w["is_hot"] for w in some], pa.bool_()),
                        ],
                        names=["anchor", "content", "ka", "kb", "place", "is_hot"],
                    )

    return batches_of


_PAIRS = 48


def _agreement(words: np.ndarray) -> np.ndarray:
    """(n, n) numbers of leading words that each two rows have in common; a zero agrees with nothing."""
    equal = (words[:, None, :] == words[None, :, :]) & (words != 0)[:, None, :]
    return np.where(equal.all(axis=2), words.shape[1], (~equal).argmax(axis=2))


def longest_passages(right: np.ndarray, left: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(words to the left, words to the right) of each suffix's repeated passages around its place, (0, 0) for none.

    ``right`` and ``left`` hold the words of the suffixes of one anchor, a row each. Zero marks the
    end of a text and never matches.
    """
    n, before = len(right), left.shape[1]
    far_left, far_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n <= _PAIRS:
        # few suffixes: every pair at once, from the place to the right and to the left
        ahead, back = _agreement(right), _agreement(left)
        good = (ahead + back >= least) & ~np.eye(n, dtype=bool)
        return np.where(good, back, 0).max(axis=1), np.where(good, ahead, 0).max(axis=1)
    order = np.lexsort([right[:, k] for k in range(right.shape[1] - 1, -1, -1)])
    group = np.zeros(n, np.int64)  # of suffixes that agree on the words before their place so far
    for reach in range(before + 1):
        if reach:
            word = left[:, reach - 1]
            group = np.unique(np.stack([group.astype(np.uint64), word], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
            group[word == 0] = -1 - np.flatnonzero(word == 0)  # a text that has ended agrees with none
            if len(np.unique(group)) == n:
                break
        sorted_by = order[np.argsort(group[order], kind="stable")]
        a, b = sorted_by[:-1], sorted_by[1:]
        same = (group[a] == group[b]) & (group[a] >= 0)
        a, b = a[same], b[same]
        equal = (right[a] == right[b]) & (right[a] != 0)
        match = np.where(equal.all(axis=1), right.shape[1], (~equal).argmax(axis=1))
        good = match + reach >= least
        for side in (a[good], b[good]):
            np.maximum.at(far_left, side, reach)
            np.maximum.at(far_right, side, match[good])
    return far_left, far_right


def _passage_batches(least: int, anchor: int):
    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * least - anchor
        for columns, starts in complete_runs(batches, ("anchor",)):
            words = np.frombuffer(b"".join(columns["content"]), np.uint64).reshape(-1, width)
            found = [
                longest_passages(words[a:b, :least], words[a:b, least:], least)
                for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)
            ]
            left, right = (np.concatenate(x) for x in zip(*found, strict=True))
            keep = left + right >= least
            start = columns["place"][keep] - left[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns["ka"][keep]),
                    pa.array(columns["kb"][keep]),
                    pa.array(start.astype(np.int32)),
                    pa.array((columns["place"][keep] + right[keep]).astype(np.int32)),
                ],
                names=["ka", "kb", "start", "end"],
            )

    return batches_of


def _window_batches(least: int, anchor: int):
    """(window, ka, kb, start): hashes of the passages of ``least`` words that hold the anchor of each suffix."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = least - anchor
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                content, ka, kb, place = batch.slice(at, 1000).columns
                words = np.frombuffer(b"".join(content.to_pylist()), np.uint64).reshape(-1, before + least)
                line = np.concatenate([words[:, least:][:, ::-1], words[:, :least]], axis=1)
                for reach in range(before + 1):
                    window = line[:, before - reach : before - reach + least]
                    whole = (window != 0).all(axis=1)
                    total = np.zeros(len(window), np.uint64)
                    for k in range(least):
                        total = mixed(total + window[:, k], k)
                    keep = pa.array(whole)
                    start = place.to_numpy()[whole] - reach
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(total[whole].view(np.int64)), ka.filter(keep), kb.filter(keep), pa.array(start.astype(np.int32))],
                        names=["window", "ka", "kb", "start"],
                    )

    return batches_of


def _of_frequent(suffixes: DataFrame, least: int, anchor: int) -> DataFrame:
    """Spans around places whose anchor is frequent: passages are counted by hash, with partial counts before the shuffle."""
    windows = suffixes.select("content", "ka", "kb", "place").mapInArrow(
        _window_batches(least, anchor), "window long, ka long, kb long, start int"
    )
    windows = stored(windows, "windows")
    here = F.struct("ka", "kb", "start")
    twice = windows.groupBy("window").agg(F.min(here).alias("a"), F.max(here).alias("b")).where("a <> b").select("window")
    # stored, so that both sides of the join are plain shuffles, which can be split where a passage is frequent
    return windows.join(stored(twice, "twice"), "window").select("ka", "kb", "start", (F.col("start") + least).cast("int").alias("end"))


def united(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or touching spans (start, end) of each key as one."""
    before = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int")
    numbered = spans.withColumn("_opens", opens).withColumn("_no", F.sum("_opens").over(upto))
    return numbered.groupBy(*keys, "_no").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_no")


def text_spans(docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR, largest: int = 50_000) -> DataFrame:
    """(ka, kb, start, end): repeated passages of each different text of ``docs`` (ka, kb, text)."""
    rows = docs.select("ka", "kb", "text").mapInArrow(_anchor_batches(least, anchor), "anchor long, ka long, kb long, place int")
    together = rows.repartition("anchor").sortWithinPartitions("anchor")
    repeated = together.mapInArrow(_repeated_batches, "anchor long, ka long, kb long, place int")
    repeated = stored(repeated.distinct(), "repeated")
    frequent = repeated.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > largest).select("anchor", F.lit(True).alias("is_hot"))
    wanted = (
        repeated.join(frequent, "anchor", "left")
        .groupBy("ka", "kb")
        .agg(F.collect_list(F.struct("anchor", "place", F.coalesce("is_hot", F.lit(False)).alias("is_hot"))).alias("wanted"))
    )
    texts = docs.select("ka", "kb", "text").dropDuplicates(["ka", "kb"]).join(wanted, ["ka", "kb"])
    suffixes = stored(
        texts.select("ka", "kb", "text", "wanted").mapInArrow(
            _suffix_batches(least, anchor), "anchor long, content binary, ka long, kb long, place int, is_hot boolean"
        ),
        "suffixes",
    )
    ordinary = suffixes.where("not is_hot").drop("is_hot").repartition("anchor").sortWithinPartitions("anchor")
    found = ordinary.mapInArrow(_passage_batches(least, anchor), "ka long, kb long, start int, end int")
    return united(found.unionByName(_of_frequent(suffixes.where("is_hot"), least, anchor)), ["ka", "kb"])


def spans(docs: DataFrame, least: int = LEAST, anchor: int = ANCHOR, largest: int = 50_000) -> DataFrame:
    """doc_id, start, end (words, end exclusive) of every stretch covered by repeated passages."""
    key = text_key(F.col("text"))
    keyed = docs.where("text is not null").select("doc_id", "text", key["a"].alias("ka"), key["b"].alias("kb"))
    found = text_spans(keyed, least, anchor, largest)
    # the whole of a text that several rows have is repeated
    copies = keyed.groupBy("ka", "kb").agg(F.count("*").alias("n"), F.max(size_of(F.col("text"))).alias("size"))
    copies = copies.where((F.col("n") > 1) & (F.col("size") >= least))
    whole = copies.select("ka", "kb", F.lit(0).alias("start"), F.col("size").cast("int").alias("end"))
    every = united(found.unionByName(whole), ["ka", "kb"])
    return keyed.select("doc_id", "ka", "kb").join(every, ["ka", "kb"]).select("doc_id", "start", "end")

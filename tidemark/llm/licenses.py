"""License scans: an exact set-similarity join of license templates with the blocks of all texts.

Words are runs of ASCII digits, ASCII letters in lower case and characters beyond ASCII. A block is a sentence: it
ends behind ``.``, ``!`` or ``?`` with white space, or at a blank line. A sentence of more than twice the words of
the longest template is cut into windows of that length, each beginning in the middle of the one before, so that a
passage as long as a template lies whole in one of them. A block is taken as the set of its words, and only words of some
template matter. ``matches`` finds every block that holds at least ``threshold`` of the words of a template:

* words are ordered by their number of blocks in the whole corpus, the rarest first;
* *length*: a block with fewer words than a template needs is no partner of it;
* *prefix*: a template of n words of which k must be found shares one of its n - k + 1 rarest words with each partner, and
  that word is among the first |block| - k + 1 of the block;
* *positions*: the words behind the shared ones must suffice on both sides;
* the pairs left are verified by their whole sets.

The filters lose nothing: the first common word of a pair that meets the threshold passes all of them. The prefixes
of the templates are a parameter's size and are broadcast; the blocks are spread over tasks by document and are never
grouped by word, so no frequent word is a hot key. A template names the words that tell it from others of
its kind; ``labels`` take only blocks that hold those too.

Edge cases: NULL text is empty; an empty text has no word, no place (NULL) and no label; repeated rows are told apart
and each gives its own row; NULL doc_id stays NULL; equal frequencies are ordered by word; an empty table gives no row; other
columns are ignored. Very long texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from math import ceil
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


class Template(NamedTuple):
    label: str
    #: words a block has to hold for the label, in lower case
    named_by: str
    text: str


#: Phrases whose places are counted, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Sentences by which licenses are granted.
TEMPLATES = (
    Template("agpl", "affero", "licensed under the GNU Affero General Public License version 3"),
    Template("apache", "apache", "licensed under the Apache License Version 2 0"),
    Template("apache", "compliance", "you may not use this file except in compliance with the License"),
    Template("bsd", "bsd", "licensed under the BSD 3 Clause License"),
    Template("bsd", "redistribution", "Redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc", "cc by", "licensed under CC BY NC 4 0"),
    Template("cc", "creative commons", "this work is licensed under a Creative Commons Attribution 4 0 International License"),
    Template("cc0", "cc0", "released into the public domain under CC0 1 0"),
    Template("gpl", "general public", "this work is licensed under the GNU General Public License version 3"),
    Template("gpl", "general public", "you can redistribute it and or modify it under the terms of the GNU General Public License"),
    Template("isc", "fee", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "lesser", "licensed under the GNU Lesser General Public License version 3"),
    Template("mit", "mit", "released under the MIT License"),
    Template("mit", "mit", "licensed under the MIT License"),
    Template("mit", "sublicense", "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"),
    Template("mpl", "mozilla", "this source code form is subject to the terms of the Mozilla Public License v 2 0"),
    Template("proprietary", "all rights reserved", "all rights reserved"),
    Template("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
)

# on UTF-8 bytes, whose lower() changes A-Z alone; all bytes of characters beyond ASCII belong to words
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = rb"[^0-9a-z\x80-\xff]+"
_BLOCK_END = re.compile(rb"(?<=[.!?])[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*\n")


def template_words(text: str) -> set[bytes]:
    return set(_WORD.findall(text.encode().lower()))


def needed(size: int, threshold: float) -> int:
    """How many of ``size`` words reach the threshold."""
    return max(ceil(size * threshold - 1e-9), 1)


class _Reader:
    """Reads a text: places of phrases, and blocks as sorted numbers of template words."""

    def __init__(self, vocabulary: dict[bytes, int], window: int, least: int, phrases: Sequence[tuple[str, str]]) -> None:
        self.vocabulary, self.window, self.least = vocabulary, window, least
        self.phrases = [
            (re.compile(rb"(?<![0-9a-z\x80-\xff])" + _BETWEEN.join(p.encode().split()) + rb"(?![0-9a-z\x80-\xff])"), label)
            for p, label in phrases
        ]

    def read(self, text: bytes) -> dict[str, object]:
        text = text.lower()
        places, labels = [], set()
        for phrase, label in self.phrases:
            found = [m.start() for m in phrase.finditer(text)]
            if found:
                places += found
                labels.add(label)
        blocks, at = [], 0
        for sentence in _BLOCK_END.split(text):
            words = _WORD.findall(sentence)
            for start, part in self._windows(words):
                known = self.vocabulary.keys() & part
                if len(known) >= self.least:
                    blocks.append({"start": at + start, "end": at + start + len(part), "words": sorted(map(self.vocabulary.__getitem__, known))})
            at += len(words)
        return {
            "n_words": at,
            "n_base": len(places),
            "first_word": len(_WORD.findall(text[: min(places)])) if places else None,
            "last_word": len(_WORD.findall(text[: max(places)])) if places else None,
            "base": sorted(labels),
            "blocks": blocks,
        }

    def _windows(self, words: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
        if len(words) <= 2 * self.window:
            yield 0, words
            return
        for start in range(0, len(words) - self.window, self.window):
            yield start, words[start : start + 2 * self.window]


_READ = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base", pa.list_(pa.string())),
        ("blocks", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("words", pa.list_(pa.int32()))]))),
    ]
)
_READ_DDL = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base array<string>, "
    "blocks array<struct<start:bigint,end:bigint,words:array<int>>>"
)


def _vocabulary(templates: Sequence[Template]) -> list[bytes]:
    return sorted(set().union(*(template_words(t.text) for t in templates)))


def read_blocks(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, threshold: float = 0.8, phrases: Sequence[tuple[str, str]] = PHRASES
) -> DataFrame:
    """doc_id, row, counts and places of phrases, and the blocks that can match at all: stored, one row per document.

    ``row`` tells repeated rows apart; it holds for this result only.
    """
    words = [template_words(t.text) for t in templates]
    vocabulary = {w: i for i, w in enumerate(_vocabulary(templates))}
    least = min(needed(len(w), threshold) for w in words)
    window = max(len(_WORD.findall(t.text.encode().lower())) for t in templates)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(vocabulary, window, least, phrases)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts = batch.column(0).slice(at, 256), batch.column(1).slice(at, 256)
                found = pa.RecordBatch.from_pylist([reader.read(t.as_py() or b"") for t in texts], _READ)
                yield pa.RecordBatch.from_arrays([ids, *found.columns], names=["doc_id", *_READ.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(read, f"doc_id {kind}, {_READ_DDL}")
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "blocks")


def matches(read: DataFrame, templates: Sequence[Template] = TEMPLATES, threshold: float = 0.8) -> DataFrame:
    """row, doc_id, start, end, template, label, containment, named: every block of ``read_blocks`` that meets a template.

    ``read`` has to be made with the same templates and threshold. ``named`` says that the block also has the words the
    template is named by.
    """
    spark = read.sparkSession
    blocks = read.where(F.size("blocks") > 0).select("row", "doc_id", F.posexplode("blocks").alias("block", "b"))
    counted = blocks.select(F.explode("b.words").alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in counted.collect()}  # one row per word of the templates
    vocabulary = _vocabulary(templates)
    order = sorted(range(len(vocabulary)), key=lambda i: (counts.get(i, 0), i))
    place = {word: rank for rank, word in enumerate(order)}
    number = {w: place[i] for i, w in enumerate(vocabulary)}

    sets, prefixes = [], []
    for k, template in enumerate(templates):
        ranks = sorted(number[w] for w in template_words(template.text))
        named_by = sorted(number[w] for w in template_words(template.named_by))
        least = needed(len(ranks), threshold)
        sets.append((k, template.label, ranks, named_by, least))
        prefixes += [(r, k, i, len(ranks), least) for i, r in enumerate(ranks[: len(ranks) - least + 1])]
    index = spark.createDataFrame(prefixes, "word int, template int, t_at int, t_size int, least int")
    whole = spark.createDataFrame(sets, "template int, label string, t_words array<int>, named_by array<int>, _least int")

    rank = F.array(*[F.lit(place[i]) for i in range(len(vocabulary))])
    ordered = blocks.select(
        "row", "doc_id", "block", "b.start", "b.end", F.array_sort(F.transform("b.words", lambda w: F.get(rank, w))).alias("words")
    )
    each = ordered.select("*", F.posexplode("words").alias("at", "word"))
    enough = (
        (F.size("words") >= F.col("least"))
        & (F.col("at") <= F.size("words") - F.col("least"))
        & (F.least(F.col("t_size") - F.col("t_at"), F.size("words") - F.col("at")) >= F.col("least"))
    )
    # a pair may share several words of its prefixes; it is kept at the first one
    shared = each.join(F.broadcast(index), "word").where(enough)
    shared = shared.join(F.broadcast(whole), "template")
    common = F.array_intersect("words", "t_words")
    met = shared.where((F.element_at(common, 1) == F.col("word")) & (F.size(common) >= F.col("_least")))
    return met.select(
        "row",
        "doc_id",
        "start",
        "end",
        "template",
        "label",
        (F.size(common) / F.size("t_words")).alias("containment"),
        (F.size(F.array_except("named_by", "words")) == 0).alias("named"),
    )


def scan(
    docs: DataFrame, templates: Sequence[Template] = TEMPLATES, threshold: float = 0.8, phrases: Sequence[tuple[str, str]] = PHRASES
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base (labels of phrases), labels (all), score.

    The score is 1 where a phrase stands literally, else the best containment of a named template, else 0.
    """
    read = read_blocks(docs, templates, threshold, phrases)
    found = (
        matches(read, templates, threshold)
        .where("named")
        .groupBy(F.col("row").alias("_row"))
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    )
    out = read.drop("blocks").join(found, F.col("row") == F.col("_row"), "left")
    none = F.array().cast("array<string>")
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base",
        F.array_sort(F.array_union("base", F.coalesce("found", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )

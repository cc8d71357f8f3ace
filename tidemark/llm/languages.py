"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams of a language, learned from labelled texts: n-grams
of 1 to 3 characters of lower-case words, with a blank at both ends of a word. A text is compared with
each profile by the out-of-place distance: for each of its own most frequent n-grams, the distance of its rank
there from its rank in the profile, or the profile length where it is missing. The nearest profile wins.

Profiles are learned from at most ``sample_per_language`` different texts of a language, those with the smallest
hash, so that the bound holds at any size of the corpus; every text is then compared as a whole. Counting is
spread over the texts of the sample and summed up in Spark; the driver gets ``profile_size`` n-grams
per language.

Edge cases: NULL texts and texts without a letter are ``und`` with score 0; equal counts rank by n-gram, equal
distances by language name; without labelled texts everything is ``und``; labels that are NULL are not learned;
repeated texts are learned once; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDEFINED = "und"
#: An n-gram is one number: up to three code points of 21 bits, the first one highest, so numbers sort like n-grams.
_BITS = 21
_BLANK = ord(" ")
#: Characters counted at once; the counts of the parts of a longer text are added up.
_PART = 1 << 20
#: Parts in which the hashes of a language are ranked before they are ranked together.
_SALTS = 64


@cache
def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether it belongs to a word (letters, and numerals that are no decimal digits), whether it is a letter."""
    every = [chr(i) for i in range(0x110000)]
    return (
        np.array([c.isalnum() and not c.isdecimal() for c in every]),
        np.array([c.isalpha() for c in every]),
    )


def _name(number: int) -> str:
    """The n-gram of a number."""
    points = [(number >> shift) & ((1 << _BITS) - 1) for shift in (2 * _BITS, _BITS, 0)]
    return "".join(chr(p) for p in points if p)


def _number(gram: str) -> int:
    """The number of an n-gram."""
    number = 0
    for place in range(3):
        number = number << _BITS | (ord(gram[place]) if place < len(gram) else 0)
    return number


def _grams_of(points: np.ndarray, seen: int = 0) -> np.ndarray:
    """N-grams of code points in which a blank stands for all between words; those within the first ``seen`` are left out.

    A gram may begin or end with a blank but not hold one between other characters, nor be blanks alone.
    """
    letter = points != _BLANK
    points = points.astype(np.int64) << (2 * _BITS)
    pairs = points[:-1] | points[1:] >> _BITS
    triples = pairs[:-1] | points[2:] >> (2 * _BITS)
    pair = max(seen - 1, 0)
    return np.concatenate([points[seen:][letter[seen:]], pairs[pair:][(letter[:-1] | letter[1:])[pair:]], triples[letter[1:-1]]])


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of n-grams in order, how often each occurs) of a whole text; none without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    in_word, is_letter = _kinds()
    if not is_letter[points].any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = np.full(1, _BLANK, np.uint32)
    points = np.concatenate([blank, np.where(in_word[points], points, _BLANK), blank])
    if len(points) <= _PART:
        return np.unique(_grams_of(points), return_counts=True)
    found = []
    for at in range(0, len(points), _PART):
        seen = min(at, 2)  # n-grams that begin in the part before
        found.append(np.unique(_grams_of(points[at - seen : at + _PART], seen), return_counts=True))
    return _summed(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def _summed(numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    numbers, place = np.unique(numbers, return_inverse=True)
    totals = np.zeros(len(numbers), np.int64)
    np.add.at(totals, place, counts)
    return numbers, totals


def ranked(text: str, size: int) -> np.ndarray:
    """The numbers of the ``size`` most frequent n-grams of a text, equal counts in order of the n-gram."""
    numbers, counts = counts_of(text)
    if len(counts) > size:
        keep = counts >= np.partition(counts, len(counts) - size)[len(counts) - size]
        numbers, counts = numbers[keep], counts[keep]
    return numbers[np.argsort(-counts, kind="stable")[:size]]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found.setdefault(lang, []).append(counts_of(text))
        for lang, counts in found.items():
            numbers, totals = _summed(*(np.concatenate(x) for x in zip(*counts, strict=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(numbers), pa.string()), pa.array(numbers), pa.array(totals)], names=["lang", "gram", "n"]
            )


def learn(
    labelled: DataFrame, profile_size: int = 300, sample_per_language: int = 2000
) -> dict[str, dict[str, int]]:
    """{language: {n-gram: rank}} from (lang, text) rows."""
    texts = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    # hashes alone find where the sample ends, so no other text is shuffled
    salted = texts.select("lang", "h", F.pmod("h", F.lit(_SALTS)).alias("salt")).distinct()
    # first the smallest of each salt, so that a language of most texts is not ranked by one task
    least = F.row_number().over(Window.partitionBy("lang", "salt").orderBy("h"))
    few = salted.withColumn("place", least).where(F.col("place") <= sample_per_language)
    order = Window.partitionBy("lang").orderBy("h")
    ranks = few.withColumn("place", F.row_number().over(order)).where(F.col("place") == sample_per_language)
    ends = {r["lang"]: r["h"] for r in ranks.collect()}
    inside = F.lit(True)
    for lang, end in ends.items():
        inside = inside & ((F.col("lang") != lang) | (F.col("h") <= end))
    sample = texts.where(inside).dropDuplicates(["lang", "h"])
    counts = sample.select("lang", "text").mapInArrow(_count_batches, "lang string, gram bigint, n bigint")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    rows = total.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= profile_size).collect()
    profiles: dict[str, dict[str, int]] = {}
    for r in rows:
        profiles.setdefault(r["lang"], {})[_name(r["gram"])] = r["rank"] - 1
    return {lang: profiles[lang] for lang in sorted(profiles)}


class Profiles:
    """Profiles as sorted numbers of n-grams with their ranks."""

    def __init__(self, profiles: dict[str, dict[str, int]]) -> None:
        self.size = max((len(p) for p in profiles.values()), default=1)
        self.of: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for lang in sorted(profiles):
            numbers = np.array([_number(gram) for gram in profiles[lang]], np.int64)
            order = np.argsort(numbers)
            self.of[lang] = numbers[order], np.fromiter(profiles[lang].values(), np.int64, len(numbers))[order]

    def distance(self, grams: np.ndarray, lang: str) -> int:
        """Out-of-place distance of ranked n-grams from the profile of a language."""
        known, ranks = self.of[lang]
        places = np.arange(len(grams))
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        return int(np.where(known[at] == grams, np.abs(ranks[at] - places), self.size).sum())

    def identify(self, text: str | None) -> tuple[str, float]:
        """(language, score). The score is how much of the largest possible distance the nearest profile saves."""
        grams = ranked(text, self.size) if text else []
        if not len(grams) or not self.of:
            return UNDEFINED, 0.0
        nearest, lang = min((self.distance(grams, lang), lang) for lang in self.of)
        return lang, 1.0 - nearest / (self.size * len(grams))


def identify(text: Column, profiles: dict[str, dict[str, int]]) -> Column:
    """Column struct<lang, score> for a text column. The profiles travel with the function: a few hundred
    n-grams per language."""

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Profiles(profiles)
        for texts in batches:
            yield pd.DataFrame([known.identify(t) for t in texts], columns=["lang", "score"])

    return predict(text)

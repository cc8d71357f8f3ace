"""Learned decision lists over document statistics, with DataFrame expressions only.

``statistics`` measures each whole text in one pass. ``learn`` grows a list of rules for bad documents
by sequential covering: a rule starts empty and takes the threshold condition with the largest
information gain on two thirds of the labelled rows, is cut back to the prefix that does best on the
other third, and is kept if it is precise there; then the rows it covers are set aside and the next rule
is grown. Each step is one aggregation that returns a count for each feature and threshold interval, so
all labelled rows take part and the driver sees (features x thresholds) numbers. ``verdict`` turns
the list into one ordered conditional expression.

Edge cases: NULL and empty texts have no words and 0 everywhere; a NULL label is skipped; repeated
labels count as often as they occur; without labels, or without a precise rule, the list is empty and no document is
rejected; documents shorter than a window repeat nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, words_of

_SYMBOLS = "#*$%&|<>"
FEATURES = (
    "mean_word_chars",
    "symbols_a_word",
    "duplicate_line_share",
    "repeated_word_share",
    "distinct_word_share",
    "upper_case_share",
    "digit_share",
    "mark_share",
    "words_a_line",
)


def repeated_words(words: Column, window: int = 8) -> Column:
    """Words that lie in a window of ``window`` words found twice or more in the same array."""

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(ordered: Column) -> Column:
            twice = F.filter(
                ordered,
                lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"]),
            )
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        def length(places: Column) -> Column:
            steps = F.transform(
                places, lambda p, k: F.coalesce(F.least(F.lit(window), p - F.get(places, k - 1)), F.lit(window))
            )
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        # sorting is only worth it where some window occurs twice
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(let(ordered, places), length)
        )

    def hashed(words: Column) -> Column:
        count = F.size(words) - window + 1
        return F.when(count < 2, F.lit(0)).otherwise(
            let(
                F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, window))),
                covered,
            )
        )

    return let(words, hashed).cast("bigint")


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, counts and the features of every row of (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def measured(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            let(
                lines,
                lambda lines: F.struct(
                    F.size(lines).cast("bigint").alias("n_lines"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
                ),
            ).alias("lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_upper"),
            (F.length(text) - F.length(F.translate(text, "0123456789", ""))).cast("bigint").alias("n_digits"),
            (F.length(text) - F.length(F.translate(text, "!?;:", ""))).cast("bigint").alias("n_marks"),
        )

    row = docs.select("doc_id", let(words_of(F.col("text")), measured).alias("m")).select("doc_id", "m.*")
    row = row.select("*", "lines.n_lines", "lines.n_dup_lines").drop("lines")
    c = F.col
    return row.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        _ratio(c("word_chars"), c("n_words")).alias("mean_word_chars"),
        _ratio(c("n_symbols"), c("n_words")).alias("symbols_a_word"),
        _ratio(c("n_dup_lines"), c("n_lines")).alias("duplicate_line_share"),
        _ratio(c("n_repeat_words"), c("n_words")).alias("repeated_word_share"),
        _ratio(c("n_distinct"), c("n_words")).alias("distinct_word_share"),
        _ratio(c("n_upper"), c("word_chars")).alias("upper_case_share"),
        _ratio(c("n_digits"), c("word_chars")).alias("digit_share"),
        _ratio(c("n_marks"), c("word_chars")).alias("mark_share"),
        _ratio(c("n_words"), c("n_lines")).alias("words_a_line"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.lit(100) * F.col("n_repeat_words") > F.lit(30) * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.above else value < self.threshold


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def column(self) -> Column:
        return reduce(lambda a, b: a & b, (c.column() for c in self.conditions), F.lit(True))

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>=' if c.above else '<'} {c.threshold:.6g}" for c in self.conditions)


def _thresholds(labelled: DataFrame, cuts: int) -> dict[str, list[float]]:
    """Cut points per feature: quantiles of the bad and of the good rows."""
    shares = [i / cuts for i in range(cuts + 1)]
    columns = [
        F.percentile_approx(F.when(F.col("bad") == bad, F.col(f)), shares, 10000).alias(f"{f}_{bad}")
        for f in FEATURES
        for bad in (0, 1)
    ]
    row = labelled.agg(*columns).first()
    return {f: sorted({v for bad in (0, 1) for v in (row[f"{f}_{bad}"] or [])}) for f in FEATURES}


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained by narrowing (p0 bad, n0 good) to (p, n), weighted by the bad rows kept."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best(rows: DataFrame, cuts: dict[str, list[float]], least: int) -> Condition | None:
    """The condition with the largest gain on ``rows`` (bad, features): one aggregation."""
    parts = []
    for f in FEATURES:
        points = F.array(*[F.lit(v) for v in cuts[f]]).cast("array<double>")
        value = F.col(f)
        interval = F.size(F.filter(points, lambda t: t <= value))  # noqa: B023 - called at once
        parts.append(F.struct(F.lit(f).alias("feature"), interval.alias("interval")))
    counts = (
        rows.select("bad", F.explode(F.array(*parts)).alias("x"))
        .groupBy("x.feature", "x.interval")
        .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
        .collect()
    )
    best, most = None, 1e-9
    for f in FEATURES:
        at = {r["interval"]: (r["p"], r["n"]) for r in counts if r["feature"] == f}
        p0, n0 = sum(p for p, _ in at.values()), sum(n for _, n in at.values())
        p_low = n_low = 0
        for i, threshold in enumerate(cuts[f]):
            p, n = at.get(i, (0, 0))
            p_low, n_low = p_low + p, n_low + n
            for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                if p >= least and n < n0 and (gain := _gain(p, n, p0, n0)) > most:
                    best, most = Condition(f, above, threshold), gain
    return best


def learn(
    labelled: DataFrame,
    max_rules: int = 10,
    max_conditions: int = 3,
    cuts: int = 24,
    least_bad: int = 5,
    least_precision: float = 0.9,
) -> list[Rule]:
    """Rules for bad rows, in order, from the ``FEATURES`` and ``bad`` (1 or 0) of ``labelled``.

    ``labelled`` is read about five times a rule; pass a stored frame.
    """
    rows = labelled.where("bad is not null").withColumn("held", F.pmod(F.xxhash64(*FEATURES), F.lit(3)) == 0)
    points = _thresholds(rows, cuts)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        grown: list[Condition] = []
        inside = rows.where(~F.col("held"))
        while len(grown) < max_conditions and (found := _best(inside, points, least_bad)) is not None:
            grown.append(found)
            inside = inside.where(found.column())
        if not grown:
            break
        # the prefix that does best on the rows held out
        sums = []
        for k in range(1, len(grown) + 1):
            hit = Rule(tuple(grown[:k]), 0.0).column()
            sums += [F.sum(F.when(hit, F.col("bad"))).alias(f"p{k}"), F.sum(F.when(hit, 1 - F.col("bad"))).alias(f"n{k}")]
        held = rows.where("held").agg(*sums).first()
        scored = []
        for k in range(1, len(grown) + 1):
            p, n = held[f"p{k}"] or 0, held[f"n{k}"] or 0
            scored.append(((p - n) / (p + n) if p + n else -1.0, -k, (p + 1) / (p + n + 2), p))
        _, k, precision, support = max(scored)
        if not support or precision < least_precision - 1 / (support + 2):
            break
        rules.append(Rule(tuple(grown[:-k]), precision))
        rows = rows.where(~rules[-1].column())
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; NULL if none does."""
    column = None
    for number, rule in enumerate(rules, 1):
        value = F.lit(number).cast("bigint")
        column = F.when(rule.column(), value) if column is None else column.when(rule.column(), value)
    return F.lit(None).cast("bigint") if column is None else column

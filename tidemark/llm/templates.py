"""Benchmark decontamination by template windows, with DataFrame expressions only.

A text becomes a sequence of canonical words: numbers, names (capitalised inside a sentence) and units behind
a number turn into typed placeholders, other words lose case and marks. Windows of canonical
words are hashed; documents and benchmark items that share a window share a template, whatever stands in the
slots. A second hash, in which numbers alone are placeholders, meets copies in another case. Shared windows that
follow each other at one alignment are a run. A run counts if it holds ``min_literals`` plain words or if all its
slots are the same in both texts; windows of numbers alone meet only where the numbers are equal.
The slots of a run then have to agree: one value of the item always stands for the same value of the document; a run
with a window free of slots agrees too. A match none of whose runs agrees is reported as inconsistent.

The hashes of the benchmark are broadcast if there are at most ``broadcast_rows`` of them, measured
first; beyond that the two sides are shuffled by hash. Slots are read again for matching documents only.

Edge cases: NULL and empty texts have no window; an item shorter than a window is one window of its
length, which is looked for at every place of a document; rows are told apart by
doc_id (NULL included) and two hashes of the text, so repeated rows give one result row; item_id can be NULL; items of
fewer than ``LEAST_WORDS`` words are reported with ``item_words`` but do not make a document contaminated; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, packed, text_key, unpacked
from tidemark.session import stored

#: Units read as such behind a number.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers "
    "mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes "
    "ml l liter liters litre litres gallon gallons cup cups s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years cent cents dollar dollars euro euros usd eur percent degree degrees "
    "kmh mph hz khz mhz ghz v volt volts w watt watts kw kwh j joule joules"
).split()

# a cheap test of the character comes before the look at what stands around it
_NAME = r"(\p{Lu}(?<=[\p{L}\p{N},;:]\x20.)\p{Ll}[\p{L}'’-]*)"
_NUMBER = r"(?=[$€£+\-\p{Nd}])(?<!\p{L})[$€£+-]?\p{Nd}+(?:[.,]\p{Nd}+)*%?(?!\p{L})"
_UNIT = r"(?i)<num>\x20((?:" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{N}]))"
# private characters: one before a name, one for a number, one before a unit
_NAME_MARK, _NUMBER_MARK, _UNIT_MARK = "\ue000", "\ue001", "\ue002"
_KEPT = _NAME_MARK + _NUMBER_MARK + _UNIT_MARK
_BLANKS = "\t\n\x0b\f\r"


def _clean(text: Column) -> Column:
    """The text with single blanks and without the characters kept for placeholders."""

    def single_blanks(text: Column) -> Column:
        return F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text)

    def without_kept(text: Column) -> Column:
        reserved = [F.contains(text, F.lit(c)) for c in _KEPT]
        return F.when(reserved[0] | reserved[1] | reserved[2], F.translate(text, _KEPT, "")).otherwise(text)

    # inside other lambdas Spark computes an expression as often as it is named, so each step is bound
    return let(let(F.translate(F.coalesce(text, F.lit("")), _BLANKS, " " * len(_BLANKS)), single_blanks), without_kept)


def _split(text: Column) -> Column:
    return F.array_remove(F.split(text, " "), "")


def marked_words(text: Column) -> Column:
    """Words of a text without marks and case: numbers as a placeholder, names and units behind their mark.

    There are as many as ``slot_words`` has. Words made of marks alone are in neither.
    """

    def units_marked(body: Column) -> Column:
        with_units = F.regexp_replace(body, _UNIT.replace("<num>", _NUMBER_MARK), f"{_NUMBER_MARK} {_UNIT_MARK}$1")
        return F.when(F.contains(body, F.lit(_NUMBER_MARK)), with_units).otherwise(body)

    body = F.regexp_replace(_clean(text), _NAME, f"{_NAME_MARK}$1")
    body = let(F.regexp_replace(body, _NUMBER, _NUMBER_MARK), units_marked)
    return _split(F.regexp_replace(F.lower(body), rf"[^\p{{L}}\p{{N}}{_KEPT} ]+", ""))


def plain_words(marked: Column) -> Column:
    """Marked words with names and units as they are: only numbers are placeholders."""
    return F.transform(marked, lambda w: F.translate(w, _NAME_MARK + _UNIT_MARK, ""))


def typed_words(marked: Column) -> Column:
    """Marked words with a placeholder in place of each name and unit."""
    name, unit = F.lit(_NAME_MARK), F.lit(_UNIT_MARK)
    return F.transform(marked, lambda w: F.when(F.contains(w, name), name).when(F.contains(w, unit), unit).otherwise(w))


def canonical_words(text: Column, typed: bool = True) -> Column:
    """Canonical words of a text. Without ``typed``, numbers alone become placeholders."""
    return typed_words(marked_words(text)) if typed else plain_words(marked_words(text))


def slot_words(text: Column) -> Column:
    """The same words as they stand in the text, without marks and case."""
    return _split(F.regexp_replace(F.lower(_clean(text)), r"[^\p{L}\p{N}.%\x20\x09-\x0D]+|[.%]+(?=[^\p{L}\p{N}\x20\x09-\x0D]*(?:[\x20\x09-\x0D]|$))", ""))


def _is_slot(word: Column) -> Column:
    return F.rlike(word, F.lit(f"[{_KEPT}]"))


def window_hashes(words: Column, width: int) -> Column:
    """Hash of each window of ``width`` words by its place; none if there are fewer words."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda each: _windows(each, width))


def _windows(each: Column, width: int) -> Column:
    """Hash of each window of hashes."""
    last = F.size(each) - width
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(each, i + k) for k in range(width)]),
        )
    )


def _item_keys(width: int, plain: Column, typed: Column, verbatim: Column) -> Column:
    """(at, window, both, mode) of each window of an item, by the hashes of its words; ``both`` if plain and typed are one."""

    def entry(at: Column, window: Column, both: Column, mode: int) -> Column:
        return F.struct(at.alias("at"), window.alias("window"), both.alias("both"), F.lit(mode).alias("mode"))

    def both_kinds(w: Column) -> Column:
        keyed = F.transform(w["plain"], lambda x, i: entry(i, _told_apart(x, F.get(w["verbatim"], i), width), x == F.get(w["typed"], i), 0))
        other = F.transform(w["typed"], lambda x, i: F.when(x != F.get(w["plain"], i), entry(i, x, F.lit(False), 1)))
        return F.concat(keyed, F.filter(other, lambda x: x.isNotNull()))

    windows = F.struct(
        _windows(plain, width).alias("plain"), _windows(typed, width).alias("typed"), window_hashes(verbatim, width).alias("verbatim")
    )
    return let(windows, both_kinds)


def _numbers_alone(width: int) -> Column:
    return F.xxhash64(*[F.xxhash64(F.lit(_NUMBER_MARK))] * width)


def _told_apart(window: Column, verbatim: Column, width: int) -> Column:
    """The hash of a window; one of numbers alone has that of the numbers, so that it meets equal numbers only."""
    return F.when(window == _numbers_alone(width), F.xxhash64(F.lit("same"), verbatim)).otherwise(window)


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _typed_places(marked: Column) -> Column:
    """Places of names and units."""
    name, unit = F.lit(_NAME_MARK), F.lit(_UNIT_MARK)
    places = F.transform(marked, lambda w, i: F.when(F.contains(w, name) | F.contains(w, unit), i))
    return F.filter(places, lambda i: i.isNotNull())


def _document_keys(widths: list[int], text: Column) -> Column:
    """(at, window) of all plain windows of a text, and of the typed ones that hold a name or unit; the others are the same."""

    def of_width(width: int, marked: Column, places: Column, plain: Column) -> Column:
        last = F.size(marked) - width

        def key(at: Column, window: Column) -> Column:
            return F.struct(at.alias("at"), window.alias("window"))

        def plain_keys(windows: Column) -> Column:
            # the words as they stand are read only for texts with a window of numbers alone
            told = lambda words: F.transform(windows, lambda x, i: key(i, _told_apart(x, F.get(words, i), width)))
            return F.when(F.array_contains(windows, _numbers_alone(width)), let(window_hashes(slot_words(text), width), told)).otherwise(
                F.transform(windows, lambda x, i: key(i, x))
            )

        def typed_key(at: Column) -> Column:
            words = _hashed(typed_words(F.slice(marked, at + 1, width)))
            return key(at, let(words, lambda w: F.xxhash64(*[F.get(w, F.lit(k)) for k in range(width)])))

        around = F.transform(places, lambda p: F.sequence(F.greatest(p - (width - 1), F.lit(0)), p))
        starts = F.filter(F.array_distinct(F.flatten(around)), lambda at: at <= last)
        typed = F.transform(starts, typed_key)
        return F.concat(let(_windows(plain, width), plain_keys), typed)

    def of_text(x: Column) -> Column:
        marked, places = x["marked"], x["places"]
        plain = F.when(F.size(places) > 0, _hashed(plain_words(marked))).otherwise(_hashed(marked))
        return let(plain, lambda plain: F.concat(*[of_width(w, marked, places, plain) for w in widths]))

    return let(let(marked_words(text), lambda m: F.struct(m.alias("marked"), _typed_places(m).alias("places"))), of_text)


def matches(
    docs: DataFrame, benchmark: DataFrame, width: int = 8, min_literals: int = 5, broadcast_rows: int = 1_000_000
) -> DataFrame:
    """doc_id, text_key, item_id, item_words, n_windows, first_word, n_slots, consistent: one row per document and item that share windows.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Items of any length are matched; ``contaminated`` says which count.
    """
    marked = marked_words(F.col("text"))
    items = benchmark.select("item_id", F.col("text").alias("item_text"), marked.alias("marked"), slot_words(F.col("text")).alias("verbatim"))
    items = items.where(F.size("marked") > 0)
    items = items.withColumn("typed", typed_words(F.col("marked"))).withColumn("plain", plain_words(F.col("marked")))
    items = items.withColumn("width", F.least(F.size("marked"), F.lit(width)))
    # the lengths of short items; documents have windows of these lengths too
    widths = sorted({width, *(r.width for r in items.select("width").distinct().collect())})
    key = F.array().cast("array<struct<at:int,window:bigint,both:boolean,mode:int>>")
    for w in widths:
        key = F.when(F.col("width") == w, _item_keys(w, _hashed(F.col("plain")), _hashed(F.col("typed")), F.col("verbatim"))).otherwise(key)
    spread = items.select("item_id", F.xxhash64("item_text").alias("item_key"), "width", F.inline(key)).select(
        "window",
        "item_id",
        "item_key",
        "width",
        F.col("at").alias("item_at"),
        F.when(F.col("both"), F.array(F.lit(0), F.lit(1))).otherwise(F.array("mode")).alias("modes"),
    )
    spread = spread.dropDuplicates()
    small = spread.limit(broadcast_rows + 1).count() <= broadcast_rows

    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.inline(_document_keys(widths, F.col("text"))))
    found = keyed.join(F.broadcast(spread) if small else spread, "window").withColumn("mode", F.explode("modes"))
    # one row per run: overlapping windows of a passage share their alignment and follow each other
    aligned = ["doc_id", "text_key", "item_id", "item_key", "width", "mode", "shift"]
    found = found.withColumn("shift", F.col("at") - F.col("item_at"))
    place = F.dense_rank().over(Window.partitionBy(*aligned).orderBy("at"))
    runs = (
        found.withColumn("run", F.col("at") - place)
        .groupBy(*aligned, "run")
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    )
    # both the texts and their alignments are looked up below; the windows are met once
    return _checked(docs, items, stored(runs, "alignments"), min_literals)


def _checked(docs: DataFrame, items: DataFrame, runs: DataFrame, min_literals: int) -> DataFrame:
    """Adds the comparison of slots to the runs found and sums up per document and item."""
    hit = runs.select("doc_id", "text_key").dropDuplicates()
    texts = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").withColumnRenamed("doc_id", "_id")
    texts = (
        texts.join(
            hit.withColumnRenamed("text_key", "_key"),
            F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("text_key") == F.col("_key")),
            "left_semi",
        )
        .dropDuplicates(["_id", "text_key"])
        .select("_id", F.col("text_key").alias("_key"), slot_words(F.col("text")).alias("doc_words"))
    )
    bench = items.select(
        F.col("item_id").alias("_item"),
        F.xxhash64("item_text").alias("_item_key"),
        F.array("plain", "typed").alias("kinds"),
        F.array(*[F.transform(c, _is_slot) for c in ("plain", "typed")]).alias("is_slot"),
        F.col("verbatim").alias("item_words"),
    ).dropDuplicates(["_item", "_item_key"])
    both = runs.join(texts, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")))
    both = both.join(bench, F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("item_key") == F.col("_item_key")))
    both = both.withColumn("kinds", F.get("kinds", F.col("mode"))).withColumn("is_slot", F.get("is_slot", F.col("mode")))
    pairs = F.transform(
        F.filter(
            F.sequence(F.col("first_at"), F.col("last_at") + F.col("width") - 1),
            lambda p: F.get(F.col("is_slot"), p - F.col("shift")),
        ),
        lambda p: F.struct(
            F.get(F.col("kinds"), p - F.col("shift")).alias("kind"),
            F.get(F.col("item_words"), p - F.col("shift")).alias("was"),
            F.get(F.col("doc_words"), p).alias("now"),
        ),
    )

    def agree(pairs: Column) -> Column:
        once = F.array_distinct(pairs)
        return F.size(once) == F.size(F.array_distinct(F.transform(once, lambda x: F.struct(x["kind"], x["was"]))))

    free = F.exists(
        F.sequence(F.col("first_at"), F.col("last_at")),
        lambda p: ~F.array_contains(F.slice(F.col("is_slot"), p - F.col("shift") + 1, F.col("width")), True),
    )
    judged = both.withColumn("pairs", pairs).select(
        *["doc_id", "text_key", "item_id", "item_key", "width", "mode", "shift", "first_at"],
        F.size("item_words").alias("item_size"),
        (F.col("last_at") - F.col("first_at") + 1).alias("windows"),
        F.size("pairs").alias("slots"),
        (F.col("last_at") - F.col("first_at") + F.col("width") - F.size("pairs")).alias("literals"),
        F.forall("pairs", lambda x: x["was"].eqNullSafe(x["now"])).alias("verbatim"),
        (let(F.col("pairs"), agree) | free).alias("agrees"),
    )
    counted = judged.where((F.col("literals") >= min_literals) | F.col("verbatim"))
    aligned = counted.groupBy("doc_id", "text_key", "item_id", "item_key", "width", "mode", "shift").agg(
        F.sum("windows").alias("n_windows"),
        F.min("first_at").alias("first_at"),
        F.sum("slots").alias("slots"),
        F.bool_or("agrees").alias("agrees"),
        F.max("item_size").alias("item_size"),
    )
    return aligned.groupBy("doc_id", "text_key", "item_id").agg(
        F.max("item_size").cast("bigint").alias("item_words"),
        F.max("n_windows").cast("bigint").alias("n_windows"),
        F.min("first_at").cast("bigint").alias("first_word"),
        F.max("slots").cast("bigint").alias("n_slots"),
        F.bool_or("agrees").alias("consistent"),
    )


#: Items with fewer words are matched and reported, but remove no document: such a phrase stands anywhere by chance.
LEAST_WORDS = 5


def counts(least_words: int = LEAST_WORDS, min_windows: int = 1) -> Column:
    """Whether a row of ``matches`` makes its document contaminated."""
    return F.col("consistent") & (F.col("n_windows") >= min_windows) & (F.col("item_words") >= least_words)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_windows: int = 1, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """The matches that count: consistent slots, at least ``min_windows`` shared windows in one alignment, and an item
    of at least ``least_words`` words."""
    return matches(docs, benchmark, **options).where(counts(least_words, min_windows))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that match no benchmark item, all columns kept."""
    found = contaminated(docs.select("doc_id", "text"), benchmark, **options)
    found = found.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key")).dropDuplicates()
    rows = packed(docs, id=F.col("doc_id"), key=text_key(F.col("text")))
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    return unpacked(rows.join(found, same, "left_anti"), docs.columns)

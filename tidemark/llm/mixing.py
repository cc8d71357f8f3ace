"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, target / source size. The expected
copies are summed up in one order per source, one random offset is added to all sums, and a document
is emitted once for each integer its own stretch crosses. With documents in order of size, each size
is represented in proportion, so the words taken come close to the target.

The sum runs over blocks (source, size class, slot): totals per block first, then sums over the
blocks of a source, then inside each block. A source that holds most rows is so dealt over many tasks.

Edge cases: NULL text has size 0; a source of size 0 has target 0 and takes nothing; NULL is a source of its own, last
in order; repeated rows are separate documents; an empty table gives an empty result; columns
other than the three named ones are not read by ``allocate`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, free_name, packed, unpacked
from tidemark.session import stored

#: Sums of expected copies are exact: 12 digits after the point, at most 26 before it.
_SUM = "decimal(38,12)"
_COPIES = "decimal(20,12)"


def size_of(text: Column) -> Column:
    """Words of a text, 0 for NULL: runs of white space in the trimmed text, plus one."""
    body = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")
    body = F.trim(body)
    gaps = F.length(body) - F.length(F.translate(body, " ", ""))
    return F.when(body == "", F.lit(0)).otherwise(gaps + 1).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    ceiling: int = 2,
) -> DataFrame:
    """(source, source_size, target): ``share`` of all words by weight, none above ``ceiling`` times its size.

    ``sizes`` holds (source, size) rows. Sources take the weights in turn by code point, NULL last.
    A source stops at its ceiling exactly if its ceiling per weight is low enough: in that
    order, the source is stopped when the words left over for it and all later ones, dealt by weight,
    reach its ceiling. So running totals over the sources replace the rounds of resharing.
    One row per source reaches the windows here.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turns = F.array(*[F.lit(w).cast("bigint") for w in weights])
    weighted = totals.withColumn(
        "weight", F.element_at(turns, (F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights))) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * F.lit(ceiling))
    by_ceiling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ceiling.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ceiling.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    run = weighted.select(
        "source",
        "source_size",
        "weight",
        "cap",
        (F.sum("source_size").over(everything) * F.lit(share)).alias("words"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("stopped"),
        F.sum("weight").over(after).alias("open_weight"),
    )
    level = (F.col("words") - F.col("stopped")) / F.col("open_weight")
    run = run.withColumn("is_open", level * F.col("weight") < F.col("cap"))
    # the first open source fixes the words a unit of weight gets; behind it the levels only fall
    run = run.withColumn("level", level).withColumn("unit", F.max(F.when(F.col("is_open"), F.col("level"))).over(everything))
    return run.select(
        "source",
        "source_size",
        F.when(F.col("is_open"), F.col("unit") * F.col("weight")).otherwise(F.col("cap")).cast("double").alias("target"),
    )


def crossings(docs: DataFrame, expected: str, group: str, seed: int = 10, slots: int = 64) -> DataFrame:
    """``docs`` plus ``copies``: integer boundaries crossed by a running sum of ``expected`` within ``group``.

    ``docs`` has doc_id and size. The offset of a group is a hash of its name and ``seed``, so reruns agree.
    """
    bits = F.floor(F.log2(F.col("size") + 1) * 16)
    blocks = docs.withColumn("_class", bits).withColumn("_slot", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(slots)))
    keys = [group, "_class", "_slot"]
    sums = blocks.groupBy(*keys).agg(F.sum(expected).cast(_SUM).alias("_sum"))
    upto = Window.partitionBy(group).orderBy("_class", "_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(k).alias(f"_{k}_") for k in keys], F.coalesce(F.sum("_sum").over(upto), F.lit(0)).cast(_SUM).alias("_start")
    )
    same = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_{k}_"))
        same = one if same is None else same & one
    met = blocks.join(starts, same, "left")
    inside = Window.partitionBy(*keys).orderBy("size", "doc_id", expected).rowsBetween(Window.unboundedPreceding, 0)
    thousandths = F.pmod(F.xxhash64(F.lit("offset"), F.lit(seed), F.coalesce(F.col(group).cast("string"), F.lit("\0null"))), F.lit(10**9))
    offset = (thousandths / F.lit(10**9)).cast(_COPIES)
    end = F.col("_start") + offset + F.sum(expected).over(inside).cast(_SUM)
    met = met.withColumn("_end", end)
    copies = F.floor(F.col("_end")) - F.floor(F.col("_end") - F.col(expected))
    return met.withColumn("copies", copies.cast("bigint")).drop("_class", "_slot", "_start", "_end", *[f"_{k}_" for k in keys])


def allocate(docs: DataFrame, seed: int = 10, **shares) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row of (doc_id, source, text)."""
    sized = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"))
    return _planned(stored(sized, "sizes"), seed, **shares).drop("expected")


def _planned(sized: DataFrame, seed: int, **shares) -> DataFrame:
    targets = source_targets(sized.select("source", "size"), **shares).withColumnRenamed("source", "_of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    planned = sized.join(targets, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
    planned = planned.withColumn("expected", rate.cast(_COPIES))
    mixed = crossings(planned, "expected", "source", seed)
    return mixed.withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, seed: int = 10, **shares) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as it is taken, numbered by ``copy_no`` from 1.

    Documents without words are never asked for, so their copies are left out. If ``docs`` has a column ``copy_no``, the number
    is ``copy_no_1``, and so on.
    """
    rows = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), size=size_of(F.col("text")))
    mixed = _planned(rows, seed, **shares).where("copies > 0 and size > 0")
    numbers = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return unpacked(mixed, docs.columns, **{free_name(docs.columns, "copy_no"): numbers})

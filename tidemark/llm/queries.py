"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    languages,
    licenses,
    mixing,
    oracle,
    prefixes,
    repair,
    rules,
    secrets,
    simhash,
    suffixes,
    templates,
    warc,
    windows,
)
from tidemark.llm.common import table
from tidemark.session import fresh_path, stored


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all documents, the base rule and the verdict of a list learned from ``labels``."""
    measured = stored(rules.statistics(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("bad"))
    labelled = stored(measured.where(~rules.base_failed()).join(labels, "doc_id").select("bad", *rules.FEATURES), "labelled")
    found = rules.learn(labelled)
    rejected = rules.verdict(found).alias("rule")
    out = measured.select("*", rules.base_failed().alias("base_failed"), rejected)
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"),
        "rule",
    )


def op2_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of near duplicates of all documents."""
    out = simhash.classes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op3_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of 50 words or more that occur elsewhere too, in whole texts."""
    found = suffixes.spans(table(spark, sf_dir, "documents"))
    one = lambda s: F.concat_ws(":", s["start"], s["end"])
    return (
        found.groupBy("doc_id")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("s"))
        .select(
            "doc_id",
            F.aggregate("s", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]).alias("n_repeated_words"),
            F.array_join(F.transform("s", one), ",").alias("spans"),
        )
    )


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one made of marker strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    out = chat.format_conversations(turns.unionByName(extra))
    read = out.select(
        "conv_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives to the shared folder and read back."""
    path = fresh_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    out = warc.read(spark, path)
    # a record that does not check out fails the query instead of going missing
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("record_type"))
    return out.select("page_id", "payload_bytes", "payload_digest", sound.alias("record_type"), "refers_to", "url")


def op6_secret_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents by patterns and a field trained on a bounded sample of lines.

    A span of a pattern is all that the pattern matched, the keyword of an assignment included.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = docs.select("doc_id", secrets.scan(F.col("text"), secrets.learn(docs), whole=True).alias("found"))
    one = lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, secrets.KINDS)), s["kind"]), s["start"], s["end"])
    base = F.filter("found", lambda s: s["kind"] < 3)
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    return out.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, one), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", one), ",").alias("spans"),
        number(3).alias("n_field"),
    )


def op8_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with near-duplicate passages of 50 words or more, their class and the passages."""
    found = windows.passages(table(spark, sf_dir, "documents"))
    one = lambda s: F.concat_ws(":", s["start"], s["end"])
    return (
        found.groupBy("doc_id", "class_id")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("s"))
        .select(
            "doc_id",
            "class_id",
            F.aggregate("s", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]).alias("n_words"),
            F.array_join(F.transform("s", one), ",").alias("spans"),
        )
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that language profiles never learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def op7_rank_order_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by profiles of the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = languages.learn(docs.where(~held_out()))
    out = docs.select("doc_id", held_out().alias("held_out"), languages.identify(F.col("text"), profiles).alias("found"))
    return out.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op9_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and benchmark items that share template windows, with the check of their slots."""
    out = templates.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "item_id",
        "n_windows",
        "first_word",
        "n_slots",
        "consistent",
        templates.counts().alias("contaminated"),
        "item_words",
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 3, 1, 2 by source at 150% of all words."""
    out = mixing.allocate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of all documents: places of phrases, and blocks that hold the words of a template."""
    out = licenses.scan(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with the damage that the hash of a row names; a dropped row is marked as ``gone``."""
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.col("kind")
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.select(
        "conv_id",
        "turn",
        known("role").alias("role"),
        known("text").alias("text"),
        (F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20).alias("kind"),
    ).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    )


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by the rule of the test and repaired."""
    out = repair.repair(damaged(table(spark, sf_dir, "conversations")))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select("conv_id", *counts, "audit", repair.repaired_digest().alias("repaired_sha256"))


def rebuilt(own: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first turns are those of the first conversation of their hundred."""
    heads = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, most - 1).alias("_head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % group == F.col("_base"), "left")
    head = F.coalesce(F.slice("_head", F.lit(1), h), F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that many share their first turns."""
    own = stored(prefixes.sequences(table(spark, sf_dir, "conversations")), "sequences")
    nodes = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return prefixes.trie(rebuilt(own)).select(*nodes)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_golay_simhash": op2_golay_simhash,
    "op3_sparse_suffixes": op3_sparse_suffixes,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_warc": op5_warc,
    "op6_secret_field": op6_secret_field,
    "op7_rank_order_languages": op7_rank_order_languages,
    "op8_compact_windows": op8_compact_windows,
    "op9_template_decontamination": op9_template_decontamination,
    "op10_mixing": op10_mixing,
    "op11_license_join": op11_license_join,
    "op12_structure_repair": op12_structure_repair,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE = oracle.ORACLE

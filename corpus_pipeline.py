"""From raw documents to a training mix: five stages, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps with the columns of ``docs``; the last one adds
``copy_no`` (``copy_no_1`` if the documents have such a column). Rows with NULL or letterless texts go in the first stage,
labelled or not; all other edge cases are those of the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import languages, mixing, secrets, simhash, templates
from tidemark.llm.common import table
from tidemark.session import fresh_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found, by profiles of the labelled ones.

    Rejected are NULL texts and those without a letter. If no document has a label there is no profile to compare
    with, and every document with a letter stays.
    """
    profiles = languages.learn(docs)
    if not profiles:
        return docs.where(F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False)))
    return docs.where(languages.identify(F.col("text"), profiles)["lang"] != languages.UNDEFINED)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage, be its numbers, names and units the same or others."""
    return templates.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` counted again."""
    field = secrets.learn(docs)
    out = docs.withColumn("text", secrets.redact(F.col("text"), field))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("source_mixing", mix_sources),
]

#: Fingerprint classes and a trained field have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""A training corpus from raw documents: toxicity, exact dedup, near dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, common, exact_dedup, mixing, ngram_join, queries, toxicity


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text is not judged toxic; the labels are those of ``sf_dir``."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = toxicity.score(docs.toDF(*(f"_{c}" for c in docs.columns)), model, text="_text")
    return judged.where("predicted = 0").select(*(judged[f"_{c}"].alias(c) for c in docs.columns))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    return ngram_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their lane, slot and offset in the order in which sources are mixed to their target weights."""
    return mixing.mix(docs, queries.MIX_WEIGHTS, queries.BLOCK_ROWS, places=True)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and decoded texts, each with its place in the mix: read by (slot, offset)."""
    return bpe.digest(docs, queries.VOCABULARY, beside=["lane", "slot", "offset"])


STAGES = [
    ("toxicity", toxicity_filter), ("exact dedup", exact_duplicates), ("ngram jaccard join", near_duplicates),
    ("mixing", mixed), ("bpe", tokens),
]
#: Deobfuscation and its classifier cannot be stated in SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.pin(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

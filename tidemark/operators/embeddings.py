"""Text vectors from stored, mergeable document frequencies: new rows are embedded without a look at the old ones.

A token counts for one of ``dims`` places by its digest; a place weighs the count of its tokens by how few documents have one,
and vectors have length 1. How many documents have each place is a table that every run adds its own rows to, so
the weights of all documents are a sum over runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.session import pin
from tidemark.sources.versioned import VersionedTable


def place_counts(documents: DataFrame, key: str, text: str, dims: int) -> DataFrame:
    """``key, place, count``: the tokens of each document by place. Documents without tokens have no rows."""
    each = documents.select(F.col(key), F.explode(tokens(text)).alias("token"))
    place = F.pmod(F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("long"), F.lit(dims)).cast("int")
    return each.groupBy(key, place.alias("place")).agg(F.count(F.lit(1)).alias("count"))


def frequencies(counts: DataFrame, key: str) -> DataFrame:
    """``place, documents``: how many documents have each place; place -1 counts all documents that have any."""
    own = counts.groupBy("place").agg(F.count(F.lit(1)).alias("documents"))
    return own.unionByName(counts.agg(F.lit(-1).alias("place"), F.count_distinct(key).alias("documents")))


def vectors(counts: DataFrame, key: str, known: DataFrame, dims: int) -> DataFrame:
    """``key, vector`` of the documents in ``counts``, weighed by ``known`` frequencies of any number of runs. A document whose
    places all documents have weighs nothing and has a vector of zeros."""
    summed = known.groupBy("place").agg(F.sum("documents").alias("documents"))
    all_documents = summed.where("place = -1").select("documents").scalar()
    rarity = pin(summed.where("place >= 0").select("place", F.log((all_documents + 1) / (F.col("documents") + 1)).alias("rarity")))
    weighed = counts.join(rarity, "place").select(key, "place", (F.col("count") * F.col("rarity")).alias("weight"))
    listed = weighed.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("place", "weight"))).alias("weights"),
                                      F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    at = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.coalesce(F.try_element_at("weights", i), F.lit(0.0)))
    unit = F.transform(at, lambda x: F.when(F.col("length") > 0, x / F.nullif("length", F.lit(0.0))).otherwise(F.lit(0.0)))
    return listed.select(key, unit.alias("vector"))


class EmbeddingStore:
    """Vectors and frequencies under ``folder``, both in versions. A run that dies leaves frequencies that count for nothing."""

    def __init__(self, spark: SparkSession, folder: str, key: str, dims: int):
        self.key, self.dims = key, dims
        self.vectors, self.frequencies = VersionedTable(spark, f"{folder}/vectors"), VersionedTable(spark, f"{folder}/frequencies")

    def embed_missing(self, documents: DataFrame, text: str) -> int:
        """Store vectors for the documents whose key has none, null for a text without tokens; returns the vectors' version.

        Stored documents are told apart by key alone: their texts are neither cut into tokens nor counted again. Keys are unique and not null.
        """
        wanted, batch = documents.where(F.col(self.key).isNotNull()).select(self.key, F.col(text).alias("text")), uuid.uuid4().hex
        if self.vectors.version():
            wanted = wanted.join(self.vectors.read().select(self.key), self.key, "left_anti")
        wanted = pin(wanted)
        if wanted.isEmpty() and self.vectors.version():
            return self.vectors.version()
        counts = pin(place_counts(wanted, self.key, "text", self.dims))
        own = frequencies(counts, self.key).withColumn("batch", F.lit(batch))
        known = pin(own)
        if self.vectors.version():
            done = self.vectors.read().select("batch").distinct()
            known = known.unionByName(self.frequencies.read().join(done, "batch", "left_semi").select("place", "documents", "batch"))
        self.frequencies.append(own)
        made = wanted.select(self.key).join(vectors(counts, self.key, known, self.dims), self.key, "left")
        return self.vectors.append(made.withColumn("batch", F.lit(batch)))

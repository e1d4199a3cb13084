"""Exact deduplication through streaming keyed state on disk that never expires.

Every text arrives as (digest, identifier, size, locator). A Structured Streaming aggregation keeps, for each digest ever seen,
the copy that stays and how many came; its state lives in RocksDB, on disk and in the checkpoint folder, has no watermark and
so never forgets a key. The state is then read as a table, and each hit is compared with the full bytes of the row that
its locator names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    # A task closes its store when it is done. Else an executor holds all its stores open for a minute after the query, memory for each.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # Without this each of many small stores reserves 4 MB for its manifest.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), common.WHITE, "")


def arrivals(docs: DataFrame, digest) -> DataFrame:
    """One narrow row per document: digest, id, code points of the original text, and where its content lies."""
    return docs.select(
        digest(normalised(F.col("text"))).alias("digest"), F.col("doc_id").cast("long").alias("doc_id"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("size"), F.col("locator"),
        F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))


def run_state(spark: SparkSession, landed: str, schema, checkpoint: str, max_files: int | None = None) -> DataFrame:
    """Feed the landed arrivals that the state has not seen; the state after them: digest, keep, group_size.

    Calling again with the same checkpoint goes on from there: files already counted are not read again.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # Larger first: more code points, then smaller id (null ids last), then smaller locator.
    rank = F.struct("size", (-F.col("doc_id")).alias("minus_id"))
    state = (reader.parquet(landed).groupBy("digest")
             .agg(F.max_by(F.struct("doc_id", "locator"), F.struct(rank, "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size")))
    query = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with common.settings(spark, STATE):
        query.start().awaitTermination()
        stored = spark.read.format("statestore").load(checkpoint)
        value = [f.name for f in stored.schema["value"].dataType.fields]
        # Aggregation buffers in order: the kept struct, its rank, the count.
        return common.pin(stored.select(F.col("key.digest").alias("digest"), F.col("value")[value[0]].alias("keep"),
                                        F.col("value")[value[2]].alias("group_size")), "state")


def decide(docs: DataFrame, digest=lambda text: F.sha2(text, 256), max_files: int | None = None) -> DataFrame:
    """One narrow row per row of ``docs``: doc_id, locator, keep_id, keep_locator, group_size, kept, text_sha256.

    Texts are equal when identical after deleting ASCII white space; null text counts as empty. Of equal texts the row with the
    most code points stays, then the smallest doc_id (null ids last), then the last place in the files; exactly one row stays,
    also among rows that repeat an id. An empty table gives an empty result; columns other than doc_id and text are not read.
    Only narrow rows go through the state. Texts of rows that were hit are compared in full with the kept row's, and should a
    digest ever stand for two texts, its rows are regrouped by the text itself.
    """
    with common.scratch(docs.sparkSession) as kept:
        decided = _decide(docs, digest, max_files)
        kept.append(decided)
    return decided


def _decide(docs: DataFrame, digest, max_files: int | None) -> DataFrame:
    spark = docs.sparkSession
    docs = common.with_row_id(docs.select("doc_id", "text"), "locator")
    landed, checkpoint = common.folder(spark, "arrivals"), common.folder(spark, "dedup-state")
    rows = arrivals(docs, digest)
    rows.write.option("compression", "zstd").parquet(landed)
    state = run_state(spark, landed, rows.schema, checkpoint, max_files)

    seen = spark.read.schema(rows.schema).parquet(landed)
    decided = common.pin(seen.join(state, "digest").select(
        *seen.columns, "group_size", F.col("keep.doc_id").alias("keep_id"), F.col("keep.locator").alias("keep_locator")), "decided")

    # Full bytes of hits against the kept row's. One pass over the texts fetches both by their locators.
    several = common.pin(decided.where(F.col("group_size") > 1).select("digest", "locator", "keep_locator"), "several")
    bodies = common.fetch(docs.select("locator", normalised(F.col("text")).alias("body")), several, "locator", "hits")
    keepers = bodies.where(F.col("locator") == F.col("keep_locator")).select("keep_locator", F.col("body").alias("kept_body"))
    hits = bodies.where(F.col("locator") != F.col("keep_locator"))
    clashing = common.pin(hits.join(keepers, "keep_locator").where(F.col("body") != F.col("kept_body")).select("digest").distinct(), "clashes")
    if not clashing.isEmpty():
        decided = _regroup(decided, bodies.select("locator", "body"), clashing)
    return decided.withColumn("kept", F.col("locator") == F.col("keep_locator")).drop("digest", "size")


def deduplicate(docs: DataFrame, digest=lambda text: F.sha2(text, 256), max_files: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``; rules as in :func:`decide`.

    Rows of files are found again by file and position, so repeated and null ids do no harm.
    """
    if not common.is_file_backed(docs):
        docs = common.pin(docs, "rows")
    columns, (place,) = docs.columns, common.fresh(docs, "locator")
    with common.scratch(docs.sparkSession) as kept:
        dropped = common.pin(decide(docs, digest, max_files).where(~F.col("kept")).select(F.col("locator").alias(place)), "dropped")
        kept.append(dropped)
    return common.with_row_id(docs, place).join(dropped, place, "left_anti").select(columns)


def _regroup(decided: DataFrame, bodies: DataFrame, clashing: DataFrame) -> DataFrame:
    """Rows of digests that stand for several texts, grouped by digest and whole text instead."""
    rows = decided.join(clashing, "digest", "left_semi").join(bodies, "locator")
    rank = F.struct("size", (-F.col("doc_id")).alias("minus_id"))
    groups = rows.groupBy("digest", "body").agg(
        F.max_by(F.struct("doc_id", "locator"), F.struct(rank, "locator")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    fixed = rows.drop("group_size", "keep_id", "keep_locator").join(groups, ["digest", "body"]).select(
        *decided.columns[:-3], "group_size", F.col("keep.doc_id").alias("keep_id"), F.col("keep.locator").alias("keep_locator"))
    return decided.join(clashing, "digest", "left_anti").unionByName(fixed)

"""Substring deduplication by level-wise doubling over words.

Windows of half the length come first, as a content-chosen sample; those that no second text has end there. The rest are extended to
twice their length, at every place around them, and again only windows that occur again stay. The doubling ends at the
length asked for, or before it when no candidate survives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common, fingerprints, repeats


def rule(length: int) -> repeats.Rule:
    def keep(data: bytes, flags: np.ndarray) -> bytes:
        return b" ".join(word for word, gone in zip(data.split(), flags.tolist()) if not gone)

    return repeats.Rule(length, (length + 1) // 2, True, lambda data: (fingerprints.words(data)[2], 0), keep,
                        lambda data: fingerprints.words(data, 1)[2])


def with_words(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, n_words, cls (from the word sequence's hash), kept_sha256 of all words."""
    def run(batches):
        import hashlib

        for batch in (piece for whole in batches for piece in common.slices(whole)):
            split = [v.as_py().split() for v in batch.column("bytes")]
            shas = [hashlib.sha256(b" ".join(words)).digest() for words in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array([len(w) for w in split], pa.int64()),
                 pa.array([int.from_bytes(s[:8], "big") >> 1 for s in shas], pa.int64()), pa.array([s.hex() for s in shas], pa.string())],
                names=["row_id", "doc_id", "n_words", "cls", "words_sha256"])

    fields = [("row_id", T.StringType()), ("doc_id", T.LongType()), ("n_words", T.LongType()), ("cls", T.LongType()), ("words_sha256", T.StringType())]
    rows = docs.select("row_id", F.col("doc_id").cast("long").alias("doc_id"), common.text_bytes().alias("bytes"))
    return rows.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def decide(docs: DataFrame, length: int = 50) -> DataFrame:
    """doc_id, row_id, n_words, n_removed, starts, kept, words_sha256: one row per row of ``docs`` (doc_id, text).

    Each word covered by a window of ``length`` words whose sequence also starts in a document with a smaller doc_id goes;
    windows are judged on the input. Null text has no words; texts with fewer words lose nothing; of equal word sequences all but those
    with the smallest id go whole. A null id is larger than all others, and rows that share an id take nothing from each
    other. ``kept`` (bytes: words that stay, joined by one space) is null where nothing goes. An empty table gives an empty
    result; other columns are not read. ``length`` is at least 2.
    """
    if length < 2:
        raise ValueError("length is at least 2")
    docs = common.with_row_id(docs.select("doc_id", "text"), "row_id")
    rows = common.pin(with_words(docs), "rows")
    order = F.coalesce("doc_id", F.lit(repeats.NO_ID))
    classes = common.pin(rows.groupBy("cls").agg(F.min_by(F.struct("row_id", "doc_id", "n_words"), F.struct(order, "row_id")).alias("r"))
                         .select("cls", "r.*"), "classes")
    # A task reads texts with their class; the class is the text's own, so it is computed again instead of joined.
    found = repeats.removals(_with_class(docs), classes.where(F.col("n_words") >= length), rule(length))
    fate = common.pin(classes.select("cls", F.coalesce("doc_id", F.lit(repeats.NO_ID)).alias("first_id")).join(found, "cls", "left"), "fate")
    whole = (F.col("first_id") < order) & (F.col("n_words") >= length)
    return rows.join(fate, "cls").select(
        "row_id", "doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(~whole, F.col("starts")).alias("starts"), F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"), "words_sha256")


def _with_class(docs: DataFrame) -> DataFrame:
    """row_id, cls, bytes: the text and the class that :func:`with_words` gives it."""
    def run(batches):
        import hashlib

        for batch in (piece for whole in batches for piece in common.slices(whole)):
            shas = [hashlib.sha256(b" ".join(v.as_py().split())).digest() for v in batch.column("bytes")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.array([int.from_bytes(s[:8], "big") >> 1 for s in shas], pa.int64()), batch.column("bytes")],
                names=["row_id", "cls", "bytes"])

    fields = [("row_id", T.StringType()), ("cls", T.LongType()), ("bytes", T.BinaryType())]
    return docs.select("row_id", common.text_bytes().alias("bytes")).mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))


def digest(docs: DataFrame, length: int = 50) -> DataFrame:
    return decide(docs, length).select(
        "doc_id", "n_words", "n_removed", F.coalesce(F.sha2("kept", 256), "words_sha256").alias("kept_sha256"))


def deduplicate(docs: DataFrame, length: int = 50) -> DataFrame:
    """Like :func:`decide`, with ``kept`` for every row: all its words, joined by one space, where nothing goes."""
    docs = docs if common.is_file_backed(docs) else common.pin(docs, "rows")
    texts = common.with_row_id(docs.select("text"), "row_id")
    tidy = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return decide(docs, length).join(texts, "row_id").withColumn("kept", F.coalesce("kept", tidy.cast("binary"))).drop("text")

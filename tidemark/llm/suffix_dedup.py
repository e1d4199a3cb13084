"""Suffix-array deduplication by a depth-limited radix sort.

Suffixes are told apart only by their first ``length`` bytes, in passes of most significant digits, a digit being a run of bytes.
The first digit is the first half of the depth, read at content-sampled suffixes; groups of one leave. The second digit is the rest, read at
every suffix that the first pass left in doubt. Digits are compared by fingerprints, whose ranges are the buckets of the
distributed pass. Suffixes that are equal to the full depth form one group: exactly the windows that occur again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, fingerprints, repeats


def rule(length: int) -> repeats.Rule:
    def keep(data: bytes, flags: np.ndarray) -> bytes:
        return np.frombuffer(data, np.uint8)[~flags].tobytes()

    return repeats.Rule(length, max(8, length // 2), False, lambda data: (fingerprints.grams(data), 7), keep)


def decide(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, row_id, n_bytes, n_removed, n_spans, starts, kept, text_sha256: one row per row of ``docs`` (doc_id, text).

    Every byte covered by a ``length``-byte string that also starts anywhere else, same document included, goes; overlaps count
    and strings are judged on the input. Null text is empty; texts under ``length`` bytes lose nothing; texts that are equal to
    another row's and long enough go whole. ``starts`` are the windows' places as little-endian 64-bit numbers (null where the
    text goes whole or loses nothing), ``kept`` the bytes that stay (null where nothing goes; not always valid UTF-8, as windows
    are bytes). Repeated and null ids keep a row each; an empty table gives an empty result; other columns are not read.
    ``length`` is at least 16.
    """
    if length < 16:
        raise ValueError("length is at least 16")
    docs = common.with_row_id(docs.select("doc_id", "text"), "row_id")
    data = common.text_bytes()
    identity = F.conv(F.substring("text_sha256", 1, 15), 16, 10).cast("long").alias("cls")
    rows = common.pin(docs.select("row_id", F.col("doc_id").cast("long").alias("doc_id"), F.sha2(data, 256).alias("text_sha256"),
                                  F.length(data).cast("long").alias("n_bytes")).select("*", identity), "rows")
    classes = common.pin(rows.groupBy("cls").agg(F.min_by(F.struct("row_id", "doc_id", "n_bytes"), "row_id").alias("r"), F.count(F.lit(1)).alias("copies"))
                         .select("cls", "r.*", "copies"), "classes")
    texts = docs.select("row_id", data.alias("bytes"), F.sha2(data, 256).alias("text_sha256")).select("row_id", "bytes", identity)
    found = repeats.removals(texts, classes.where(F.col("n_bytes") >= length), rule(length))
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    fate = common.pin(classes.select("cls", "copies").join(found, "cls", "left"), "fate")
    return rows.join(fate, "cls").select(
        "row_id", "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(~whole, F.col("starts")).alias("starts"), F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, length: int = 400) -> DataFrame:
    """Like :func:`decide`, with ``kept`` for every row: its whole text where nothing goes."""
    docs = docs if common.is_file_backed(docs) else common.pin(docs, "rows")
    texts = common.with_row_id(docs.select("text"), "row_id")
    return decide(docs, length).join(texts, "row_id").withColumn("kept", F.coalesce("kept", common.text_bytes())).drop("text")


def digest(docs: DataFrame, length: int = 400) -> DataFrame:
    return decide(docs, length).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.coalesce(F.sha2("kept", 256), "text_sha256").alias("kept_sha256"))

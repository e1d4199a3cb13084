"""Packing token sequences: concatenate and cut, by two passes of prefix sums.

The first pass turns every text into ids, once, and keeps for each document how many ids of its partition come before it. The totals of
the partitions, summed up, say where each partition begins in the concatenation of all documents. The second pass cuts at
every multiple of the sequence length. Both passes are narrow: no document is shuffled. Only a sequence that reaches over the end of a
partition needs another one; its parts are boundary records, at most two of a partition, which meet by sequence.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bpe, common


def ranks_of(source: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Token bytes to ids, and the special tokens, of a vocabulary file's text.

    The library that merges takes the lowest id first, so merges must make ids in ascending order.
    """
    data = json.loads(source)
    alphabet = bpe.byte_alphabet()
    ids = {bytes(alphabet[c] for c in token): i for token, i in data["model"]["vocab"].items() if all(c in alphabet for c in token)}
    made = []
    for merge in data["model"]["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        made.append(ids[bytes(alphabet[c] for c in left + right)])
    if any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError("the vocabulary's merges do not make its ids in ascending order")
    special = {t["content"]: t["id"] for t in data["added_tokens"] if t["special"]}
    return {token: i for token, i in ids.items() if token.decode("utf-8", "replace") not in special}, special


def encoder(ranks: dict[bytes, int], special: dict[str, int]):
    """A function from a text to its ids, special tokens in the text included."""
    import tiktoken

    whole, special = tiktoken.Encoding("vocabulary", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens=special), frozenset(special)
    return lambda text: whole.encode_to_numpy(text, allowed_special=special)


def tokenise(docs: DataFrame, vocabulary_path: str, end_id: int = 1) -> DataFrame:
    """First pass, written once: ``doc_id, ids`` (little-endian unsigned 32-bit, ``end_id`` last), ``doc_tokens``, the row's
    partition ``part`` and the number ``before`` of ids that come before it there."""
    with open(vocabulary_path, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(ranks_of(file.read()))

    def run(batches):
        from pyspark import TaskContext

        encode, part, before = encoder(*shipped.value), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in (piece for whole in batches for piece in common.by_bytes(whole, "text")):
            ids = [encode(text.as_py()).astype("<u4", copy=False).tobytes() + end for text in batch.column("text")]
            sizes = np.array([len(x) // 4 for x in ids], "int64")
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(sizes),
                 pa.array(np.full(len(ids), part, "int32")), pa.array(starts)], names=["doc_id", "ids", "doc_tokens", "part", "before"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return common.pin(texts.mapInArrow(run, f"doc_id {kind}, ids binary, doc_tokens long, part int, before long"), "tokens")


def partition_starts(tokens: DataFrame) -> np.ndarray:
    """Where each partition of the first pass begins among all ids. One number a partition: 7 MB for 100 TB read in splits of 128 MB."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect()
    sizes = np.zeros(max((row["part"] for row in totals), default=-1) + 1, "int64")
    for row in totals:
        sizes[row["part"]] = row["n"]
    return np.cumsum(sizes) - sizes


def pieces(tokens: DataFrame, length: int = 2048) -> DataFrame:
    """Second pass over what :func:`tokenise` wrote: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` for each piece.

    ``start`` counts the ids of the document before the piece, ``offset`` those of the sequence.
    """
    shipped = tokens.sparkSession.sparkContext.broadcast(partition_starts(tokens))

    def run(batches):
        begins = shipped.value
        for batch in (piece for whole in batches for piece in common.by_bytes(whole, "ids")):
            sizes, part, before = (batch.column(c).to_numpy() for c in ("doc_tokens", "part", "before"))
            begin = begins[part] + before
            cuts = (begin + sizes - 1) // length - begin // length + 1
            row = np.repeat(np.arange(len(sizes)), cuts)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            sequence = (begin // length)[row] + nth
            start = np.maximum(sequence * length - begin[row], 0)
            end = np.minimum((sequence + 1) * length - begin[row], sizes[row])
            ids = batch.column("ids")
            views, last = {}, -1
            cut = []
            for r, a, b in zip(row.tolist(), start.tolist(), end.tolist()):
                if r != last:
                    views, last = memoryview(ids[r].as_buffer()), r
                cut.append(bytes(views[4 * a:4 * b]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(end - start), pa.array(cut, pa.binary()),
                 pa.array(sizes[row]), pa.array(sequence), pa.array(begin[row] + start - sequence * length)],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids", "doc_tokens", "part", "before").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary_path: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """Every document, its ids and ``end_id`` after them, laid out in sequences of ``length`` ids: the rows of :func:`pieces`.

    Only the last sequence can be shorter than ``length``. Documents follow each other as they are read; null and empty texts are
    ``end_id`` alone; copies and equal or null doc_ids are documents of their own; texts of any length are cut, never shortened. An
    empty table gives no pieces. Only doc_id and text are read, so other columns may have any name.
    """
    return pieces(tokenise(docs, vocabulary_path, end_id), length)


def sequences(docs: DataFrame, vocabulary_path: str, length: int = 2048, end_id: int = 1, pad_id: int = 0) -> DataFrame:
    """``sequence_id, ids, n_tokens``: the packed sequences themselves, padded to ``length`` unless their size is a power of two.

    A sequence that lies in one partition is put together there. What reaches over a partition's ends is a boundary record, and those
    of one sequence, at most ``length`` of them, are joined by a shuffle of two records a partition.
    """
    tokens = tokenise(docs, vocabulary_path, end_id)

    def join(batches):
        held, first, size = [], None, 0

        def emit():
            return pa.RecordBatch.from_pydict(
                {"sequence_id": [first[0]], "offset": [first[1]], "ids": [b"".join(held)]},
                schema=pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())]))

        for batch in batches:
            for sequence, offset, ids in zip(*(batch.column(c).to_pylist() for c in ("sequence_id", "offset", "ids"))):
                if first and (first[0] != sequence or first[1] + size != offset):
                    yield emit()
                    held, first, size = [], None, 0
                first = first or (sequence, offset)
                held.append(ids)
                size += len(ids) // 4
        if first:
            yield emit()

    runs = common.pin(pieces(tokens, length).select("sequence_id", "offset", "ids").mapInArrow(join, "sequence_id long, offset long, ids binary"), "runs")
    whole = F.octet_length("ids") == 4 * length
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    none = F.lit(b"")
    met = runs.where(~whole).groupBy("sequence_id").agg(
        F.aggregate(parts, none, lambda done, part: F.concat(done, part["ids"])).alias("ids"))
    every = runs.where(whole).select("sequence_id", "ids").unionByName(met)
    size = (F.octet_length("ids") / 4).cast("int")
    missing = F.when(F.bit_count(size) == 1, 0).otherwise(length - size)
    padding = F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), missing)
    return every.select("sequence_id", F.concat("ids", F.unhex(padding)).alias("ids"), size.cast("long").alias("n_tokens"))


def digest(docs: DataFrame, vocabulary_path: str, length: int = 2048) -> DataFrame:
    """The pieces of :func:`pack` with a CRC-32 of their ids in place of the ids; nulls, ties and empty tables as there."""
    return pack(docs, vocabulary_path, length).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

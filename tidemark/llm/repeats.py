"""Which windows of texts occur again: what suffix_dedup and substring_dedup share.

The work is in two levels. Level one looks at a content-chosen sample of short windows: wherever a full window occurs twice, the
same sampled short window lies inside both. Only texts and places around short windows that occur again go on. Level two
fingerprints every full window there with 96 bits. Texts are dealt over shards; a shard sends each distinct fingerprint once, in
packed blocks by fingerprint range, and gets back one bit for each. So neither many copies nor a passage that a third of all
texts share brings more than one entry per shard together.

Equal texts are one class and enter once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, fingerprints

NO_ID = (1 << 63) - 1
RESULT = "cls long, starts binary, kept binary, n_removed long, n_spans long"


@dataclass(frozen=True)
class Rule:
    """What a window is. ``units`` turns bytes into (values, extra): a run of ``length`` units is a run of ``length - extra`` values.

    ``first_only``: a window goes if it starts in a text with a smaller id; otherwise if it starts anywhere else.
    ``keep`` turns (bytes, flags of removed units) into the bytes that stay. ``second`` gives the values of the second fingerprint where
    values are hashes themselves, so that the two are independent; without it both are taken of the same values.
    """

    length: int
    short: int
    first_only: bool
    units: Callable[[bytes], tuple[np.ndarray, int]]
    keep: Callable[[bytes, np.ndarray], bytes]
    second: Callable[[bytes], np.ndarray] | None = None


def short_windows(rule: Rule, values: np.ndarray, extra: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, fingerprints) of the sampled short windows of one text; none if it is shorter than a full window."""
    n = len(values) - (rule.short - extra) + 1
    if len(values) + extra < rule.length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    prints = fingerprints.windows(fingerprints.prefix(values), np.arange(n), rule.short - extra)
    places = fingerprints.anchors(prints, rule.length - rule.short + 1)
    return places, prints[places]


def level_one(rows: DataFrame, rule: Rule) -> DataFrame:
    """(print, cls, again) of sampled short windows of ``rows`` (cls, bytes); ``again`` is 1 if the text has it at several places.

    A task sends each class once.
    """
    def run(batches):
        done = set()
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            prints, classes, again = [], [], []
            for cls, data in zip(batch.column("cls").to_pylist(), batch.column("bytes")):
                if cls in done:
                    continue
                done.add(cls)
                found, count = np.unique(short_windows(rule, *rule.units(data.as_py()))[1], return_counts=True)
                prints.append(found)
                classes.append(np.full(len(found), cls, np.int64))
                again.append((count > 1).astype(np.int64))
            if prints:
                yield pa.RecordBatch.from_pydict({
                    "print": np.concatenate(prints).view(np.int64), "cls": np.concatenate(classes), "again": np.concatenate(again)})

    return rows.select("cls", "bytes").mapInArrow(run, "print long, cls long, again long")


def survivors(sampled: DataFrame, rule: Rule) -> DataFrame:
    """(cls, prints): per class, the sampled prints that other classes, or other places of the same text, have too."""
    shared = F.min("cls") < F.max("cls")
    counts = sampled.groupBy("print").agg((shared if rule.first_only else shared | (F.max("again") > 0)).alias("shared"))
    kept = counts.where("shared").select("print")
    return sampled.join(kept, "print").groupBy("cls").agg(F.collect_set("print").alias("prints"))


def _places(rule: Rule, data: bytes, prints) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, first fingerprint, second) of the full windows around the surviving short windows of one text."""
    values, extra = rule.units(data)
    where, found = short_windows(rule, values, extra)
    where = where[np.isin(found, np.asarray(prints, np.int64).view(np.uint64))]
    last = len(values) + extra - rule.length
    change = np.zeros(last + 2, np.int64)
    np.add.at(change, np.clip(where - (rule.length - rule.short), 0, last + 1), 1)
    np.add.at(change, np.clip(where + 1, 0, last + 1), -1)
    starts = np.flatnonzero(np.cumsum(change)[:last + 1] > 0)
    size = rule.length - extra
    one = fingerprints.windows(fingerprints.prefix(values), starts, size)
    two = fingerprints.windows(fingerprints.prefix(rule.second(data) if rule.second else values, 1), starts, size, 1).astype(np.uint32)
    return starts, one, two


def _gather(rule: Rule, table: pa.Table, buckets: int):
    """All candidate windows of a shard, and its distinct fingerprints in the order in which they are sent."""
    docs = table.select(["cls", "doc_id", "bytes", "prints"])
    parts = [_places(rule, data.as_py(), prints.as_py()) for data, prints in zip(docs.column("bytes"), docs.column("prints"))]
    owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    starts, one, two = (np.concatenate([p[i] for p in parts]) for i in range(3))
    ids = np.array([NO_ID if i is None else i for i in docs.column("doc_id").to_pylist()], np.int64)[owner]
    bucket = (one % np.uint64(buckets)).astype(np.int64)
    by = np.lexsort((ids, two, one, bucket))
    new = np.ones(len(by), bool)
    new[1:] = (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])
    run = np.cumsum(new) - 1
    number = np.empty(len(by), np.int64)
    number[by] = run
    first = by[new]
    return owner, starts, ids, number, np.bincount(run), one[first], two[first], ids[first], bucket[first]


def send(candidates: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """(bucket, shard, one, two, ids): the distinct fingerprints of each shard, with the smallest id that has each, packed by bucket."""
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        _, _, _, _, _, one, two, least, bucket = _gather(rule, table, buckets)
        edge = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]]) if len(bucket) else np.zeros(1, np.int64)
        pieces = [slice(a, b) for a, b in zip(edge[:-1], edge[1:])]
        return pa.table({
            "bucket": pa.array([int(bucket[p.start]) for p in pieces], pa.int64()), "shard": pa.array([shard] * len(pieces), pa.int64()),
            "one": pa.array([one[p].tobytes() for p in pieces], pa.binary()), "two": pa.array([two[p].tobytes() for p in pieces], pa.binary()),
            "ids": pa.array([least[p].tobytes() if rule.first_only else b"" for p in pieces], pa.binary())})

    return candidates.groupBy("shard").applyInArrow(run, "bucket long, shard long, one binary, two binary, ids binary")


def answer(sent: DataFrame, rule: Rule) -> DataFrame:
    """(shard, bucket, bits): for each fingerprint sent, whether another shard has it (with a smaller id, if that is the rule)."""
    def run(table: pa.Table) -> pa.Table:
        one = [np.frombuffer(x.as_py(), "<u8") for x in table.column("one")]
        two = [np.frombuffer(x.as_py(), "<u4") for x in table.column("two")]
        sizes = [len(x) for x in one]
        one, two = np.concatenate(one), np.concatenate(two)
        by = np.lexsort((two, one))
        new = np.ones(len(by), bool)
        new[1:] = (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])
        run_of = np.empty(len(by), np.int64)
        run_of[by] = np.cumsum(new) - 1
        if rule.first_only:
            ids = np.concatenate([np.frombuffer(x.as_py(), "<i8") for x in table.column("ids")])
            yes = np.minimum.reduceat(ids[by], np.flatnonzero(new))[run_of] < ids
        else:
            yes = np.bincount(run_of)[run_of] > 1
        bits = [np.packbits(part).tobytes() for part in np.split(yes, np.cumsum(sizes)[:-1])]
        return pa.table({"shard": table.column("shard"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, "shard long, bucket long, bits binary")


def decide(candidates: DataFrame, answers: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """``RESULT`` for each candidate class that has a window to remove: the windows' starts and the bytes that stay."""
    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        if table.num_rows:
            owner, starts, ids, number, count, one, _, least, bucket = _gather(rule, table, buckets)
            yes = np.zeros(len(one), bool)
            for b, bits in zip(replies.column("bucket").to_pylist(), replies.column("bits").to_pylist()):
                low, high = np.searchsorted(bucket, [b, b + 1])
                yes[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low).astype(bool)
            gone = yes[number] | ((least[number] < ids) if rule.first_only else (count[number] > 1))
            edge = np.searchsorted(owner, np.arange(table.num_rows + 1))
            for i, (cls, data) in enumerate(zip(table.column("cls").to_pylist(), table.column("bytes"))):
                places = starts[edge[i]:edge[i + 1]][gone[edge[i]:edge[i + 1]]]
                if len(places):
                    data = data.as_py()
                    values, extra = rule.units(data)
                    flags = fingerprints.covered(places, rule.length, len(values) + extra)
                    spans = int(flags[0]) + int((np.diff(flags.astype(np.int8)) == 1).sum())
                    rows.append((cls, places.astype("<i8").tobytes(), rule.keep(data, flags), int(flags.sum()), spans))
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["cls", "starts", "kept", "n_removed", "n_spans"])

    return candidates.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(run, RESULT)


def removals(texts: DataFrame, classes: DataFrame, rule: Rule, shard_bytes: int = 4 << 20) -> DataFrame:
    """``RESULT`` per class with something to remove; ``texts`` are (row_id, cls, bytes), ``classes`` (cls, row_id, doc_id, n).

    A class enters as its row ``row_id``; shards hold about ``shard_bytes`` of text, so what a task holds does not grow with the input.
    """
    # Counted and then joined, so it is written once instead of sampling all texts twice.
    sampled = common.pin(level_one(texts.where(F.length("bytes") >= rule.length), rule), "sampled")
    kept = survivors(sampled, rule)
    wanted = common.pin(classes.select("cls", "row_id", "doc_id").join(kept, "cls"), "wanted")
    candidates = common.fetch(texts.select("row_id", "bytes"), wanted, "row_id", "candidates").select("cls", "doc_id", "bytes", "prints")
    total = candidates.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64("cls"), F.lit(shards)))
    sent = send(dealt, rule, shards)
    return common.pin(decide(dealt, answer(sent, rule), rule, shards), "removals")

"""Exact top-k search over binary codes by incremental multi-index hashing.

A 64-bit code is cut into four segments of 16 bits, each with an index of its own. Round r looks up, for every pending query
and segment, all values at distance exactly r from the query's segment, and verifies the whole codes found there. A code within 4 (r + 1) - 1
bits has a segment within r bits, so after round r everything up to that distance has been seen: a query is done when its
kth verified distance is not above it. The index is in parts; a query block meets each part as one row, and only a
running top list leaves a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm import common

BITS, SEGMENTS = 64, 4
WIDTH = BITS // SEGMENTS


def with_code(rows: DataFrame, vector: str) -> DataFrame:
    """``rows`` with ``code``: bit i is set where component i is above zero. Vectors that are null or not of 64 components have none."""
    code = F.expr(f"aggregate(sequence(0, {BITS - 1}), 0L, (a, i) -> a | shiftleft(if({vector}[i] > 0, 1L, 0L), i))")
    return rows.withColumn("code", F.when(F.size(vector) == BITS, code))


def build_index(rows: DataFrame, keep: int, part_rows: int) -> tuple[DataFrame, int]:
    """Index parts (part, codes, firsts, ids, order) of ``rows`` (id, code), and how many there are.

    Equal codes are one entry with their ``keep`` smallest ids: no other id of that code can be among ``keep`` nearest, ties going
    to smaller ids. ``order`` holds, per segment, the entries sorted by that segment's value.
    """
    smallest = Window.partitionBy("code").orderBy("id")
    entries = common.pin(rows.where(F.col("code").isNotNull() & F.col("id").isNotNull()).select("id", "code").distinct()
                         .withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= keep)
                         .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    parts = max(1, -(-entries.count() // part_rows))

    def pack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes = np.array([e["code"] for e in row["entries"]], "<i8").view("<u8")
                ids = [e["ids"] for e in row["entries"]]
                firsts = np.cumsum([0, *map(len, ids)]).astype("<i4")
                order = [np.argsort(segment(codes, s), kind="stable").astype("<i4") for s in range(SEGMENTS)]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([row["part"]], pa.int64()), "codes": [codes.tobytes()], "firsts": [firsts.tobytes()],
                    "ids": [np.array([i for own in ids for i in own], "<i8").tobytes()], "order": [b"".join(o.tobytes() for o in order)]})

    packed = entries.groupBy(F.pmod(F.xxhash64("code"), F.lit(parts)).alias("part")).agg(F.collect_list(F.struct("code", "ids")).alias("entries"))
    return common.pin(packed.mapInArrow(pack, "part long, codes binary, firsts binary, ids binary, order binary"), "index"), parts


def segment(codes: np.ndarray, s: int) -> np.ndarray:
    return (codes >> np.uint64(WIDTH * s)) & np.uint64((1 << WIDTH) - 1)


def probe(codes, order, queries, bounds, radius: int, keep: int):
    """(query number, entry number, distance) of entries with a segment at ``radius`` from the query's, none nearer, best ``keep`` each.

    A pair is verified in the first such segment only, so once in all rounds. Entries beyond a query's bound are left out.
    """
    values = np.arange(1 << WIDTH, dtype=np.uint64)
    masks = values[np.bitwise_count(values) == radius]
    n = len(codes)
    found = []
    for s in range(SEGMENTS):
        own = order[s * n:(s + 1) * n]
        starts = np.concatenate([[0], np.cumsum(np.bincount(segment(codes, s).astype(np.int64), minlength=1 << WIDTH))])
        for at in range(0, len(queries), 64):
            block = queries[at:at + 64]
            looked = (segment(block, s)[:, None] ^ masks[None, :]).astype(np.int64)
            low = starts[looked]
            size = (starts[looked + 1] - low).ravel()
            hit = np.flatnonzero(size)
            if not len(hit):
                continue
            size, low = size[hit], low.ravel()[hit]
            query = np.repeat(hit // len(masks), size)
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            entry = own[np.repeat(low, size) + inside]
            differ = codes[entry] ^ block[query]
            distance = np.bitwise_count(differ).astype(np.int64)
            ok = distance <= bounds[at + query]
            for t in range(SEGMENTS):
                if t != s:
                    apart = np.bitwise_count(segment(differ, t))
                    ok &= apart > radius if t < s else apart >= radius
            found.append((at + query[ok], entry[ok], distance[ok]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def round_of(pending: DataFrame, index: DataFrame, parts: int, radius: int, keep: int, block_rows: int) -> DataFrame:
    """(code, id, distance): from each part, the best ``keep`` that round ``radius`` finds for each pending query (code, bound)."""
    blocks = -(-pending.count() // block_rows)
    rows = (pending.groupBy(F.pmod(F.xxhash64("code", F.lit("block")), F.lit(blocks)).alias("block"))
            .agg(F.collect_list(F.struct("code", "bound")).alias("queries"))
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))))

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                codes, firsts = np.frombuffer(row["codes"].as_py(), "<u8"), np.frombuffer(row["firsts"].as_py(), "<i4")
                ids, order = np.frombuffer(row["ids"].as_py(), "<i8"), np.frombuffer(row["order"].as_py(), "<i4")
                asked = row["queries"].as_py()
                queries = np.array([q["code"] for q in asked], "<i8").view("<u8")
                query, entry, distance = probe(codes, order, queries, np.array([q["bound"] for q in asked]), radius, keep)
                query, entry, distance = best(query, entry, distance, ids[firsts[entry]], keep)
                size = (firsts[entry + 1] - firsts[entry]).astype(np.int64)
                each = ids[np.repeat(firsts[entry], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
                query, each, distance = best(np.repeat(query, size), each, np.repeat(distance, size), each, keep)
                yield pa.RecordBatch.from_pydict({"code": queries.view("<i8")[query], "id": each, "distance": distance.astype("<i4")})

    def best(query, what, distance, tie, keep):
        by = np.lexsort((tie, distance, query))
        query, what, distance = query[by], what[by], distance[by]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        return query[rank < keep], what[rank < keep], distance[rank < keep]

    return rows.join(index, "part").drop("part", "block").mapInArrow(run, "code long, id long, distance int")


def top_k(rows: DataFrame, queries: DataFrame, k: int, vector: str = "embedding", id_column: str = "vec_id",
          part_rows: int = 4096, block_rows: int = 1024) -> DataFrame:
    """query_id, rank, neighbour_id, distance: the ``k`` rows nearest to each query in Hamming distance, ties by smaller id.

    A query is a row of ``queries`` with the same columns; the row with its own id is not its neighbour, a row with an equal code is, at 0.
    Null ids, null vectors and vectors of another length have no code: they neither ask nor are found. Rows that repeat an id with
    the same vector count once, with different vectors once each. Fewer than ``k`` rows give fewer ranks; empty tables give an
    empty result; other columns are not read. The result is exact: a query leaves only when its kth distance is covered.
    """
    def coded(table):
        return with_code(table.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("vector")), "vector").drop("vector")

    keep = k + 1  # the query's own row may be among them
    asked = common.pin(coded(queries).where("id is not null and code is not null").distinct(), "queries")
    index, parts = build_index(coded(rows), keep, part_rows)
    pending = asked.select("code", F.lit(BITS).alias("bound")).distinct()
    done = asked.select("code", F.col("id"), F.lit(0).alias("distance")).limit(0)
    waiting = done
    best = Window.partitionBy("code").orderBy("distance", "id")
    for radius in range(WIDTH + 1):
        pending = common.pin(pending, "pending")
        if pending.isEmpty():
            break
        new = round_of(pending, index, parts, radius, keep, block_rows)
        merged = waiting.unionByName(new).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep).drop("rank")
        waiting = common.pin(merged, "best")
        covered = SEGMENTS * (radius + 1) - 1 if radius < WIDTH else BITS
        state = waiting.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("worst"))
        state = pending.select("code").join(state, "code", "left").select(
            "code", F.when(F.col("n") >= keep, F.col("worst")).otherwise(BITS).alias("bound"))
        open_ = common.pin(state.where((F.col("bound") > covered) if radius < WIDTH else F.lit(False)), "open")
        done = done.unionByName(waiting.join(open_, "code", "left_anti"))
        waiting, pending = waiting.join(open_, "code", "left_semi"), open_
    own = Window.partitionBy("query_id", "code").orderBy("distance", "neighbour_id")
    found = (asked.withColumnRenamed("id", "query_id").join(done.withColumnRenamed("id", "neighbour_id"), "code")
             .where(F.col("query_id") != F.col("neighbour_id")).withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k))
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "neighbour_id", F.col("distance").cast("long").alias("distance"))

"""A stored vector index: vectors lie on disk by cell, and a search reads the cells its queries probe.

Cells are the regions around centres that k-means finds on a bounded sample; every row is indexed. Within a cell, vectors are stored in
blocks of bounded size, one row a block, so a hot cell is many blocks in many files and a join by cell moves blocks, not rows.
Each query probes the cells whose centres are nearest. How many it takes for the wanted recall is measured when the index is built,
against exact search, and kept with it. Found rows are scored as exact search does. New rows are appended to the cells there are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import search
from tidemark.operators.ranking import top_per_key
from tidemark.session import pin

#: Vectors in a block, queries scored together, and queries whose best rows a task holds before it gives them on.
BLOCK_ROWS, QUERY_ROWS, HELD_QUERIES = 1024, 256, 20_000


@dataclass
class VectorIndex:
    """``folder`` has the blocks, partitioned by cell; ``centres`` by cell number; ``probes`` cells reach ``recall`` as measured."""

    spark: SparkSession
    folder: str
    centres: list[list[float]]
    probes: int
    recall: float
    id_type: str

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(f"ids array<{self.id_type}>, vectors binary, cell int").parquet(f"{self.folder}/blocks")


def _usable(vectors: DataFrame, doc_id: str, vector: str) -> DataFrame:
    """``id, v`` of the rows that can be hits: not null, not zero, as in exact search."""
    v = F.col(vector).cast("array<double>")
    length = F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x)
    return vectors.select(F.col(doc_id).alias("id"), v.alias("v")).where(length > 0)


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows chosen by a hash of their id, the same ones each time."""
    share = max(1, -(-rows.count() // most))
    return rows.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0)


def _nearest(rows: DataFrame, centres: list[list[float]], count: int) -> DataFrame:
    """``rows`` (id, v) with ``cells``: the numbers of the ``count`` nearest centres by angle, nearest first."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        middle = np.asarray(centres, dtype="float64")
        middle = middle / np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-300)
        for batch in batches:
            v = np.asarray(batch.column(1).flatten().to_numpy(zero_copy_only=False)).reshape(batch.num_rows, -1)
            if batch.num_rows and v.shape[1] != middle.shape[1]:
                raise ValueError(f"vectors of length {v.shape[1]}, centres of {middle.shape[1]}")
            near = np.argsort(-(v @ middle.T), axis=1, kind="stable")[:, :count] if batch.num_rows else np.empty((0, count), int)
            cells = pa.array(near.astype("int32").tolist(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, "cells"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "v").mapInArrow(run, f"id {id_type}, v array<double>, cells array<int>")


def _fit(sample: DataFrame, cells: int, seed: int) -> list[list[float]]:
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    features = pin(sample.select(array_to_vector("v").alias("features")))
    model = KMeans(k=cells, maxIter=8, seed=seed, initMode="random", distanceMeasure="cosine").fit(features)
    return [list(map(float, centre)) for centre in model.clusterCenters()]


def _store(rows: DataFrame, centres: list[list[float]], folder: str) -> None:
    """Write the blocks. Rows are ranged by (cell, id), so a cell of any size is spread over tasks and each writes few cells."""
    id_type = rows.schema["id"].dataType.simpleString()
    placed = _nearest(rows, centres, 1).select(F.element_at("cells", 1).alias("cell"), "id", "v")

    def block(batches):
        import numpy as np
        import pyarrow as pa

        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}

        def emit(cell, ids, parts):
            v = np.concatenate(parts).astype("<f8")
            return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(kinds[id_type])), pa.array([v.tobytes()], pa.binary()), pa.array([cell], pa.int32())],
                                              names=["ids", "vectors", "cell"])

        cell, ids, parts = None, [], []
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            v = np.asarray(batch.column(2).flatten().to_numpy(zero_copy_only=False)).reshape(batch.num_rows, -1)
            edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), batch.num_rows]
            for low, high in zip(edges, edges[1:]):
                while low < high:
                    if ids and (cell != cells[low] or len(ids) == BLOCK_ROWS):
                        yield emit(cell, ids, parts)
                        ids, parts = [], []
                    cell = int(cells[low])
                    take = min(high, low + BLOCK_ROWS - len(ids))
                    ids += batch.column(1).slice(low, take - low).to_pylist()
                    parts.append(v[low:take])
                    low = take
        if ids:
            yield emit(cell, ids, parts)

    ranged = placed.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
    made = ranged.mapInArrow(block, f"ids array<{id_type}>, vectors binary, cell int")
    made.write.mode("append").partitionBy("cell").parquet(f"{folder}/blocks")


def build(vectors: DataFrame, doc_id: str, vector: str, folder: str, cells: int = 32, sample: int = 65_536, k: int = 10,
          recall: float = 0.95, trials: int = 64, seed: int = 7) -> VectorIndex:
    """Index every row of ``vectors`` under ``folder``; null and zero vectors are never hits and are left out.

    Centres are fitted on at most about ``sample`` rows chosen by hash; all rows are then assigned. ``trials`` indexed rows are searched
    exactly over all rows, and ``probes`` is the number of cells in which they find ``recall`` of their ``k`` nearest.
    """
    spark = vectors.sparkSession
    rows = _usable(vectors, doc_id, vector)
    id_type = rows.schema["id"].dataType.simpleString()
    if id_type not in ("bigint", "int", "string"):
        raise ValueError(f"ids are bigint, int or string, not {id_type}")
    few = _sample(rows, sample)
    known = min(cells, few.select("v").distinct().limit(cells).count())
    centres = _fit(few, known, seed) if known > 1 else [row["v"] for row in few.select("v").limit(1).collect()]
    if not centres:
        return VectorIndex(spark, folder, [], 0, 1.0, id_type)
    _store(rows, centres, folder)
    asked = pin(_sample(rows, trials).select(F.col("id").alias("query_id"), F.col("v").alias("vector")))
    exact = search.cosine_top_k(rows, asked, "id", "v", k + 1, None).where("query_id <> doc_id").select("query_id", "doc_id")
    where = _nearest(rows.join(exact.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi"), centres, 1)
    order = _nearest(asked.select(F.col("query_id").alias("id"), F.col("vector").alias("v")), centres, len(centres))
    ranked = exact.join(where.select(F.col("id").alias("doc_id"), F.element_at("cells", 1).alias("cell")), "doc_id").join(
        order.select(F.col("id").alias("query_id"), "cells"), "query_id")
    found = ranked.groupBy(F.array_position("cells", F.col("cell")).alias("nth")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, so_far, probes = sum(row["n"] for row in found), 0, 1
    for row in sorted(found, key=lambda r: r["nth"]):
        so_far, probes = so_far + row["n"], int(row["nth"])
        if so_far >= recall * total:
            break
    reached = so_far / total if total else 1.0
    spark.createDataFrame([(probes, reached, id_type, centres)], "probes int, recall double, id_type string, centres array<array<double>>").write.parquet(f"{folder}/settings")
    return VectorIndex(spark, folder, centres, probes, reached, id_type)


def load(spark: SparkSession, folder: str) -> VectorIndex:
    """A stored index."""
    row = spark.read.parquet(f"{folder}/settings").first()
    return VectorIndex(spark, folder, [list(c) for c in row["centres"]], row["probes"], row["recall"], row["id_type"])


def append(index: VectorIndex, vectors: DataFrame, doc_id: str, vector: str) -> None:
    """Add rows to the cells of their nearest centres; what is stored is not read."""
    _store(_usable(vectors, doc_id, vector), index.centres, index.folder)


def probed_blocks(index: VectorIndex, cells: list[int]) -> DataFrame:
    """The blocks of some cells: a filter on the partition column, so other cells' files are never opened."""
    return index.blocks().where(F.col("cell").isin(cells))


def top_k(index: VectorIndex, queries: DataFrame, k: int = 10, probes: int | None = None, threshold: float | None = None,
          offset: float = 1.0) -> DataFrame:
    """``query_id, doc_id, score, rank``: the best rows of the probed cells by cosine + ``offset``.

    ``queries`` has ``query_id`` and ``vector``; null and zero vectors find nothing. Queries of any number are dealt to the cells they probe
    and meet its blocks in groups of bounded size; neither queries nor hits pass through the driver, only the numbers of the cells.
    Ties of score are ordered by id.
    """
    query_type = queries.schema["query_id"].dataType.simpleString()
    hit_schema = f"query_id {query_type}, doc_id {index.id_type}, score double"
    if not index.centres:
        return top_per_key(queries.sparkSession.createDataFrame([], hit_schema), ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], k)
    rows = _usable(queries, "query_id", "vector")
    dealt = _nearest(rows, index.centres, min(probes or index.probes, len(index.centres)))
    dealt = pin(dealt.select("id", "v", F.explode("cells").alias("cell")))
    sizes = dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("parts"))
    cells = pin(sizes)
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    asked = dealt.join(cells, "cell").groupBy("cell", part.alias("part")).agg(F.collect_list(F.struct("id", "v")).alias("asked"))
    blocks = probed_blocks(index, [row["cell"] for row in cells.select("cell").collect()])
    meeting = blocks.join(pin(asked), "cell").select("ids", "vectors", "asked")

    def score(batches):
        import numpy as np
        import pyarrow as pa

        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        floor = -np.inf if threshold is None else threshold
        best: dict = {}

        def emit():
            found = [(query, doc, float(s)) for query, (scores, docs) in best.items() for s, doc in zip(scores, docs)]
            best.clear()
            for at in range(0, len(found), 50_000):
                columns = list(zip(*found[at:at + 50_000]))
                arrays = [pa.array(list(c), t) for c, t in zip(columns, (kinds[query_type], kinds[index_id_type], pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "doc_id", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                ids = np.array(batch.column(0)[at].as_py(), dtype=object)
                v = np.frombuffer(batch.column(1)[at].as_py(), "<f8").reshape(len(ids), -1)
                group = batch.column(2).slice(at, 1).flatten()
                names = group.field("id").to_pylist()
                q = np.asarray(group.field("v").flatten().to_numpy(zero_copy_only=False)).reshape(len(names), -1)
                q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
                # Rounded as exact search does, so that equal vectors get equal scores wherever they are computed.
                scores = np.round(v @ q.T / np.linalg.norm(v, axis=1)[:, None] + offset, 12)
                for n, name in enumerate(names):
                    one = scores[:, n]
                    held = best.get(name)
                    bound = max(floor, held[0][-1]) if held is not None and len(held[0]) == k else floor
                    if len(one) > k:
                        bound = max(bound, np.partition(one, len(one) - k)[len(one) - k])
                    chosen = one >= bound
                    if not chosen.any():
                        continue
                    s, d = one[chosen], ids[chosen]
                    if held is not None:
                        s, d = np.concatenate([held[0], s]), np.concatenate([held[1], d])
                    order = sorted(range(len(s)), key=lambda i: (-s[i], d[i]))[:k]
                    best[name] = (s[order], d[order])
                if len(best) > held_queries:
                    yield from emit()
        yield from emit()

    index_id_type, held_queries = index.id_type, HELD_QUERIES
    return top_per_key(meeting.mapInArrow(score, hit_schema), ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], k)

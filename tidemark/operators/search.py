"""Vector and text retrieval for batches of queries.

Exact search scores every row for every query, so no pairs are shuffled: each task scores its
rows against a block of queries with one matrix product, keeps a running top ``k`` per query and
emits only that; the last step merges ``k`` rows per query and task. Queries travel to the tasks in
blocks of bounded size; more queries mean more blocks, none is left out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import tokens
from tidemark.operators.ranking import top_per_key
from tidemark.session import pin

QUERY_BLOCK = 512


def _blocks(queries: DataFrame, query_id: str, size: int = QUERY_BLOCK) -> Iterator[list]:
    """The queries in blocks of about ``size`` rows: one if they fit, else hash blocks of all of them."""
    few = queries.limit(size + 1).collect()
    if len(few) <= size:
        yield sorted(few, key=lambda row: row[query_id])
        return
    blocks = -(-queries.count() // size)
    for block in range(blocks):
        chosen = F.pmod(F.xxhash64(query_id), F.lit(blocks)) == block
        yield queries.filter(chosen).orderBy(query_id).collect()


def _kind(queries: DataFrame) -> str:
    return queries.schema["query_id"].dataType.simpleString()


def _merge_top(parts: list[DataFrame], k: int) -> DataFrame:
    hits = reduce(DataFrame.unionByName, parts)
    return top_per_key(hits, ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], k)


def centroids(vectors: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per label, by partial aggregation."""
    dense = vectors.select(label, array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    return dense.groupBy(label).agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("vector"))


def lsh_signature(vectors: DataFrame, vector: str, tables: int = 8, bits: int = 8, seed: int = 7) -> DataFrame:
    """Adds ``buckets``: per hash table the sign pattern of ``bits`` random projections.

    A narrow step; store the result once and search it many times.
    """
    schema = T.StructType([*vectors.schema.fields, T.StructField("buckets", T.ArrayType(T.LongType()))])

    def sign(batches):
        import numpy as np
        import pyarrow as pa

        planes = None
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(vector))
            known = column.is_valid().to_numpy(zero_copy_only=False)
            out = [None] * len(known)
            flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype="float64")
            if known.any():
                rows = flat.reshape(int(known.sum()), -1)
                if planes is None:
                    planes = np.random.default_rng(seed).standard_normal((rows.shape[1], tables * bits))
                positive = (rows @ planes > 0).reshape(len(rows), tables, bits)
                codes = positive @ (1 << np.arange(bits, dtype="int64"))
                for place, code in zip(np.flatnonzero(known), codes):
                    out[place] = code.tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "buckets"])

    return vectors.mapInArrow(sign, schema)


def _keeper(ids: list, k: int, query_type: str, doc_type: str):
    """Two functions for the tasks: merge scored rows into the running top lists, and emit those.

    They hold all they need, so they travel with the job and the package need not be on the executors.
    """

    def keep(best, scores, names, floor):
        import numpy as np

        lowest = np.array([s[-1] if len(s) == k else -np.inf for s, _ in best])
        highest = scores.max(axis=0) if len(scores) else np.full(len(ids), -np.inf)
        for q in np.flatnonzero((highest >= np.maximum(lowest, floor)) & (highest > -np.inf)):
            one = scores[:, q]
            bound = max(floor, lowest[q])
            if len(one) > k:
                bound = max(bound, np.partition(one, len(one) - k)[len(one) - k])
            chosen = (one >= bound) & (one > -np.inf)
            s = np.concatenate([best[q][0], one[chosen]])
            d = np.concatenate([best[q][1], names[chosen]])
            order = sorted(range(len(s)), key=lambda i: (-s[i], d[i]))[:k]
            best[q] = (s[order], d[order])

    def emit(best):
        import pyarrow as pa

        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        found = [(ids[q], d, float(s)) for q in range(len(ids)) for s, d in zip(*best[q])]
        columns = list(zip(*found)) or [(), (), ()]
        kind = (kinds[query_type], kinds[doc_type], pa.float64())
        arrays = [pa.array(list(c), t) for c, t in zip(columns, kind)]
        return pa.RecordBatch.from_arrays(arrays, names=["query_id", "doc_id", "score"])

    return keep, emit


def _id_types(block: list, df: DataFrame, doc_id: str, query_type: str) -> tuple[list, str]:
    doc_type = df.schema[doc_id].dataType.simpleString()
    for kind in (query_type, doc_type):
        if kind not in ("bigint", "int", "string"):
            raise ValueError(f"ids are bigint, int or string, not {kind}")
    return [row["query_id"] for row in block], doc_type


def _vector_hits(vectors, block, doc_id, vector, k, threshold, offset, buckets, query_type):
    """Running top ``k`` per query over each task's rows; optionally only rows sharing a bucket."""
    ids, doc_type = _id_types(block, vectors, doc_id, query_type)
    targets = [row["vector"] for row in block]
    wanted = [row["buckets"] for row in block] if buckets else None
    keep, emit = _keeper(ids, k, query_type, doc_type)

    def search(batches):
        import numpy as np

        queries = np.asarray(targets, dtype="float64")
        queries = queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300)
        codes = np.asarray(wanted) if wanted is not None else None
        floor = -np.inf if threshold is None else threshold
        best = [(np.empty(0), np.empty(0, dtype=object)) for _ in ids]
        for batch in batches:
            column = batch.column(0)
            known = column.is_valid().to_numpy(zero_copy_only=False)
            if not known.any():
                continue
            rows = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype="float64")
            rows = rows.reshape(int(known.sum()), -1)
            if rows.shape[1] != queries.shape[1]:
                raise ValueError(f"vectors of length {rows.shape[1]}, queries of {queries.shape[1]}")
            names = np.asarray(batch.column(1).to_pylist(), dtype=object)[known]
            norms = np.linalg.norm(rows, axis=1)
            usable = norms > 0
            if codes is not None:
                own = np.asarray(batch.column(2).filter(batch.column(0).is_valid()).to_pylist())
                near = np.zeros((len(own), len(ids)), dtype=bool)
                for table in range(own.shape[1]):
                    near |= own[:, table, None] == codes[None, :, table]
                usable &= near.any(axis=1)
            if not usable.any():
                continue
            # Rounded, so that equal vectors get equal scores wherever they are computed.
            scores = np.round(rows[usable] @ queries.T / norms[usable, None] + offset, 12)
            if codes is not None:
                scores = np.where(near[usable], scores, -np.inf)
            keep(best, scores, names[usable], floor)
        yield emit(best)

    columns = [F.col(vector).alias("v"), F.col(doc_id).alias("d"), *([F.col("buckets")] if buckets else [])]
    return vectors.select(*columns).mapInArrow(search, f"query_id {query_type}, doc_id {doc_type}, score double")


def cosine_top_k(vectors: DataFrame, queries: DataFrame, doc_id: str, vector: str, k: int = 3,
                 threshold: float | None = 1.7, offset: float = 1.0) -> DataFrame:
    """``query_id, doc_id, score, rank``: the ``k`` best rows by cosine + ``offset`` at or over a threshold.

    ``queries`` has ``query_id`` and ``vector``. Null and zero vectors are never hits.
    """
    parts = [_vector_hits(vectors, block, doc_id, vector, k, threshold, offset, False, _kind(queries))
             for block in _blocks(queries, "query_id") if block]
    return _merge_top(parts or [_no_hits(vectors, queries, doc_id)], k)


def within_dates(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows between two bounds, filtered before scoring; no filter unless both are given."""
    if start is None or end is None:
        return df
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def approx_knn(signed: DataFrame, queries: DataFrame, doc_id: str, vector: str, k: int = 10,
               tables: int = 8, bits: int = 8, seed: int = 7) -> DataFrame:
    """Approximate nearest rows: those sharing a bucket with the query, all of them re-ranked exactly.

    ``signed`` comes from :func:`lsh_signature` with the same settings. More tables or fewer bits
    raise recall and cost.
    """
    keyed = lsh_signature(queries.withColumn("vector", F.col("vector").cast("array<float>")), "vector", tables, bits, seed)
    parts = [_vector_hits(signed, block, doc_id, vector, k, None, 1.0, True, _kind(queries))
             for block in _blocks(keyed, "query_id") if block]
    return _merge_top(parts or [_no_hits(signed, queries, doc_id)], k)


def text_match(documents: DataFrame, queries: DataFrame, doc_id: str, fields: Iterable[str], k: int = 10,
               k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``query_id, doc_id, score, rank`` by BM25 over whole texts; of several fields the best counts.

    ``queries`` has ``query_id`` and ``text``; each distinct query token counts once. Document
    frequencies come from one aggregation over distinct tokens; scoring is narrow, as above.
    """
    fields = list(fields)
    lists = documents.select(doc_id, *[tokens(f).alias(f"t{i}") for i, f in enumerate(fields)])
    asked = queries.select("query_id", F.explode(F.array_distinct(tokens("text"))).alias("term"))
    # One pass gives document frequencies and lengths: every text also counts under the empty term.
    marker = queries.sparkSession.createDataFrame([("",)], "term string")
    vocabulary = pin(asked.select("term").unionByName(marker).distinct())
    per_field = lists.select(F.posexplode(F.array(*[f"t{i}" for i in range(len(fields))])).alias("field", "terms"))
    filled = per_field.filter(F.size("terms") > 0).withColumn("length", F.size("terms"))
    terms = F.explode(F.array_append(F.array_distinct("terms"), F.lit(""))).alias("term")
    seen = filled.select("field", "length", terms).join(vocabulary, "term", "left_semi")
    frequency = pin(seen.groupBy("term").agg(
        *[F.count_if(F.col("field") == i).alias(f"f{i}") for i in range(len(fields))],
        *[F.avg(F.when(F.col("field") == i, F.col("length"))).alias(f"l{i}") for i in range(len(fields))]))
    stats = frequency.filter(F.col("term") == "").first()
    if stats is None:
        return _merge_top([_no_hits(documents, queries, doc_id)], k)
    weights = F.collect_list(F.struct("term", *[f"f{i}" for i in range(len(fields))])).alias("terms")
    weighted = asked.join(frequency, "term").groupBy("query_id").agg(weights)
    shape = [(stats[f"f{i}"], stats[f"l{i}"]) for i in range(len(fields))]
    parts = [_text_hits(lists, block, doc_id, shape, k, k1, b, _kind(queries))
             for block in _blocks(weighted, "query_id") if block]
    return _merge_top(parts or [_no_hits(documents, queries, doc_id)], k)


def _no_hits(documents: DataFrame, queries: DataFrame, doc_id: str) -> DataFrame:
    fields = [T.StructField("query_id", queries.schema["query_id"].dataType),
              T.StructField("doc_id", documents.schema[doc_id].dataType), T.StructField("score", T.DoubleType())]
    return documents.sparkSession.createDataFrame([], T.StructType(fields))


def _text_hits(lists, block, doc_id, shape, k, k1, b, query_type):
    ids, doc_type = _id_types(block, lists, doc_id, query_type)
    terms = sorted({term["term"] for row in block for term in row["terms"]})
    place = {term: i for i, term in enumerate(terms)}
    pairs = sorted((place[term["term"]], q) for q, row in enumerate(block) for term in row["terms"])
    counts = {place[term["term"]]: [term[f"f{i}"] for i in range(len(shape))] for row in block for term in row["terms"]}
    keep, emit = _keeper(ids, k, query_type, doc_type)

    def search(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known, width = pa.array(terms, pa.string()), len(ids)
        # Queries of each term, as one flat list with a start and a length per term.
        askers = np.array([q for _, q in pairs], dtype="int64")
        degree = np.bincount([term for term, _ in pairs], minlength=len(terms))
        first = np.cumsum(degree) - degree
        df = np.array([counts[i] for i in range(len(terms))], dtype="float64")
        idf = [np.log(1.0 + (n - df[:, f] + 0.5) / (df[:, f] + 0.5)) for f, (n, _) in enumerate(shape)]
        best = [(np.empty(0), np.empty(0, dtype=object)) for _ in ids]
        for large in batches:
            for start in range(0, large.num_rows, 512):
                batch = large.slice(start, 512)
                rows, names = batch.num_rows, np.asarray(batch.column(0).to_pylist(), dtype=object)
                scores = np.zeros((rows, width))
                for f, (_, mean) in enumerate(shape):
                    column = batch.column(f + 1)
                    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                    code = pc.fill_null(pc.index_in(column.flatten(), known), -1).to_numpy(zero_copy_only=False)
                    row = np.repeat(np.arange(rows), size)[code >= 0]
                    cell, tf = np.unique(row * len(terms) + code[code >= 0], return_counts=True)
                    row, term = cell // len(terms), cell % len(terms)
                    norm = k1 * (1.0 - b + b * size / (mean or 1.0))
                    weight = idf[f][term] * tf * (k1 + 1.0) / (tf + norm[row])
                    repeat = degree[term]
                    step = np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
                    query = askers[np.repeat(first[term], repeat) + step]
                    total = np.bincount(np.repeat(row, repeat) * width + query, np.repeat(weight, repeat), rows * width)
                    scores = np.maximum(scores, total.reshape(rows, width))
                scores = np.round(scores, 9)
                keep(best, np.where(scores > 0, scores, -np.inf), names, -np.inf)
        yield emit(best)

    return lists.mapInArrow(search, f"query_id {query_type}, doc_id {doc_type}, score double")


def normalised(hits: DataFrame, out: str) -> DataFrame:
    """Scores min-max scaled per query; equal scores all become 1.

    Hits are top lists, so a query has a bounded number of them and the window stays small.
    """
    per_query = Window.partitionBy("query_id")
    low, high = F.min("score").over(per_query), F.max("score").over(per_query)
    scaled = F.coalesce((F.col("score") - low) / F.nullif(high - low, F.lit(0.0)), F.lit(1.0))
    return hits.select("query_id", "doc_id", scaled.alias(out))


def hybrid(lexical: DataFrame, semantic: DataFrame, lexical_weight: float = 0.3, semantic_weight: float = 0.7, k: int = 10) -> DataFrame:
    """Weighted mean of the two normalised hit lists, a missing side counting 0; the ``k`` best per query."""
    both = normalised(lexical, "lexical").join(normalised(semantic, "semantic"), ["query_id", "doc_id"], "full")
    left, right = F.coalesce("lexical", F.lit(0.0)), F.coalesce("semantic", F.lit(0.0))
    score = (left * lexical_weight + right * semantic_weight) / (lexical_weight + semantic_weight)
    scored = both.select("query_id", "doc_id", F.round(score, 8).alias("score"))
    return top_per_key(scored, ["query_id"], [F.col("score").desc(), F.col("doc_id").asc()], k)


def context(hits: DataFrame, documents: DataFrame, doc_id: str, text: str, threshold: float = 1.71,
            min_length: int = 30, count: int = 5) -> DataFrame:
    """Texts of the first ``count`` good hits per query in rank order, joined by newlines, and the best score.

    A hit is good with a score at or over the threshold and a text longer than ``min_length``.
    """
    good = hits.filter(F.col("score") >= threshold).select("query_id", F.col("doc_id").alias("__d"), "score")
    texts = documents.select(F.col(doc_id).alias("__d"), F.col(text).alias("__t")).filter(F.length("__t") > min_length)
    joined = good.join(texts, "__d")
    best = top_per_key(joined, ["query_id"], [F.col("score").desc(), F.col("__d").asc()], count)
    lines = F.sort_array(F.collect_list(F.struct("rank", "__t")))
    return best.groupBy("query_id").agg(
        F.array_join(F.transform(lines, lambda r: r["__t"]), "\n").alias("context"),
        F.max("score").alias("best_score"), F.count(F.lit(1)).alias("texts"))


def embedding_model(documents: DataFrame, text: str, dims: int = 512):
    """TF-IDF weights over hashed tokens, fitted on all documents."""
    from pyspark.ml.feature import IDF, HashingTF

    hashing = HashingTF(numFeatures=dims, inputCol="tokens", outputCol="tf")
    counted = hashing.transform(documents.select(tokens(text).alias("tokens")).filter(F.size("tokens") > 0))
    return hashing, IDF(inputCol="tf", outputCol="weights").fit(counted)


def embed(df: DataFrame, text: str, model) -> DataFrame:
    """Adds ``vector``, of length 1; a text without tokens gives null."""
    from pyspark.ml.feature import Normalizer

    hashing, idf = model
    listed = df.withColumn("tokens", F.coalesce(tokens(text), F.array().cast("array<string>")))
    weighted = Normalizer(inputCol="weights", outputCol="unit").transform(idf.transform(hashing.transform(listed)))
    vector = F.when(F.size("tokens") > 0, vector_to_array("unit"))
    return weighted.withColumn("vector", vector).drop("tokens", "tf", "weights", "unit")


def embed_missing(documents: DataFrame, stored: DataFrame, key: str, text: str, dims: int = 512) -> DataFrame:
    """Vectors for the documents that have none stored."""
    known = stored.filter(F.col("vector").isNotNull()).select(key).distinct()
    missing = documents.join(known, key, "left_anti")
    return embed(missing, text, embedding_model(documents, text, dims))

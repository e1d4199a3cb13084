"""A stored inverted index for full-text search by BM25, with posting blocks that a search can skip.

Documents are dealt to shards of bounded size, and a shard's postings are made in one place: per term in blocks of at most 128, ordered
by weight. Each block keeps what bounds the weights in it, the largest frequency and the least length a frequency. Blocks are partitioned on
disk by a hash of the term and sorted by it, so a search opens the folders of its terms and reads the row groups that have them.

A search of any number of queries is one pass in three steps. The first block of every asked term gives scores that documents surely reach;
the k-th best of a query is its threshold. A block is left out for a query if its bound, with the largest bounds of the query's
other terms in that shard, stays under the threshold: no document of the answer has a posting there. What remains is scored shard by shard.

Every build or append adds a segment; statistics are summed over segments when searching, so scores are those of all documents.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.operators.ranking import top_per_key
from tidemark.session import pin

#: Postings in a block, bytes of text in a shard (about), folders that terms are hashed to, and terms that are pushed to the scan as a list.
BLOCK, SHARD_BYTES, BUCKETS, LISTED_TERMS = 128, 8 << 20, 64, 2_000
#: Scores are compared after rounding to nine places, so bounds count as reached a little earlier.
SLACK = 1e-8
#: A block's columns save its documents. The empty term has a row for each shard and field: its documents ``n`` and its ``tokens``.
BLOCK_COLUMNS = "shard int, field int, term string, block int, n int, max_tf int, min_ratio double, tokens long, tfs array<int>, lengths array<int>"


@dataclass
class TextIndex:
    """An index under ``folder`` over ``fields`` of documents whose ids are of ``id_type``."""

    spark: SparkSession
    folder: str
    id_type: str
    fields: int

    def blocks(self) -> DataFrame:
        columns = f"{BLOCK_COLUMNS}, docs array<{self.id_type}>, key long, segment int, bucket int"
        return self.spark.read.schema(columns).parquet(f"{self.folder}/blocks")

    def statistics(self) -> DataFrame:
        empty = self.spark.range(1).select(_bucket(F.xxhash64(F.lit("")))).first()[0]
        return self.blocks().where((F.col("bucket") == empty) & (F.col("term") == "")).select("segment", "field", F.col("n").alias("documents"), "tokens")


def _bucket(key: Column) -> Column:
    """The folder of a term's hash: its upper bits, so that order by hash is order by folder too."""
    return F.shiftright(key, 65 - BUCKETS.bit_length()).cast("int")


def _shard_blocks(fields: int, id_type: str, k1: float, b: float):
    """A function for the groups: the blocks of a shard, from its documents' ids and tokens."""

    def make(key, table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        out, ids = [], table.column("id").combine_chunks()
        for field in range(fields):
            column = table.column(f"t{field}").combine_chunks()
            size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype("int64")
            coded = column.flatten().dictionary_encode()
            rows = max(len(size), 1)
            # A cell is a term with a document; equal tokens of a document are one cell.
            cell, tf = np.unique(coded.indices.to_numpy().astype("int64") * rows + np.repeat(np.arange(len(size)), size), return_counts=True)
            term, doc = cell // rows, cell % rows
            length = size[doc]
            ratio = length / tf
            slow = k1 * (1 - b) / tf + k1 * b * ratio / max(size[size > 0].mean() if size.any() else 1.0, 1.0)
            order = np.lexsort((slow, term))
            term, doc, tf, length, ratio = term[order], doc[order], tf[order], length[order], ratio[order]
            first = np.flatnonzero(np.diff(term, prepend=-1))
            place = np.arange(len(term)) - np.repeat(first, np.diff(first, append=len(term)))
            cut = np.flatnonzero(place % BLOCK_SIZE == 0)
            offsets = pa.array(np.append(cut, len(term)).astype("int32"))
            n = np.diff(cut, append=len(term))
            has = len(cut) > 0
            columns = {
                "term": coded.dictionary.take(pa.array(term[cut])).cast(pa.string()), "block": (place[cut] // BLOCK_SIZE).astype("int32"),
                "n": n.astype("int32"), "max_tf": (np.maximum.reduceat(tf, cut) if has else tf).astype("int32"),
                "min_ratio": np.minimum.reduceat(ratio, cut) if has else ratio.astype("float64"), "tokens": pa.nulls(len(cut), pa.int64()),
                "tfs": pa.ListArray.from_arrays(offsets, pa.array(tf.astype("int32"))), "lengths": pa.ListArray.from_arrays(offsets, pa.array(length.astype("int32"))),
                "docs": pa.ListArray.from_arrays(offsets, ids.take(pa.array(doc)))}
            none = pa.array([[]], pa.list_(pa.int32()))
            own = {"term": [""], "block": [0], "n": [int((size > 0).sum())], "max_tf": [0], "min_ratio": [0.0], "tokens": [int(size.sum())],
                   "tfs": none, "lengths": none, "docs": pa.array([[]], pa.list_(ids.type))}
            for part, count in ((columns, len(cut)), (own, int(size.any()))):
                one = pa.table({"shard": pa.array(np.full(count, key[0].as_py(), "int32")), "field": pa.array(np.full(count, field, "int32")),
                                **{c: (pa.array(v) if isinstance(v, (np.ndarray, list)) else v).slice(0, count) for c, v in part.items()}})
                out.append(one.cast(schema))
        return pa.concat_tables(out)

    import pyarrow as pa

    BLOCK_SIZE = BLOCK
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    schema = pa.schema([("shard", pa.int32()), ("field", pa.int32()), ("term", pa.string()), ("block", pa.int32()), ("n", pa.int32()), ("max_tf", pa.int32()),
                        ("min_ratio", pa.float64()), ("tokens", pa.int64()), ("tfs", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())),
                        ("docs", pa.list_(kinds[id_type]))])
    return make


def _add_segment(folder: str, segment: int, documents: DataFrame, doc_id: str, fields: list[str], k1: float, b: float) -> None:
    id_type = documents.schema[doc_id].dataType.simpleString()
    texts = documents.select(F.col(doc_id).alias("id"), *[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)]).where(F.col("id").isNotNull())
    size = sum((F.coalesce(F.octet_length(f"f{i}"), F.lit(0)) for i in range(len(fields))), F.lit(0))
    shards = max(1, -(-(texts.agg(F.sum(size.cast("long"))).first()[0] or 0) // SHARD_BYTES))
    # Texts are shuffled as they are and cut into tokens behind the shuffle.
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).repartition("shard")
    lists = dealt.select("shard", "id", *[tokens(f"f{i}").alias(f"t{i}") for i in range(len(fields))])
    made = lists.groupBy("shard").applyInArrow(_shard_blocks(len(fields), id_type, k1, b), f"{BLOCK_COLUMNS}, docs array<{id_type}>")
    keyed = made.withColumn("key", F.xxhash64("term")).withColumn("bucket", _bucket(F.col("key"))).withColumn("segment", F.lit(segment))
    # A folder is written by as many tasks as there are partitions for it, dealt by shard.
    spread = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")) // BUCKETS)
    placed = keyed.repartition("bucket", F.pmod("shard", F.lit(spread))).sortWithinPartitions("bucket", "key", "shard", "field", "block")
    placed.write.mode("append").option("compression", "zstd").partitionBy("segment", "bucket").parquet(f"{folder}/blocks")


def build(documents: DataFrame, doc_id: str, fields: Iterable[str], folder: str, k1: float = 1.2, b: float = 0.75) -> TextIndex:
    """Index whole texts of ``fields`` under ``folder``. ``doc_id`` is unique; rows where it is null are left out."""
    fields, id_type = list(fields), documents.schema[doc_id].dataType.simpleString()
    if id_type not in ("bigint", "int", "string"):
        raise ValueError(f"ids are bigint, int or string, not {id_type}")
    _add_segment(folder, 0, documents, doc_id, fields, k1, b)
    return TextIndex(documents.sparkSession, folder, id_type, len(fields))


def append(index: TextIndex, documents: DataFrame, doc_id: str, fields: Iterable[str], k1: float = 1.2, b: float = 0.75) -> None:
    """Add documents as a segment of their own; stored segments are not read."""
    last = index.statistics().agg(F.max("segment")).first()[0]
    _add_segment(index.folder, 0 if last is None else last + 1, documents, doc_id, list(fields), k1, b)


def term_blocks(index: TextIndex, terms: DataFrame) -> DataFrame:
    """The blocks of the terms in column ``term`` (pinned, distinct): a partition filter on their buckets, and on their hashes
    while they are few enough to list; the join decides."""
    key = F.xxhash64("term")
    buckets = [row[0] for row in terms.select(_bucket(key)).distinct().collect()]
    blocks = index.blocks().where(F.col("bucket").isin(buckets))
    few = [row[0] for row in terms.select(key).limit(LISTED_TERMS + 1).collect()]
    if len(few) <= LISTED_TERMS:
        blocks = blocks.where(F.col("key").isin(few))
    return blocks.join(terms.select("term"), "term", "left_semi")


def _weight(tf: Column, ratio: Column, mean: Column, k1: float, b: float) -> Column:
    """A posting's weight without the term's rarity, from its frequency and its document's length a frequency."""
    return (k1 + 1.0) / (1.0 + k1 * (1 - b) / tf + k1 * b * ratio / mean)


def search(index: TextIndex, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``query_id, doc_id, score, rank`` by BM25, as :func:`tidemark.operators.search.text_match` gives them: of several fields the best
    counts, each distinct query token once, ties are ordered by id.

    Queries stay a table; the driver sees statistics of the fields, bucket numbers, and terms while they are few.
    """
    query_type = queries.schema["query_id"].dataType.simpleString()
    hit_schema = f"query_id {query_type}, doc_id {index.id_type}, score double"
    sizes = {r["field"]: (r["n"], r["t"]) for r in index.statistics().groupBy("field").agg(F.sum("documents").alias("n"), F.sum("tokens").alias("t")).collect()}
    best_first = [F.col("score").desc(), F.col("doc_id").asc()]
    if not sizes:
        return top_per_key(queries.sparkSession.createDataFrame([], hit_schema), ["query_id"], best_first, k)
    by_field = lambda at: F.element_at(F.create_map(*[F.lit(x) for f, s in sizes.items() for x in (f, s[at])]), F.col("field"))
    mean = by_field(1) / by_field(0)
    asked = pin(queries.select("query_id", F.explode(F.array_distinct(tokens("text"))).alias("term")))
    terms = pin(asked.select("term").distinct())
    blocks = term_blocks(index, terms)

    # What is known of the blocks without their postings.
    known = pin(blocks.select("segment", "shard", "field", "term", "block", "n", "max_tf", "min_ratio"))
    frequency = known.groupBy("field", "term").agg(F.sum("n").alias("df"))
    rarity = pin(frequency.select("field", "term", F.log(1.0 + (by_field(0) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")))
    bound = (F.col("idf") * _weight(F.col("max_tf"), F.col("min_ratio"), mean, k1, b)).alias("bound")
    bounded = pin(known.join(rarity, ["field", "term"]).select("segment", "shard", "field", "term", "block", "idf", bound))

    # Scores that documents reach with the first blocks alone.
    first = top_per_key(bounded, ["field", "term"], [F.col("bound").desc(), F.col("segment"), F.col("shard"), F.col("block")], -(-k // BLOCK) + 1)
    first = pin(first.select("segment", "shard", "field", "term", "block", "idf"))
    lists = blocks.join(first, ["segment", "shard", "field", "term", "block"]).select("field", "term", "idf", F.explode(F.arrays_zip("docs", "tfs", "lengths")).alias("p"))
    weight = F.col("idf") * _weight(F.col("p.tfs"), F.col("p.lengths") / F.col("p.tfs"), mean, k1, b)
    sure = asked.join(pin(lists.select("field", "term", F.col("p.docs").alias("doc_id"), weight.alias("weight"))), "term")
    sure = sure.groupBy("query_id", "field", "doc_id").agg(F.sum("weight").alias("score"))
    sure = sure.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    kth = top_per_key(sure, ["query_id"], best_first, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("threshold"))
    threshold = asked.select("query_id").distinct().join(pin(kth), "query_id", "left").select(
        "query_id", F.coalesce(F.col("threshold") - SLACK, F.lit(0.0)).alias("threshold"))

    # A shard's terms with the queries that need them, and the least bound a block must have for each.
    most = bounded.groupBy("segment", "shard", "field", "term").agg(F.max("bound").alias("most"), F.first("idf").alias("idf"))
    reach = asked.join(most, "term").groupBy("query_id", "segment", "shard", "field").agg(
        F.sum("most").alias("total"), F.collect_list(F.struct("term", "most", "idf")).alias("terms"))
    wanted = reach.join(pin(threshold), "query_id").where("total >= threshold").select(
        "query_id", "segment", "shard", "field", "total", "threshold", F.inline("terms"))
    wanted = wanted.withColumn("least", F.col("threshold") - (F.col("total") - F.col("most")))
    per_term = pin(wanted.groupBy("segment", "shard", "field", "term", "idf").agg(
        F.collect_list(F.struct("query_id", "least")).alias("asked"), F.min("least").alias("any")))
    needed = blocks.join(per_term, ["segment", "shard", "field", "term"]).withColumn("bound", bound).where("bound >= any")
    score = _scorer(k, k1, b, query_type, index.id_type, {f: t / n for f, (n, t) in sizes.items()})
    rows = needed.select("segment", "shard", "field", "idf", "bound", "docs", "tfs", "lengths", "asked")
    return top_per_key(rows.groupBy("segment", "shard").applyInArrow(score, hit_schema), ["query_id"], best_first, k)


def _scorer(k, k1, b, query_type, id_type, means):
    """A function for the groups: the best documents of a shard for each query that needs its blocks."""

    def score(table):
        import numpy as np
        import pyarrow as pa

        kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
        columns = {c: table.column(c).combine_chunks() for c in ("field", "idf", "bound", "docs", "tfs", "lengths", "asked")}
        field, idf, bound = (columns[c].to_numpy() for c in ("field", "idf", "bound"))
        size = columns["docs"].value_lengths().to_numpy()
        end = np.cumsum(size)
        coded = columns["docs"].flatten().dictionary_encode()
        doc, names = coded.indices.to_numpy(), np.array(coded.dictionary.to_pylist(), dtype=object)
        tf, length = columns["tfs"].flatten().to_numpy(), columns["lengths"].flatten().to_numpy()
        mean = np.array([means[f] for f in field.tolist()])
        weight = np.repeat(idf, size) * (tf * (k1 + 1.0) / (tf + k1 * (1.0 - b + b * length / np.repeat(mean, size))))
        asked = columns["asked"].flatten()
        block = np.repeat(np.arange(len(size)), columns["asked"].value_lengths().to_numpy())
        query = asked.field("query_id").dictionary_encode()
        need = bound[block] >= asked.field("least").to_numpy()
        order = np.argsort(query.indices.to_numpy()[need], kind="stable")
        who, block = query.indices.to_numpy()[need][order], block[need][order]
        edges = np.flatnonzero(np.diff(who, prepend=-1, append=-1 if len(who) else 0)) if len(who) else np.zeros(1, int)
        ids, out = query.dictionary.to_pylist(), []
        for low, high in zip(edges, edges[1:]):
            best = np.zeros(0)
            found = np.zeros(0, "int64")
            mine = block[low:high]
            for f in np.unique(field[mine]):
                of = mine[field[mine] == f]
                at = np.concatenate([np.arange(end[i] - size[i], end[i]) for i in of.tolist()])
                one, place = np.unique(doc[at], return_inverse=True)
                found = np.concatenate([found, one])
                best = np.concatenate([best, np.bincount(place, weight[at])])
            best = np.round(best, 9)
            bar = np.partition(best, len(best) - k)[len(best) - k] if len(means) == 1 and len(best) > k else 0.0
            top: dict = {}
            for i in np.flatnonzero((best >= bar) & (best > 0)).tolist():
                top[found[i]] = max(top.get(found[i], 0.0), best[i])
            chosen = sorted(((-s, names[d]) for d, s in top.items()))[:k]
            out += [(ids[who[low]], d, -s) for s, d in chosen]
        rows = list(zip(*out)) or [(), (), ()]
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(rows, (kinds[query_type], kinds[id_type], pa.float64()))],
                                    names=["query_id", "doc_id", "score"])

    return score

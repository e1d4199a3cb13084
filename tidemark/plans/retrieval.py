"""Vector, text and hybrid search."""

from pyspark.sql import functions as F

from tidemark.operators import embeddings, search, text_index, vector_index
from tidemark.plans import query
from tidemark.session import run_folder

CENTROIDS = """
x AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS v FROM x GROUP BY ALL),
q AS (SELECT label AS query_id, list(v ORDER BY i) AS vec FROM c GROUP BY label),
s AS (SELECT query_id, vec_id, label, round(list_cosine_similarity(vec, embedding::DOUBLE[]) + 1, 9) AS score FROM q, embeddings)"""


def _queries(t):
    """One query per label: the mean of its vectors."""
    return search.centroids(t.embeddings, "label", "embedding").select(F.col("label").cast("bigint").alias("query_id"), "vector")


def _hits(vectors, t, k, threshold):
    return search.cosine_top_k(vectors, _queries(t), "vec_id", "embedding", k, threshold)


def _shown(hits):
    return hits.select("query_id", F.col("doc_id").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


@query("cosine_top_k", oracle=f"""
WITH {CENTROIDS} SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
FROM s WHERE score >= 1.3 QUALIFY rank <= 3""")
def cosine_top_k(t):
    return _shown(_hits(t.embeddings, t, 3, 1.3))


@query("cosine_top_10", oracle=f"""
WITH {CENTROIDS} SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
FROM s QUALIFY rank <= 10""")
def cosine_top_10(t):
    return _shown(_hits(t.embeddings, t, 10, None))


@query("cosine_filtered", oracle=f"""
WITH {CENTROIDS} SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
FROM s WHERE label BETWEEN 2 AND 5 QUALIFY rank <= 3""")
def cosine_filtered(t):
    return _shown(_hits(search.within_dates(t.embeddings, "label", 2, 5), t, 3, None))


@query("approx_knn")
def approx_knn(t):
    signed = search.lsh_signature(t.embeddings, "embedding")
    return _shown(search.approx_knn(signed, _queries(t), "vec_id", "embedding", 10))


def _stored(t):
    """Two thirds of the vectors indexed, the rest appended."""
    first = F.col("vec_id") % 3 > 0
    index = vector_index.build(t.embeddings.where(first), "vec_id", "embedding", run_folder(t.spark, "vector-index"))
    vector_index.append(index, t.embeddings.where(~first), "vec_id", "embedding")
    return vector_index.load(t.spark, index.folder)


@query("vector_index_search")
def vector_index_search(t):
    return _shown(vector_index.top_k(_stored(t), _queries(t), 10))


@query("vector_index_recall", oracle=f"""
WITH {CENTROIDS}, top AS (SELECT query_id, vec_id, score FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10)
SELECT count(DISTINCT query_id) AS queries, count(*) AS neighbours, TRUE AS reached, 0 AS unlike_scores FROM top""")
def vector_index_recall(t):
    """Hits of the stored index held against exact search: nine tenths are found, with the scores of exact search."""
    exact = _hits(t.embeddings, t, 10, None).select("query_id", "doc_id", "score")
    found = vector_index.top_k(_stored(t), _queries(t), 10).select("query_id", "doc_id", F.col("score").alias("found"))
    both = exact.join(found, ["query_id", "doc_id"], "left")
    return both.agg(F.count_distinct("query_id").alias("queries"), F.count(F.lit(1)).alias("neighbours"),
                    (F.count("found") >= 0.9 * F.count(F.lit(1))).alias("reached"),
                    F.count_if(F.abs(F.col("found") - F.col("score")) > 1e-9).alias("unlike_scores"))


TEXT_MATCH = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 1) AS toks FROM documents),
q AS (SELECT DISTINCT item_id AS query_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 1)) AS term FROM benchmark),
st AS (SELECT count(*) AS n, avg(len(toks)) AS mean FROM d WHERE len(toks) > 0),
e AS (SELECT doc_id, len(toks) AS len, unnest(toks) AS term FROM d),
tf AS (SELECT doc_id, len, term, count(*) AS tf FROM e WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len / mean))), 9) AS score
      FROM q JOIN tf USING (term) JOIN df USING (term), st GROUP BY ALL)
SELECT query_id, doc_id, round(score, 5) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s QUALIFY rank <= 10"""


@query("text_match", oracle=TEXT_MATCH)
def text_match(t):
    questions = t.benchmark.select(F.col("item_id").alias("query_id"), "text")
    hits = search.text_match(t.wide("documents"), questions, "doc_id", ["text"], 10)
    return hits.withColumn("score", F.round("score", 5))


BM25_FIELD = """
t{f} AS (SELECT doc_id, list_filter(regexp_split_to_array(lower({f}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: length(w) > 1) AS toks FROM documents),
n{f} AS (SELECT count(*) AS n, avg(len(toks)) AS mean FROM t{f} WHERE len(toks) > 0),
e{f} AS (SELECT doc_id, len(toks) AS len, unnest(toks) AS term FROM t{f}),
c{f} AS (SELECT doc_id, len, term, count(*) AS tf FROM e{f} WHERE term IN (SELECT term FROM q) GROUP BY ALL),
d{f} AS (SELECT term, count(*) AS df FROM c{f} GROUP BY term),
s{f} AS (SELECT query_id, doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len / mean))) AS score
      FROM q JOIN c{f} USING (term) JOIN d{f} USING (term), n{f} GROUP BY ALL)"""


def _semantic(t):
    """The nearest documents of each benchmark item; both take their vectors from the embeddings by number."""
    vectors = t.embeddings
    asked = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")).join(
        t.benchmark.select(F.col("item_id").alias("query_id")), "query_id")
    stored = vectors.select(F.col("vec_id").alias("doc_id"), "embedding").join(t.documents.select("doc_id"), "doc_id", "left_semi")
    return search.cosine_top_k(stored, asked, "doc_id", "embedding", 30, None)


HYBRID = f"""
WITH q AS (SELECT DISTINCT item_id AS query_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: length(w) > 1)) AS term FROM benchmark),
{BM25_FIELD.format(f='text')}, {BM25_FIELD.format(f='source')},
lx AS (SELECT query_id, doc_id, round(max(score), 9) AS score FROM (SELECT * FROM stext UNION ALL SELECT * FROM ssource) GROUP BY query_id, doc_id
       QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(max(score), 9) DESC, doc_id) <= 30),
sx AS (SELECT item_id AS query_id, d.vec_id AS doc_id, round(list_cosine_similarity(a.embedding::DOUBLE[], d.embedding::DOUBLE[]) + 1, 12) AS score
       FROM benchmark JOIN embeddings a ON a.vec_id = item_id, embeddings d JOIN documents ON doc_id = d.vec_id
       QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, d.vec_id) <= 30),
ln AS (SELECT query_id, doc_id, coalesce((score - min(score) OVER p) / nullif(max(score) OVER p - min(score) OVER p, 0), 1) AS l FROM lx WINDOW p AS (PARTITION BY query_id)),
sn AS (SELECT query_id, doc_id, coalesce((score - min(score) OVER p) / nullif(max(score) OVER p - min(score) OVER p, 0), 1) AS s FROM sx WINDOW p AS (PARTITION BY query_id)),
f AS (SELECT query_id, doc_id, round(coalesce(l, 0) * 0.3 + coalesce(s, 0) * 0.7, 8) AS score FROM ln FULL JOIN sn USING (query_id, doc_id))
SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM f QUALIFY rank <= 10"""


@query("hybrid_search", oracle=HYBRID)
def hybrid_search(t):
    """Benchmark items as queries over documents."""
    items = t.benchmark.select(F.col("item_id").alias("query_id"), "text")
    lexical = search.text_match(t.wide("documents"), items, "doc_id", ["text", "source"], 30)
    return search.hybrid(lexical, _semantic(t)).withColumn("score", F.round("score", 6))


def _text_index(t, fields):
    """Two thirds of the documents indexed, the rest appended."""
    documents, first = t.wide("documents"), F.col("doc_id") % 3 > 0
    index = text_index.build(documents.where(first), "doc_id", fields, run_folder(t.spark, "text-index"))
    text_index.append(index, documents.where(~first), "doc_id", fields)
    return index


@query("text_index_search", oracle=TEXT_MATCH)
def text_index_search(t):
    """The same answer as text_match, from a stored index."""
    hits = text_index.search(_text_index(t, ["text"]), t.benchmark.select(F.col("item_id").alias("query_id"), "text"), 10)
    return hits.withColumn("score", F.round("score", 5))


@query("hybrid_index_search", oracle=HYBRID)
def hybrid_index_search(t):
    """The same answer as hybrid_search, its text side from a stored index."""
    lexical = text_index.search(_text_index(t, ["text", "source"]), t.benchmark.select(F.col("item_id").alias("query_id"), "text"), 30)
    return search.hybrid(lexical, _semantic(t)).withColumn("score", F.round("score", 6))


@query("embed_missing", oracle="""
SELECT doc_id, CASE WHEN len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 1)) > 0 THEN 256 END AS dims,
  CASE WHEN len(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 1)) > 0 THEN 1.0 END AS norm
FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""")
def embed_missing(t):
    stored = t.embeddings.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    made = search.embed_missing(t.wide("documents").select("doc_id", "text"), stored, "doc_id", "text", 256)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x * x))
    return made.select("doc_id", F.size("vector").alias("dims"), F.round(norm, 6).alias("norm"))


PLACES = """
w AS (SELECT doc_id, doc_id % 3 > 0 AS early, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 1)) AS token FROM documents),
c AS (SELECT doc_id, early, ('0x' || substr(md5(token), 1, 8))::BIGINT % 128 AS place, count(*) AS n FROM w GROUP BY ALL),
f AS (SELECT place, count(*) FILTER (early) AS d1, count(*) AS d2 FROM c GROUP BY place),
a AS (SELECT count(DISTINCT doc_id) FILTER (early) AS n1, count(DISTINCT doc_id) AS n2 FROM c),
x AS (SELECT doc_id, place, n * ln(CASE WHEN early THEN (n1 + 1) / (d1 + 1) ELSE (n2 + 1) / (d2 + 1) END) AS weight FROM c JOIN f USING (place), a)"""


@query("embed_new_rows", oracle=f"""
WITH {PLACES}, l AS (SELECT doc_id, sqrt(sum(weight * weight)) AS len FROM x GROUP BY doc_id)
SELECT doc_id, place, round(CASE WHEN len > 0 THEN weight / len ELSE 0 END, 8) AS entry FROM x JOIN l USING (doc_id) WHERE abs(round(CASE WHEN len > 0 THEN weight / len ELSE 0 END, 8)) > 0""")
def embed_new_rows(t):
    """Vector entries of all documents, two thirds embedded by a first run and the rest by a second one."""
    store = embeddings.EmbeddingStore(t.spark, run_folder(t.spark, "vectors"), "doc_id", 128)
    store.embed_missing(t.wide("documents").where("doc_id % 3 > 0"), "text")
    store.embed_missing(t.wide("documents"), "text")
    entries = store.vectors.read().select("doc_id", F.posexplode("vector").alias("place", "entry"))
    return entries.withColumn("entry", F.round("entry", 8)).where("abs(entry) > 0")


@query("context_assembly", oracle=f"""
WITH {CENTROIDS},
g AS (SELECT query_id, vec_id, score FROM s WHERE score >= 1.2 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10),
r AS (SELECT query_id, text, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k
      FROM g JOIN documents ON doc_id = vec_id WHERE length(text) > 30 QUALIFY k <= 5)
SELECT query_id, md5(string_agg(text, chr(10) ORDER BY k)) AS context, round(max(score), 6) AS best_score, count(*) AS texts FROM r GROUP BY query_id""")
def context_assembly(t):
    made = search.context(_hits(t.embeddings, t, 10, 1.2), t.documents, "doc_id", "text", threshold=1.2)
    return made.select("query_id", F.md5("context").alias("context"), F.round("best_score", 6).alias("best_score"), "texts")

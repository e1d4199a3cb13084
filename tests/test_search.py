"""Search operators against brute force on small fixtures."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import models, search


@pytest.fixture(scope="module")
def vectors(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.standard_normal(16).round(3).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one vector copied many times
    rows += [(5000, [0.0] * 16), (5001, None)]
    return rows, spark.createDataFrame(rows, "id bigint, v array<float>").repartition(7)


def brute(rows, query, k, threshold=None):
    scored = []
    for i, v in rows:
        if v is None or not any(v):
            continue
        a, b = np.asarray(v, dtype="float32").astype("float64"), np.asarray(query, dtype="float64")
        score = round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)) + 1.0, 9)
        if threshold is None or score >= threshold:
            scored.append((-score, i))
    return [i for _, i in sorted(scored)[:k]]


def test_exact_search(spark, vectors):
    rows, df = vectors
    asked = [(n, rows[n][1]) for n in (0, 5, 9)]
    queries = spark.createDataFrame(asked, "query_id bigint, vector array<double>")
    for k, threshold in ((3, None), (250, None), (10, 1.7)):
        hits = search.cosine_top_k(df, queries, "id", "v", k, threshold).collect()
        for n, query in asked:
            mine = sorted((r["rank"], r.doc_id) for r in hits if r.query_id == n)
            assert [i for _, i in mine] == brute(rows, query, k, threshold)


def test_more_queries_than_a_block(spark, vectors, monkeypatch):
    rows, df = vectors
    queries = spark.createDataFrame([(n, rows[n][1]) for n in range(30)], "query_id bigint, vector array<double>")
    whole = search.cosine_top_k(df, queries, "id", "v", 2, None).collect()
    monkeypatch.setattr(search._blocks, "__defaults__", (7,))
    assert sorted(search.cosine_top_k(df, queries, "id", "v", 2, None).collect()) == sorted(whole)
    assert len({r.query_id for r in whole}) == 30


def test_threshold_is_inclusive_and_lengths_must_agree(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "id string, v array<float>")
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<double>")
    assert [r.doc_id for r in search.cosine_top_k(df, queries, "id", "v", 3, 1.0).orderBy("rank").collect()] == ["a", "b"]
    with pytest.raises(Exception, match="length"):
        search.cosine_top_k(df, spark.createDataFrame([("q", [1.0])], "query_id string, vector array<double>"), "id", "v").collect()


def test_date_bounds_only_together(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-01",)], "d string")
    assert search.within_dates(df, "d", "2024-02-01", None).count() == 2
    assert search.within_dates(df, "d", "2024-02-01", "2024-04-01").count() == 1


def test_approximate_search_recall(spark, vectors):
    rows, df = vectors
    queries = spark.createDataFrame([(n, rows[n][1]) for n in range(1, 41)], "query_id bigint, vector array<double>")
    exact = {(r.query_id, r.doc_id) for r in search.cosine_top_k(df, queries, "id", "v", 5, None).collect()}
    signed = search.lsh_signature(df, "v", tables=12, bits=5)
    found = {(r.query_id, r.doc_id) for r in search.approx_knn(signed, queries, "id", "v", 5, tables=12, bits=5).collect()}
    assert len(exact & found) / len(exact) >= 0.8
    wide = search.lsh_signature(df, "v", tables=1, bits=0)
    everything = {(r.query_id, r.doc_id) for r in search.approx_knn(wide, queries, "id", "v", 5, tables=1, bits=0).collect()}
    assert everything == exact


def bm25(docs, terms):
    lists = {i: t.split() for i, t in docs}
    known = [t for t in lists.values() if t]
    mean, n = sum(map(len, known)) / len(known), len(known)
    out = {}
    for i, t in lists.items():
        score = 0.0
        for term in set(terms.split()):
            tf, df = t.count(term), sum(term in x for x in known)
            if tf:
                score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))
        if score:
            out[i] = score
    return out


def test_text_match(spark):
    draw = random.Random(4)
    words = [f"w{chr(97 + i)}" for i in range(20)]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(0, 30)))) for i in range(150)]
    docs += [(1000 + i, docs[0][1] or "wa wb") for i in range(75)]
    df = spark.createDataFrame(docs, "id bigint, text string").repartition(5)
    asked = [(1, "wa wb wb"), (2, "wc"), (3, "unknown tokens"), (4, "")]
    hits = search.text_match(df, spark.createDataFrame(asked, "query_id bigint, text string"), "id", ["text"], 20).collect()
    for n, terms in asked:
        expected = sorted((-round(s, 9), i) for i, s in bm25(docs, terms).items())[:20]
        assert [r.doc_id for r in sorted(hits, key=lambda r: r["rank"]) if r.query_id == n] == [i for _, i in expected]
    none = spark.createDataFrame([(1, "unknown")], "query_id bigint, text string")
    assert search.text_match(df, none, "id", ["text"], 5).count() == 0


def test_hybrid_sides(spark):
    kind = "query_id bigint, doc_id bigint, score double"
    lexical = spark.createDataFrame([(1, 10, 4.0), (1, 11, 2.0), (2, 10, 5.0)], kind)
    semantic = spark.createDataFrame([(1, 11, 1.9), (1, 12, 1.5)], kind)
    rows = {(r.query_id, r.doc_id): r.score for r in search.hybrid(lexical, semantic).collect()}
    assert rows == {(1, 10): 0.3, (1, 11): 0.7, (1, 12): 0.0, (2, 10): 0.3}


def test_context(spark):
    hits = spark.createDataFrame([(1, i, 1.9 - i / 100) for i in range(8)] + [(2, 0, 1.7)], "query_id bigint, doc_id bigint, score double")
    texts = spark.createDataFrame([(i, chr(97 + i) * (30 if i == 0 else 31)) for i in range(8)], "id bigint, t string")
    rows = search.context(hits, texts, "id", "t").collect()
    assert [(r.query_id, r.texts, r.best_score) for r in rows] == [(1, 5, 1.89)]
    assert rows[0].context == "\n".join(chr(97 + i) * 31 for i in range(1, 6))


def test_embedding_of_missing_rows(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, ""), (4, None), (5, "alpha beta")], "id bigint, t string")
    stored = spark.createDataFrame([(2, [1.0]), (1, None)], "id bigint, vector array<double>")
    rows = {r.id: r.vector for r in search.embed_missing(docs, stored, "id", "t", 64).collect()}
    assert set(rows) == {1, 3, 4, 5} and rows[3] is None and rows[4] is None
    assert rows[1] == rows[5] and sum(x * x for x in rows[1]) == pytest.approx(1.0)


def test_text_labels(spark):
    docs = [(i, ("good fine " if i % 2 else "bad awful ") * 3) for i in range(40)] + [(100, ""), (101, None), (102, "good fine")]
    known = [(i, i % 2) for i in range(40)]
    rows = {r.id: r for r in models.label_texts(
        spark.createDataFrame(docs, "id bigint, t string"), spark.createDataFrame(known, "id bigint, y int"), "id", "t", "y",
        {0: "negative", 1: "positive"}).collect()}
    assert (rows[100].label, rows[100].score) == (rows[101].label, rows[101].score) == ("neutral", 0.0)
    assert rows[102].label == "positive" and rows[102].score > 0.5 and rows[0].label == "negative"
    assert len(rows) == len(docs)


def test_topics(spark):
    docs = spark.createDataFrame([("cat dog cat pet " * 5,), ("tax law tax court " * 5,)] * 10, "t string")
    rows = models.topics(docs, "t", k=2, words=3).collect()
    assert len(rows) == 6 and {r.word for r in rows} <= {"cat", "dog", "pet", "tax", "law", "court"}
    best = {r.topic: r.word for r in rows if r["rank"] == 1}
    assert set(best.values()) == {"cat", "tax"}


def test_topics_keep_words_of_one_document(spark):
    docs = spark.createDataFrame([("cat dog " * 5 + "unicorn",), ("tax law " * 5 + "audit",)], "t string")
    rows = models.topics(docs, "t", k=2, words=6).collect()
    assert {r.word for r in rows} == {"cat", "dog", "unicorn", "tax", "law", "audit"}
    assert all(abs(sum(r.weight for r in rows if r.topic == topic) - 1) < 1e-9 for topic in (0, 1))
    assert models.topics(docs.limit(0), "t").count() == 0


def test_missing_category_is_an_error_row(spark):
    import datetime

    rows = [("a", datetime.date(2024, 1, d), float(d), 2.0 * d) for d in range(1, 9)] + [("b", datetime.date(2024, 1, d), 1.0, 5.0 + d % 3) for d in range(1, 9)]
    daily = spark.createDataFrame(rows, "category string, period date, s double, t double")
    got = {r.category: r for r in models.predict_categories(daily, ["a", "b", "z"], "s", "t").collect()}
    assert got["z"].error == "No data for category z" and got["z"].predicted_trend is None
    assert got["a"].error is None and got["a"].today_trend == 9.0 and got["a"].predicted_trend is not None


def test_new_rows_are_embedded_without_the_old_texts(spark):
    from tidemark.operators import embeddings
    from tidemark.session import run_folder

    rows = [(i, f"alpha{i % 5} beta{i % 3} shared") for i in range(60)] + [(100, None), (101, "")]
    late = [(200 + i, f"alpha{i % 5} rare{i}") for i in range(10)]
    make = lambda rows: spark.createDataFrame(rows, "id bigint, t string")
    store = embeddings.EmbeddingStore(spark, run_folder(spark, "vectors"), "id", 32)
    store.embed_missing(make(rows), "t")
    first = {r.id: r.vector for r in store.vectors.read().collect()}
    assert first[100] is None and first[101] is None and abs(sum(x * x for x in first[7]) - 1) < 1e-9
    # The old texts are gone: neither old vectors nor the weights of new ones depend on them.
    store.embed_missing(make([(i, None) for i, _ in rows] + late), "t")
    whole = embeddings.place_counts(make(rows + late), "id", "t", 32)
    want = {r.id: r.vector for r in embeddings.vectors(whole.where("id >= 200"), "id", embeddings.frequencies(whole, "id"), 32).collect()}
    got = {r.id: r.vector for r in store.vectors.read().collect()}
    assert all(got[i] == first[i] for i in first) and all(got[i] == pytest.approx(want[i]) for i in want) and len(got) == 72
    # A run that died before its vectors were stored counts for nothing.
    before = store.frequencies.version()
    store.frequencies.append(spark.createDataFrame([(3, 10_000, "dead")], "place int, documents bigint, batch string"))
    assert store.embed_missing(make(rows), "t") == 2 and store.frequencies.version() == before + 1
    store.embed_missing(make([(300, "alpha1 shared")]), "t")
    more = embeddings.place_counts(make([*rows, *late, (300, "alpha1 shared")]), "id", "t", 32)
    want = embeddings.vectors(more.where("id = 300"), "id", embeddings.frequencies(more, "id"), 32).first().vector
    assert store.vectors.read().where("id = 300").first().vector == pytest.approx(want)


def test_topics_of_many_chunks_equal_those_of_one(spark, monkeypatch):
    docs = spark.createDataFrame([(f"cat dog w{i % 7} w{i % 11} pet " * (1 + i % 3),) for i in range(60)] + [("tax law audit",)] * 40, "t string")
    every = []
    for chunk in (1 << 18, 7):
        monkeypatch.setattr(models, "CHUNK", chunk)
        every.append(sorted((r.topic, r["rank"], r.word, round(r.weight, 6)) for r in models.topics(docs, "t", k=2, words=4, iterations=3).collect()))
    assert every[0] == every[1] and len(every[0]) == 8

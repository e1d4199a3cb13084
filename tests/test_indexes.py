"""Stored indexes against exact search: results, what is read, what is skipped, appends."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import search, text_index, vector_index
from tidemark.session import run_folder


@pytest.fixture(scope="module")
def clustered(spark):
    draw = np.random.default_rng(4)
    middles = draw.standard_normal((24, 24)) * 4
    rows = [(i, (middles[i % 24] + draw.standard_normal(24) * 0.6).tolist()) for i in range(3000)]
    rows += [(10_000 + i, rows[7][1]) for i in range(1500)]  # a third of all rows are one vector
    rows += [(20_000, None), (20_001, [0.0] * 24)]
    return spark.createDataFrame(rows, "id bigint, v array<float>").repartition(6)


def hits(df):
    return {(r["query_id"], r["doc_id"]): round(r["score"], 9) for r in df.collect()}


def test_vector_index_reads_probed_cells_only(spark, clustered):
    index = vector_index.build(clustered.where("id % 5 > 0"), "id", "v", run_folder(spark, "index"), cells=24, trials=32)
    vector_index.append(index, clustered.where("id % 5 = 0"), "id", "v")
    index = vector_index.load(spark, index.folder)
    assert index.recall >= 0.95 and index.probes <= 6
    queries = clustered.where("id < 3000 and id % 100 = 0").select(F.col("id").alias("query_id"), F.col("v").alias("vector"))
    exact, found = hits(search.cosine_top_k(clustered, queries, "id", "v", 10, None)), hits(vector_index.top_k(index, queries, 10))
    assert len(found.keys() & exact.keys()) >= 0.9 * len(exact)
    assert all(abs(found[key] - exact[key]) < 1e-9 for key in found.keys() & exact.keys())
    # All cells probed: the answer is the exact one, ties included.
    assert hits(vector_index.top_k(index, queries, 10, probes=24)) == exact

    blocks = vector_index.probed_blocks(index, [3, 5])
    plan = blocks._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan and "PushedFilters" in plan
    assert {f.split("cell=")[1].split("/")[0] for f in blocks.select("ids").inputFiles()} <= {str(c) for c in range(24)}
    assert {r["cell"] for r in blocks.select("cell").distinct().collect()} <= {3, 5}
    # A hot cell is many bounded blocks, and every usable row is stored once.
    sizes = index.blocks().select(F.size("ids").alias("n")).collect()
    assert max(r["n"] for r in sizes) <= vector_index.BLOCK_ROWS and sum(r["n"] for r in sizes) == 4500


def test_vector_index_odd_inputs(spark):
    empty = spark.createDataFrame([], "id string, v array<double>")
    queries = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None), ("c", [0.0, 0.0])], "query_id string, vector array<double>")
    assert vector_index.top_k(vector_index.build(empty, "id", "v", run_folder(spark, "index")), queries).collect() == []
    few = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [1.0, 0.0]), ("z", [0.0, 2.0])], "id string, v array<double>")
    found = vector_index.top_k(vector_index.build(few, "id", "v", run_folder(spark, "index")), queries, 2, probes=9).collect()
    assert [(r["query_id"], r["doc_id"], r["rank"]) for r in sorted(found, key=lambda r: r["rank"])] == [("a", "x", 1), ("a", "y", 2)]
    with pytest.raises(ValueError, match="bigint, int or string"):
        vector_index.build(spark.createDataFrame([(1.5, [1.0])], "id double, v array<double>"), "id", "v", run_folder(spark, "index"))


@pytest.fixture(scope="module")
def library(spark):
    pick = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(pick.choices(words, weights, k=pick.randint(1, 60))), pick.choice(["red", "blue w5", None])) for i in range(2500)]
    rows += [(5000, None, None), (5001, "", "w7"), (5002, "w1 " * 20_000, "x")] + [(6000 + i, "w250 w251 copy", "same") for i in range(400)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)


@pytest.mark.parametrize("fields", [["text"], ["text", "source"]])
def test_text_index_gives_the_scan_s_answer(spark, library, fields):
    pick = random.Random(2)
    asked = [(i, " ".join(f"W{int(299 * pick.random() ** 3)}" for _ in range(pick.randint(1, 9)))) for i in range(120)]
    asked += [(900, "unknown words"), (901, None), (902, "copy w250"), (903, "blue")]
    queries = spark.createDataFrame(asked, "query_id int, text string")
    index = text_index.build(library.where("doc_id % 3 > 0"), "doc_id", fields, run_folder(spark, "index"))
    text_index.append(index, library.where("doc_id % 3 = 0"), "doc_id", fields)
    for k in (3, 200):
        want = {(r["query_id"], r["rank"]): (r["doc_id"], round(r["score"], 8)) for r in search.text_match(library, queries, "doc_id", fields, k).collect()}
        got = {(r["query_id"], r["rank"]): (r["doc_id"], round(r["score"], 8)) for r in text_index.search(index, queries, k).collect()}
        assert got == want


def test_text_index_reads_and_scores_little(spark, library):
    index = text_index.build(library, "doc_id", ["text"], run_folder(spark, "index"))
    terms = spark.createDataFrame([("w3",), ("w250",)], "term string")
    blocks = text_index.term_blocks(index, terms)
    plan = blocks._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [In(key, [" in plan
    assert {r["term"] for r in blocks.select("term").distinct().collect()} == {"w3", "w250"}
    every = index.blocks().where("term <> ''").agg(F.max("n").alias("most"), F.sum("n").alias("n")).first()
    assert every["most"] <= text_index.BLOCK
    assert every["n"] == library.select(F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), " ")))).where("length(col) > 1").count()


def test_text_index_skips_blocks(spark, monkeypatch):
    """A rare word with a frequent one: the frequent one's weaker blocks are out of reach."""
    rows = [(i, "common " + " ".join(f"f{(i * 7 + j) % 997}" for j in range(1 + i % 90))) for i in range(6000)] + [(9000 + i, "rare common") for i in range(20)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    index = text_index.build(documents, "doc_id", ["text"], run_folder(spark, "index"))
    queries = spark.createDataFrame([(1, "rare common")], "query_id bigint, text string")
    scored = []
    scorer = text_index._scorer

    def counted(*args):
        inner, read = scorer(*args), spark.sparkContext.accumulator(0)
        scored.append(read)

        def score(table):
            read.add(table.num_rows)
            return inner(table)

        return score

    monkeypatch.setattr(text_index, "_scorer", counted)
    got = [(r["doc_id"], r["rank"]) for r in text_index.search(index, queries, 10).collect()]
    assert sorted(got, key=lambda r: r[1]) == [(9000 + i, i + 1) for i in range(10)]
    stored = index.blocks().where("term in ('rare', 'common')").count()
    assert scored[0].value < stored / 4


def test_text_index_empty(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    queries = spark.createDataFrame([(1, "a b")], "query_id int, text string")
    index = text_index.build(empty, "doc_id", ["text"], run_folder(spark, "index"))
    assert text_index.search(index, queries).collect() == []
    text_index.append(index, spark.createDataFrame([("k", "bb cc"), (None, "bb")], "doc_id string, text string"), "doc_id", ["text"])
    assert [r["doc_id"] for r in text_index.search(index, spark.createDataFrame([(1, "bb")], "query_id int, text string")).collect()] == ["k"]

"""Hot keys, exactness against brute force, and the shape of physical plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators import joins, keywords, ranking
from tidemark.plans import load_all
from tidemark.tables import Tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows under one key, another third under null."""
    draw = random.Random(1)
    rows = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{draw.randint(0, 50)}", draw.random(), i) for i in range(6000)]
    return rows, spark.createDataFrame(rows, "k string, v double, i int").repartition(16)


def brute_positions(rows):
    groups = {}
    for k, v, i in rows:
        groups.setdefault(k, []).append((v, i))
    return {i: n for items in groups.values() for n, (_, i) in enumerate(sorted(items), 1)}


@pytest.mark.parametrize("hot_rows", [0, 500, 1_000_000])
def test_positions_of_hot_keys(spark, hot, hot_rows):
    rows, df = hot
    placed = ranking.with_positions(df, ["k"], ["v", "i"], hot_rows=hot_rows)
    assert {r.i: r.position for r in placed.collect()} == brute_positions(rows)
    descending = ranking.with_positions(df, ["k"], ["v", "i"], descending=True, hot_rows=hot_rows).filter("k = 'hot'")
    assert [r.i for r in descending.orderBy("position").collect()] == [i for v, i in sorted(((v, i) for k, v, i in rows if k == "hot"), reverse=True)]


def test_a_hot_key_is_cut_into_many_partitions(spark, hot):
    _, df = hot
    sort = ["k", "v", "i"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = df.repartitionByRange(*sort).filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1


def test_positions_without_key_and_empty(spark, hot):
    rows, df = hot
    placed = ranking.with_positions(df, [], ["i"])
    assert sorted((r.position, r.i) for r in placed.collect()) == [(i + 1, i) for i in range(len(rows))]
    assert ranking.with_positions(df.filter("i < 0"), ["k"], ["i"]).count() == 0


def test_chunks_keep_everything(spark, hot, monkeypatch):
    rows, df = hot
    monkeypatch.setattr(ranking, "HOT_ROWS", 500)
    lists = ranking.list_chunks(df, ["k"], "i", ["v", "i"], 100).collect()
    assert max(len(r["items"]) for r in lists) == 100
    joined = [i for r in sorted((r for r in lists if r.k == "hot"), key=lambda r: r.chunk) for i in r["items"]]
    assert joined == [i for _, i in sorted((v, i) for k, v, i in rows if k == "hot")]
    assert sum(len(r["items"]) for r in lists) == len(rows)


@pytest.mark.parametrize("n", [0, 1, 10, 11, 200])
def test_rank_band(spark, n):
    counts = [("c", f"w{i:03d}", (i * 7) % 5) for i in range(n)]
    got = ranking.rank_band(spark.createDataFrame(counts, "c string, word string, count int"), "c", "word", "count")
    order = sorted(counts, key=lambda r: (r[2], r[1]))
    expected = order[int(n * 7 // 10):int(n * 8 // 10)][:15]
    assert [r.word for r in got.orderBy("rank").collect()] == [w for _, w, _ in expected]


def test_pages(spark):
    df = spark.createDataFrame([(i,) for i in range(12)], "i int")
    assert [r.i for r in ranking.page(df, ["i"], 2, 5).collect()] == [5, 6, 7, 8, 9]
    assert [r.i for r in ranking.page(df, ["i"], 99, 5).collect()] == [10, 11]
    assert [r.i for r in ranking.page(df, ["i"], 0, 5).collect()] == [0, 1, 2, 3, 4]
    assert ranking.page(df.limit(0), ["i"], 1, 5).count() == 0


@pytest.mark.parametrize("n", [1, 4, 5, 9, 10])
def test_chronological_split(spark, n):
    df = spark.createDataFrame([("s", i) for i in range(n)], "k string, i int")
    rows = ranking.chronological_split(df, "k", ["i"]).collect()
    assert sorted(r.i for r in rows if r.part == "train") == list(range(int(0.8 * n)))
    assert len(rows) == n


def test_top_per_key_matches_brute_force(spark, hot):
    rows, df = hot
    got = {(r.k, r.i) for r in ranking.top_per_key(df, ["k"], [F.col("v").desc(), F.col("i")], 3).collect()}
    groups = {}
    for k, v, i in rows:
        groups.setdefault(k, []).append((-v, i))
    assert got == {(k, i) for k, items in groups.items() for _, i in sorted(items)[:3]}


def test_latest_and_first(spark, hot):
    rows, df = hot
    latest = {r.k: r.i for r in ranking.latest_per_key(df, ["k"], ["v", "i"]).collect()}
    first = {r.k: r.i for r in ranking.first_per_category(df, "k", "v", ["i"]).collect()}
    for k in {k for k, _, _ in rows}:
        mine = sorted((v, i) for key, v, i in rows if key == k)
        assert latest[k] == mine[-1][1] and first[k] == mine[0][1]


def test_parents_with_children_on_a_hot_parent(spark):
    parents = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "p int, day string")
    children = spark.createDataFrame([(1, c) for c in range(500)] + [(9, 1)], "p int, c int")
    rows = joins.parents_with_children(parents, children, "p", "day", ["c"]).collect()
    assert [(r.p, r.c) for r in rows] == [(2, None)] + [(1, c) for c in range(500)] + [(3, None)]


def test_new_rows_match_null_keys_and_repeat_safely(spark):
    stored = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "t string, u string")
    incoming = spark.createDataFrame([("a", None), ("b", "y"), ("b", "y"), (None, None)], "t string, u string")
    fresh = joins.new_rows_only(incoming, stored, ["t", "u"])
    assert sorted(map(repr, map(tuple, fresh.collect()))) == sorted(map(repr, [("b", "y"), ("b", "y"), (None, None)]))
    assert joins.new_rows_only(incoming, stored.unionByName(fresh), ["t", "u"]).count() == 0
    assert joins.new_rows_only(incoming, stored.limit(0), ["t", "u"]).count() == 4


def test_upsert(spark):
    target = spark.createDataFrame([(1, "old"), (None, "null")], "k int, v string")
    incoming = spark.createDataFrame([(1, "first", 1), (1, "last", 2), (2, "new", 1), (None, "later", 1)], "k int, v string, o int")
    kept = {r.k: r.v for r in joins.upsert(target, incoming, ["k"], False, ["o"]).collect()}
    forced = {r.k: r.v for r in joins.upsert(target, incoming, ["k"], True, ["o"]).collect()}
    assert kept == {1: "old", 2: "new", None: "null"}
    assert forced == {1: "last", 2: "new", None: "later"}


def test_outer_by_name_uses_the_fallback(spark):
    left = spark.createDataFrame([("a", 1)], "name string, x int")
    right = spark.createDataFrame([("a", 2), ("b", 3)], "other string, y int")
    rows = joins.outer_by_name(left, right, "name", "other").collect()
    assert sorted((r.name, r.x or 0, r.y) for r in rows) == [("a", 1, 2), ("b", 0, 3)]


def test_keywords_match_whole_tokens(spark):
    df = spark.createDataFrame([(1, "c", "the theme"), (2, "c", "The, the"), (3, "d", "the")], "i int, k string, t string")
    words = spark.createDataFrame([("c", "the")], "k string, word string")
    assert sorted(r.i for r in keywords.documents_with(df, "i", "t", "k", words).collect()) == [1, 2]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_plan_has_no_pairwise_join(spark, name):
    plan = executed(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = executed(entry.queries()["scan_project_filter"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert set(re.search(r"ReadSchema: struct<(.*?)>", plan).group(1).split(",")) == {
        "o_orderkey:bigint", "o_custkey:bigint", "o_totalprice:double", "o_orderdate:timestamp_ntz"}


def test_rank_limits_apply_before_the_shuffle(spark):
    plan = executed(entry.queries()["top_words"](spark, FOLDER))
    assert plan.count("WindowGroupLimit") == 2


def test_newest_rows_need_no_sort_of_the_table(spark):
    assert "TakeOrderedAndProject" in executed(entry.queries()["newest_n"](spark, FOLDER))


def test_named_queries(spark):
    registry = load_all()
    assert registry.run(spark, FOLDER, "no such id") == (None, "unknown query id: no such id")
    result, message = registry.run(spark, FOLDER, "newest_n")
    assert message == "" and result.count() == 20
    registry.add("nothing")(lambda t: t.region.limit(0))
    try:
        assert registry.run(spark, FOLDER, "nothing")[1] == "no rows for query id: nothing"
    finally:
        del registry.functions["nothing"]


def test_sql_that_does_not_resolve_gives_none(spark):
    from tidemark.tables import execute_query

    Tables(spark, FOLDER).register_views("region")
    assert execute_query(spark, "SELECT count(*) AS n FROM region").first().n == 5
    assert execute_query(spark, "SELECT nothing FROM region") is None
    assert execute_query(spark, "SELEC") is None


def test_cluster_without_shared_folder_is_an_error(spark, monkeypatch):
    from types import SimpleNamespace

    from tidemark import session

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context)
    with pytest.raises(ValueError):
        session.shared_folder(fake)
    fake.conf = SimpleNamespace(get=lambda key, default=None: "/shared/work")
    assert session.shared_folder(fake) == "/shared/work"

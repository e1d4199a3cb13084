"""What operators leave behind: tables that nothing reads any more, and memory of Python workers."""

import os

import pytest

from tidemark import session
from tidemark.llm import common, exact_dedup, ngram_join, toxicity


def folders(spark):
    path = session.shared_folder(spark).removeprefix("file:")
    return {name for name in os.listdir(path) if not name.startswith(".")} if os.path.isdir(path) else set()


def left_by(spark, work):
    """(result, labels of the new folders)"""
    before = folders(spark)
    result = work()
    return result, sorted(name.rpartition("-")[0] for name in folders(spark) - before)


@pytest.fixture(scope="module")
def docs(spark):
    words = [f"w{i}" for i in range(40)]
    texts = {1: " ".join(words), 2: " ".join(words[:-1]), 3: " ".join(words) + " ", 4: "alone here", 5: None, 6: ""}
    return common.pin(spark.createDataFrame([(i, t, "s") for i, t in texts.items()], "doc_id long, text string, source string"), "docs")


def test_scratch(spark):
    with common.scratch(spark) as outer:
        first = common.pin(spark.range(3), "first")
        with common.scratch(spark) as inner:
            second, third = common.pin(spark.range(4), "second"), common.pin(spark.range(5), "third")
            inner.append(second.where("id > 0").join(first, "id"))
        names = {name.rpartition("-")[0] for name in folders(spark)}
        assert "second" in names and "third" not in names and third.columns == ["id"]
        outer.append(first)
    names = {name.rpartition("-")[0] for name in folders(spark)}
    assert "first" in names and "second" not in names and first.count() == 3
    with pytest.raises(ZeroDivisionError), common.scratch(spark):
        kept = common.pin(spark.range(2), "after-error")
        raise ZeroDivisionError
    assert kept.count() == 2 and not common.MADE


def test_stages_leave_what_they_read(spark, docs):
    result, left = left_by(spark, lambda: exact_dedup.deduplicate(docs))
    assert left == ["dropped"]
    assert sorted(r["doc_id"] for r in result.collect()) == [2, 3, 4, 5]

    result, left = left_by(spark, lambda: ngram_join.keep_one(docs))
    assert left == ["kept"]
    assert sorted(r["doc_id"] for r in result.collect()) == [1, 4, 5, 6]

    result, left = left_by(spark, lambda: ngram_join.join(docs))
    assert left == ["fate", "rows"]
    assert {r["doc_id"]: r["component_id"] for r in result.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}

    labels = spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, toxic int")
    _, left = left_by(spark, lambda: toxicity.fit(docs, labels))
    assert left == []


def test_digests_that_clash_keep_their_texts(spark, docs):
    result, left = left_by(spark, lambda: exact_dedup.decide(docs, digest=lambda text: common.F.substring(text, 1, 1)))
    assert "hits" in left and "state" not in left
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in result.collect()} == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1), 5: (5, 2), 6: (5, 2)}


def test_workers_give_memory_back(spark):
    def run(batches):
        for batch in batches:
            held = [bytes(1000) for _ in range(200_000)]
            yield batch.slice(0, len(held) and batch.num_rows)

    def held(batches):
        import re

        import pyarrow as pa

        for _ in batches:
            pass
        text = open("/proc/self/smaps_rollup").read()
        yield pa.RecordBatch.from_pydict({"kb": [int(re.search(r"Pss_Anon:\s+(\d+)", text)[1])]})

    one = spark.range(0, 1, 1, 1)
    before = one.mapInArrow(held, "kb long").first()["kb"]
    one.mapInArrow(common.lean(run), "id long").collect()
    assert one.mapInArrow(held, "kb long").first()["kb"] < before + 60_000

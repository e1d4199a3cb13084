"""Versioned tables: what readers see, what a merge rewrites, what a dead or late writer leaves."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.session import run_folder
from tidemark.sources.versioned import Conflict, VersionedTable

SCHEMA = "id bigint, part string, value string"


def table(spark):
    return VersionedTable(spark, run_folder(spark, "versioned"))


def stored(spark, rows=1000, files=10):
    """Rows ranged by key over some files."""
    made = table(spark)
    made.replace(spark.createDataFrame([(i, f"p{i % 3}", f"v{i}") for i in range(rows)], SCHEMA).repartitionByRange(files, "id"))
    return made


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


def stamps(made, files):
    root = made.folder.removeprefix("file:")
    return {name: (os.stat(f"{root}/data/{name}").st_mtime_ns, os.stat(f"{root}/data/{name}").st_ino) for name in files}


def test_merge_rewrites_touched_files_only(spark):
    made = stored(spark)
    before, times = made.files(), stamps(made, made.files())
    assert len(before) == 10
    incoming = spark.createDataFrame([(205, "p", "first"), (205, "p", "second"), (207, "p", "x"), (5000, "p", "new"), (None, "p", "null")],
                                     SCHEMA).withColumn("at", F.monotonically_increasing_id())
    assert made.touched(spark.createDataFrame([(205,), (5000,), (None,)], "id bigint")) == [f for f in before if f in set(made.touched(spark.createDataFrame([(205,)], "id bigint")))]
    made.merge(incoming, ["id"], force=True, order=["at"])
    after = made.files()
    kept = set(before) & set(after)
    assert len(kept) == 9 and stamps(made, kept) == {name: times[name] for name in kept}
    got = {r["id"]: r["value"] for r in made.read().collect()}
    assert got[205] == "second" and got[207] == "x" and got[5000] == "new" and got[None] == "null" and len(got) == 1002 and got[206] == "v206"
    # A null key is a key: it is replaced, not added again.
    made.merge(spark.createDataFrame([(None, "q", "again")], SCHEMA), ["id"])
    assert made.read().where("id is null").collect()[0]["value"] == "again" and made.read().count() == 1002


@pytest.mark.parametrize("force", [True, False])
def test_merge_equals_upsert(spark, force):
    pick = random.Random(3)
    old = [(pick.randint(0, 300), pick.choice("ab"), f"o{i}") for i in range(400)]
    old = list({(i, p): (i, p, v) for i, p, v in old}.values())
    new = [(pick.choice([None, *range(250, 360)]), pick.choice(["a", "b", None]), f"n{i}", i) for i in range(300)]
    left, right = spark.createDataFrame(old, SCHEMA).repartition(5), spark.createDataFrame(new, SCHEMA + ", at int").repartition(4)
    made = table(spark)
    made.replace(left)
    made.merge(right, ["id", "part"], force=force, order=["at"])
    want = joins.upsert(left, right, ["id", "part"], force, ["at"])
    assert values(made.read().select("id", "part", "value")) == values(want.select("id", "part", "value"))


def test_a_reader_keeps_its_version(spark):
    made = stored(spark, 100, 4)
    reader = made.read()
    assert reader.count() == 100
    made.replace(spark.createDataFrame([(1, "p", "only")], SCHEMA))
    made.append(spark.createDataFrame([(2, "p", "more")], SCHEMA))
    assert reader.count() == 100 and made.read().count() == 2 and made.read(1).count() == 100 and made.versions() == [1, 2, 3]
    made.vacuum(keep=2)
    assert made.versions() == [2, 3] and made.read(2).count() == 1 and values(made.read()) == [(1, "p", "only"), (2, "p", "more")]


def test_a_change_that_dies_is_not_seen(spark, monkeypatch):
    made = stored(spark, 100, 4)
    want, files = values(made.read()), made.files()

    def refuse(written):
        assert written.count() == 1
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        made.replace(spark.createDataFrame([(1, "p", "x")], SCHEMA), [refuse])
    with monkeypatch.context() as patch:
        patch.setattr(made, "_commit", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError, match="killed"):
            made.merge(spark.createDataFrame([(1, "p", "x")], SCHEMA), ["id"])
    assert made.versions() == [1] and made.files() == files and values(made.read()) == want
    # A manifest that was never given its number is no version either, and the lost files can be cleared.
    root = made.folder.removeprefix("file:")
    open(f"{root}/manifests/.half", "w").write("{")
    assert made.version() == 1
    made.vacuum()
    assert len(glob.glob(f"{root}/data/*/part-*")) == 4 and values(made.read()) == want


def test_the_second_of_two_writers_is_refused(spark):
    made = stored(spark, 50, 2)
    other = VersionedTable(spark, made.folder)
    files = other._write(spark.createDataFrame([(7, "p", "late")], SCHEMA))
    schema, base = other._schema(1), other.version()
    made.append(spark.createDataFrame([(8, "p", "soon")], SCHEMA))
    with pytest.raises(Conflict):
        other._commit(other.files(base) + files, schema, base)
    assert made.versions() == [1, 2] and made.read().where("id = 7").count() == 1 and made.read().where("id = 8").count() == 2


def test_append_new_and_empty(spark):
    made = table(spark)
    with pytest.raises(FileNotFoundError):
        made.read()
    rows = spark.createDataFrame([(1, None, "a"), (2, "p", "b")], SCHEMA)
    made.append_new(rows.limit(0), ["id", "part"])
    assert made.read().count() == 0 and made.read().columns == ["id", "part", "value"]
    assert made.append_new(rows, ["id", "part"]) == 2 and made.append_new(rows, ["id", "part"]) == 2
    assert values(made.read()) == [(1, None, "a"), (2, "p", "b")]
    assert made.merge(rows.limit(0), ["id"]) == 2

"""Checked builds, incremental loads and streams."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.streaming import flows


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def read(spark, path):
    return sorted(r.v for r in spark.read.parquet(path).collect())


def test_checked_build(spark, tmp_path):
    target = str(tmp_path / "summary")
    quality.checked_build(spark, target, lambda: frame(spark, 1, 2), [(frame(spark, 1), ">=", 1)], [(lambda df: df, "eq", 2)])
    assert read(spark, target) == [1, 2]
    with pytest.raises(quality.CheckFailed):
        quality.checked_build(spark, target, lambda: frame(spark, 9), [(frame(spark), ">=", 1)])
    with pytest.raises(quality.CheckFailed):
        quality.checked_build(spark, target, lambda: frame(spark, 9), [], [(lambda df: df, "eq", 2)])
    assert read(spark, target) == [1, 2]
    quality.checked_build(spark, target, lambda: frame(spark, 7))
    assert read(spark, target) == [7]


def test_incremental_mark(spark, tmp_path):
    target = str(tmp_path / "t")
    source = frame(spark, 2016, 2017, 2018, 2019)
    quality.append_past_mark(spark, source, target, "v", 2016, 2018)
    assert read(spark, target) == [2017, 2018]
    for _ in range(2):
        quality.append_past_mark(spark, source, target, "v", 2016)
    assert read(spark, target) == [2017, 2018, 2019]


def test_new_rows_load_twice(spark, tmp_path):
    target = str(tmp_path / "t")
    for _ in range(2):
        quality.append_new_rows(spark, frame(spark, 1, None, 2), target, ["v"])
    assert spark.read.parquet(target).count() == 3


def test_feedback_last_write_wins(spark):
    messages = spark.createDataFrame([(1, 0), (1, 1)], "s int, m int")
    given = spark.createDataFrame([(1, 0, 5, 1), (1, 0, 9, -1), (2, 0, 1, 1)], "s int, m int, t int, liked int")
    rows = {(r.s, r.m): r.liked for r in quality.apply_feedback(messages, given, ["s", "m"], ["t"], "liked").collect()}
    assert rows == {(1, 0): -1, (1, 1): None}


def events(spark, *rows):
    start = datetime.datetime(2024, 1, 1)
    made = [(k, start + datetime.timedelta(hours=h), float(v)) for k, h, v in rows]
    return spark.createDataFrame(made, "k string, ts timestamp_ntz, v double")


def test_stream_append_takes_each_file_once(spark, tmp_path):
    landed, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    events(spark, ("a", 1, 1), ("b", 2, 2)).coalesce(1).write.mode("append").parquet(landed)
    schema = spark.read.parquet(landed).schema
    for expected in (2, 2):
        flows.run(flows.landed_files(spark, landed, schema), target, progress)
        assert spark.read.parquet(target).count() == expected
    events(spark, ("c", 3, 3)).coalesce(1).write.mode("append").parquet(landed)
    flows.run(flows.landed_files(spark, landed, schema), target, progress)
    assert spark.read.parquet(target).count() == 3


def test_stream_dedup_across_runs(spark, tmp_path):
    landed, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in ([("a", 1, 1), ("a", 2, 2), ("b", 2, 3)], [("a", 3, 4), ("c", 3, 5)]):
        events(spark, *part).coalesce(1).write.mode("append").parquet(landed)
        schema = spark.read.parquet(landed).schema
        flows.run(flows.unseen_keys(flows.landed_files(spark, landed, schema), ["k"], "ts", "2 days"), target, progress)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def test_stream_new_rows(spark, tmp_path):
    landed, target = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, ("a", 1, 1), ("a", 2, 2), ("b", 2, 3)).coalesce(1).write.mode("append").parquet(landed)
    schema = spark.read.parquet(landed).schema
    for progress in ("p1", "p2"):  # a lost progress folder replays every file
        flows.run_new_rows(flows.landed_files(spark, landed, schema), target, str(tmp_path / progress), ["k"])
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == ["a", "b"]


def test_stream_of_unseen_keys_reads_the_stored_table_once(spark, tmp_path):
    landed, target, progress, table = (str(tmp_path / n) for n in ("in", "out", "progress", "stored"))
    events(spark, ("b", 2, 3), ("z", 1, 1)).coalesce(1).write.parquet(table)
    stored = spark.read.parquet(table)
    parts = [[("a", 1, 1), ("a", 2, 2), ("b", 2, 3), (None, 1, 1)], [("a", 9000, 4), ("c", 3, 5), (None, 5, 5)], [("z", 8760, 1), ("d", -8760, 1), ("c", 1, 1)]]
    for n, part in enumerate(parts):
        events(spark, *part).coalesce(1).write.mode("append").parquet(landed)
        stream = flows.landed_files(spark, landed, spark.read.parquet(landed).schema)
        flows.run_first_of_keys(stream, target, progress, ["k"], stored)
        if n == 0:  # from now on the table is gone, and only the state knows its keys
            os.rename(table, table + "-moved")
            os.makedirs(table)
    assert sorted(r.k or "" for r in spark.read.parquet(target).collect()) == ["", "a", "c", "d"]


def test_stream_of_unseen_keys_makes_no_python_call_a_key(spark, tmp_path):
    landed, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    stored = spark.createDataFrame([("k1", None), ("k2", None), (None, None)], "k string, v int")
    for part in (0, 2):  # files of both starts, two a batch
        for file in (0, 1):
            rows = [(f"k{i}" if i else None, 10 * part + file) for i in range(part, part + 5)]
            spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(landed)
        stream = flows.landed_files(spark, landed, spark.read.parquet(landed).schema, files_per_batch=1)
        assert "Pandas" not in flows.first_of_keys(stream, ["k"])._jdf.queryExecution().analyzed().toString()
        flows.run_first_of_keys(stream, target, progress, ["k"], stored)
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == ["k3", "k4", "k5", "k6"]
    got = {r.k: r.v for r in spark.read.parquet(target).collect()}
    assert got["k3"] in (0, 1) and got["k5"] in (20, 21)


def test_stream_buckets_equal_batch_and_drop_late_rows(spark, tmp_path):
    landed, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    first, second = [("a", 1, 1), ("a", 2, 3), ("a", 30, 5), ("a", 100, 7)], [("a", 3, 9), ("a", 200, 1)]
    for part in (first, second):
        events(spark, *part).coalesce(1).write.mode("append").parquet(landed)
        schema = spark.read.parquet(landed).schema
        stream = flows.landed_files(spark, landed, schema)
        flows.run(flows.bucket_stream(stream, ["k"], "ts", "v", "date", "1 day"), target, progress)
    batch = {(r.bucket, r.n, r["mean"]) for r in flows.buckets(flows.on_event_time(events(spark, *first), "ts"), ["k"], "ts", "v", "date").collect()}
    got = {(r.bucket, r.n, r["mean"]) for r in spark.read.parquet(target).collect()}
    assert got <= batch and len(got) >= 3  # the last bucket stays open, the late row is not counted
    with pytest.raises(ValueError):
        flows.bucket_stream(flows.landed_files(spark, landed, schema), ["k"], "ts", "v", "year", "1 day")


def stamped(spark, *rows):
    return spark.createDataFrame([("a", datetime.datetime.fromisoformat(ts), v) for ts, v in rows], "k string, ts timestamp, v int")


def test_stream_of_calendar_months(spark, tmp_path):
    landed, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    runs = [
        ([("2023-12-31T23:59:59", 2), ("2024-01-01", 4), ("2024-02-29T23:59:59", 6)], [("2023-12-01", 1, 2.0), ("2024-01-01", 1, 4.0)]),
        ([("2024-03-01T12:00:00", 1), ("2024-02-01", 8)], []),  # half a day into March: February is open still
        ([("2024-02-15", 1), ("2024-03-02T00:00:01", 3)], [("2024-02-01", 3, 5.0)]),
        ([("2024-02-28", 100), ("2024-04-03", 5), (("2025-01-31T10:00:00"), 7)], [("2024-03-01", 2, 2.0), ("2024-04-01", 1, 5.0)]),  # too late for February
    ]
    want = set()
    for rows, closed in runs:
        stamped(spark, *rows).coalesce(1).write.mode("append").parquet(landed)
        stream = flows.landed_files(spark, landed, spark.read.parquet(landed).schema)
        flows.run(flows.bucket_stream(stream, ["k"], "ts", "v", "month", "1 day"), target, progress)
        want |= set(closed)
        assert {(str(r.bucket)[:10], r.n, r["mean"]) for r in spark.read.parquet(target).collect()} == want


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "Asia/Seoul"])
def test_month_clock_turns_back_into_months(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        hours = spark.sql("SELECT explode(sequence(timestamp'1968-11-30', timestamp'1972-03-02', interval 7 hours)) AS ts").union(
            spark.sql("SELECT explode(sequence(timestamp'2023-12-31', timestamp'2024-12-31', interval 1 hour))"))
        clock = F.window(flows.month_clock("ts"), f"{flows.MONTH_DAYS} days")["start"]
        assert hours.select("ts", clock.alias("w")).where(flows.month_of_clock(F.col("w")) != F.date_trunc("month", "ts")).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_weeks_start_on_monday(spark):
    rows = flows.buckets(events(spark, ("a", 0, 1), ("a", 167, 1), ("a", 168, 1)), ["k"], "ts", "v", "week").collect()
    assert sorted((str(r.bucket), r.n) for r in rows) == [("2024-01-01 00:00:00", 2), ("2024-01-08 00:00:00", 1)]

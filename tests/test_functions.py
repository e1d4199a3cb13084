"""Column functions on hand-made values."""

import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.functions import dates, geometry, labels, numbers, text


def values(spark, items, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.o for r in df.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


def test_coerced_dates(spark):
    got = values(spark, ["2024-01-05", "", "no date", None, "2024-13-01"], lambda c: dates.date_coerced(c, "yyyy-MM-dd"))
    assert got == ["2024-01-05", None, None, None, None]


def test_strict_date_raises(spark):
    assert values(spark, ["20240105"], dates.date_strict) == [datetime.date(2024, 1, 5)]
    with pytest.raises(Exception):
        values(spark, ["2024x"], dates.date_strict)


def test_ampm(spark):
    got = values(spark, ["2024.11.17. 오전 9:05", "2024.11.17. 오후 12:30", "2024.11.17. 오전 12:30", " ", None, "x"], dates.ampm_stamp)
    assert got == ["2024-11-17 09:05:00", "2024-11-17 12:30:00", "2024-11-17 00:30:00", None, None, None]


def test_rfc822_keeps_local_time(spark):
    got = values(spark, ["Fri, 05 Jan 2024 15:07:09 +0900", "Fri, 05 Jan 2024 15:07:09 GMT", None], dates.rfc822_stamp)
    assert got == ["2024-01-05 15:07:09", None, None]


def test_text_date(spark):
    assert values(spark, ["시행 2024년 3월 7일부터", "2024-03-07", None], dates.text_date) == ["2024-03-07", None, None]


def test_numbers(spark):
    assert values(spark, ["1.5", "x", "", "NaN", None], numbers.number_or_null) == [1.5, None, None, None, None]
    assert values(spark, ["$1,234.50", "-", None], numbers.clean_money) == [1234.5, None, None]
    assert values(spark, ["50%", "x"], numbers.percent_fraction) == [0.5, None]


def test_indicator_text(spark):
    df = spark.createDataFrame([("CPI", 3.456), ("GDP", 1234.5), ("JOLTS Hires", 7.0), ("Other", 0.125), ("CPI", None)], "n string, v double")
    got = [r.o for r in df.select(numbers.indicator_text("n", "v").alias("o")).collect()]
    assert got == ["3.46%", "$1234.50B", "7.00K", "0.12", "N/A"]


def test_row_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    assert [r.m for r in df.select(numbers.row_mean(["a", "b", "c"]).alias("m")).collect()] == [2.0, None]


def test_priority_takes_the_highest(spark):
    got = values(spark, ["여행유의, 여행금지", "여행자제", "출국권고 여행유의", "", "기타"], labels.priority_by_substring)
    assert got == [4, 2, 3, 0, 0]


def test_flags(spark):
    df = spark.createDataFrame([(["여행금지", "여행유의", "?"],), ([],), (None,)], "t array<string>")
    rows = labels.flag_columns(df, "t").collect()
    assert (rows[0].Travel_Ban, rows[0].Travel_Restriction, rows[0].Travel_Caution) == (True, True, False)
    assert not any(rows[1][1:]) and not any(rows[2][1:])


def test_priority_by_flag_null_is_false(spark):
    df = spark.createDataFrame([(None, True), (None, None)], "a boolean, b boolean")
    assert [r.o for r in df.select(labels.priority_by_flag([("a", "A"), ("b", "B")], "none").alias("o")).collect()] == ["B", "none"]


def test_ordinal_and_labels(spark):
    assert values(spark, ["많이 커졌다", "?", None], labels.ordinal) == [5, None, None]
    assert values(spark, ["a", "z", None], lambda c: labels.code_label(c, {"a": "A"})) == ["A", None, None]
    assert values(spark, ["a", "z", None], lambda c: labels.code_label(c, {"a": "A"}, keep_unknown=True)) == ["A", "z", None]


def test_sections(spark):
    notice = "1. 개정 이유\n 가나\n다라\n2. 주요 내용\n 본문\n 3. 의견제출 기한"
    enact = "1. 제정이유 새 법 2. 주요내용 본문 둘 3. 기타"
    assert values(spark, [notice, enact, "x", None], text.revision_reason) == ["가나\n다라", "새 법", text.NO_REASON, text.NO_REASON]
    assert values(spark, [notice, enact, "x", None], text.main_content) == ["본문", "본문 둘", text.NO_CONTENT, text.NO_CONTENT]


def test_period(spark):
    got = values(spark, ["예고기간 2024-01-01 ~ 2024-02-01", "예고기간 2024-01-01", "x", None], text.period_bounds)
    assert got == [Row(start="2024-01-01", end="2024-02-01"), Row(start="2024-01-01", end=None),
                   Row(start=text.NO_DATE, end=text.NO_DATE), Row(start=text.NO_DATE, end=text.NO_DATE)]


def test_labelled_value(spark):
    got = values(spark, ["Title: a b\nFees: 10", "none", None], lambda c: text.labelled_value(c, "Fees"))
    assert got == ["10", "N/A", "N/A"]


def test_urls(spark):
    assert values(spark, ["./x?a=./y", "/z"], lambda c: text.absolute_url(c, "https://h")) == ["https://h/x?a=/y", "https://h/z"]
    assert values(spark, ["a b&c"], text.url_word) == ["a%20b%26c"]


def test_keywords(spark):
    got = values(spark, ["가나 등 가나 다라 마바 사아 자차 카타", None], lambda c: text.lead_keywords(c))
    assert got == [["가나", "다라", "마바", "사아"], []]
    df = spark.createDataFrame([("경제 뉴스 a 경제", "경제")], "t string, c string")
    assert df.select(text.tokens("t", category="c").alias("o")).first().o == ["뉴스"]


def test_lead_sentence(spark):
    assert values(spark, ["A b.\nC.", "no end", ""], text.lead_sentence) == ["A b.", "no end", ""]


def test_benefit_labels(spark):
    got = values(spark, ["주유소 할인과 스타벅스", "없음"], lambda c: text.labels_by_word(c, text.BENEFIT_WORDS))
    assert got == [["주유+차량정비", "제휴/PLCC"], []]


def test_centroid(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    far = [(10.0, 0.0), (11.0, 0.0), (11.0, 1.0), (10.0, 1.0), (10.0, 0.0)]
    df = spark.createDataFrame([([square],), ([square, far],), ([[(1.0, 1.0), (1.0, 1.0)]],)], "r array<array<struct<lon: double, lat: double>>>")
    rows = [r.c for r in df.select(geometry.centroid("r").alias("c")).collect()]
    assert (rows[0].lon, rows[0].lat) == (1.0, 1.0)
    assert (round(rows[1].lon, 6), round(rows[1].lat, 6)) == (round((4 * 1 + 10.5) / 5, 6), round((4 * 1 + 0.5) / 5, 6))
    assert rows[2].lon is None

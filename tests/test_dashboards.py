"""Business flows on hand-made rows of the business tables."""

import datetime
import json

from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions.labels import SURVEY_ANSWERS
from tidemark.operators import dashboards

DAY = datetime.date


def test_economic_table(spark):
    rows = [(DAY(2024, 1, 1), 5.0, 100.0, None), (DAY(2024, 2, 1), 5.5, 100.0, None), (DAY(2024, 3, 1), 5.5, None, None)]
    wide = spark.createDataFrame(rows, "date date, FFTR double, GDP double, `Core CPI` double")
    got = [tuple(r) for r in dashboards.economic_table(wide).collect()]
    assert got == [
        ("연방기금금리", "5.50%", "5.00%", "FOMC 정례회의 후 (연 8회)", "★★★"),
        ("근원 소비자물가지수", "N/A", "N/A", "CPI와 동시 발표", "★★★"),
        ("국내총생산", "$100.00B", "N/A", "매달 마지막 주", "★★★"),
    ]


def card_rows(spark):
    def row(area, kind, holder, way, month, value):
        return (area, kind, holder, way, *[value * (i + 1) for i in range(8)], month)

    columns = ", ".join([f"`{c}` string" for c in fixed.CARD_KEYS] + [f"`{c}` double" for c in fixed.CARD_ISSUERS] + [f"`{fixed.CARD_MONTH}` date"])
    return spark.createDataFrame([
        row("국내이용금액 ", "신용카드", "개인", "일시불", DAY(2024, 2, 1), 1e6),
        row("국내이용금액 ", "신용카드", "개인", "할부", DAY(2024, 2, 1), 2e6),
        row("해외이용금액", "직불/체크카드", "법인", "일시불", DAY(2024, 2, 1), 0.0),
        row("국내이용금액 ", "신용카드", "개인", "일시불", DAY(2024, 1, 1), 9e6),
    ], columns)


def test_cards(spark):
    sales = card_rows(spark)
    matrix = {r.category: r for r in dashboards.card_matrix(sales).collect()}
    assert len(matrix) == 8 and matrix["국내 신용(개인)"]["롯데카드"] == 3.0 and matrix["국내 신용(개인)"]["KB국민카드"] == 24.0
    assert matrix["해외 신용(개인)"]["삼성카드"] == 0.0
    totals = dashboards.card_totals(sales).first()
    assert totals["롯데카드"] == 3.0 and round(totals.axis_bound, 6) == 26.4
    paths = {r["결제 방법"]: r.shown for r in dashboards.card_paths(sales, fixed.CARD_ISSUERS[4]).collect()}
    assert paths == {"일시불": "5.0M", "할부": "10.0M"}


def test_survey(spark):
    columns = ", ".join(["SEXDSTN_FLAG_CD string", "AGRDE_FLAG_NM string"] + [f"{c} string" for c in fixed.SURVEY_REGIONS])
    survey = spark.createDataFrame([("M", "20대", *[SURVEY_ANSWERS[4]] * 12), ("F", "20대", *[SURVEY_ANSWERS[0]] * 11, None)], columns)
    rows = {(r.region, r.answer, r.SEXDSTN_FLAG_CD, r.AGRDE_FLAG_NM): (r.n, r.answer_rank) for r in dashboards.interest_facets(survey).collect()}
    assert rows[("중국", SURVEY_ANSWERS[4], "ALL", "20대")] == (1, 5)
    assert rows[("아프리카", None, "F", "ALL")] == (1, None)
    assert sum(n for (_, _, s, a), (n, _) in rows.items() if s == a == "ALL") == 24


def test_destinations(spark):
    trend = spark.createDataFrame([(f"c{i}", f"2024-0{m}", float(i)) for i in range(6) for m in (1, 2)], "country string, date string, ratio double")
    spread = spark.createDataFrame([(f"c{i}", float((i * 7) % 5)) for i in range(6)], "country string, trend_cv double")
    rows = dashboards.volatile_destinations(trend, spread, 4, 2).collect()
    best = sorted((2, 3, 4, 5), key=lambda i: (-((i * 7) % 5), i))[:2]
    assert sorted({r.country for r in rows}) == sorted(f"c{i}" for i in best) and len(rows) == 4


def test_price_pairs(spark):
    kind = "series string, period date, value double"
    pce = spark.createDataFrame([("식료품", DAY(2024, 1, 1), 1.0), ("기타", DAY(2024, 1, 1), 5.0)], kind)
    cpi = spark.createDataFrame([("01 식료품 및 비주류음료", DAY(2024, 1, 1), 2.0), ("01 식료품 및 비주류음료", DAY(2024, 2, 1), 3.0)], kind)
    assert [(r.series, r.pce, r.cpi) for r in dashboards.price_pairs(pce, cpi).collect()] == [("식료품", 1.0, 2.0)]


def test_warnings_and_sources(spark):
    countries = spark.createDataFrame([("가",), ("나",), ("다",)], "name string")
    flags = spark.createDataFrame([("가", False, True, False, True, False), ("나", False, False, False, False, True)],
                                  "name string, `여행금지` boolean, `출국권고` boolean, `여행자제` boolean, `여행유의` boolean, `특별여행주의보` boolean")
    rows = {r.name: r.warning for r in dashboards.travel_warnings(countries, flags, "name").collect()}
    assert rows == {"가": "3단계 (출국권고)", "나": "특별여행주의보", "다": "정보 없음"}
    tagged = spark.createDataFrame([("REAL",), ("OTHER",)], "source string")
    assert [r.source_name for r in dashboards.named_sources(tagged).collect()] == ["실제값", "OTHER"]


def test_trend_cards(spark):
    links = json.dumps([f"u{i}" for i in range(7)])
    rows = spark.createDataFrame([(100, "2024-01-02", 9.0, 9.0, links), (100, "2024-01-01", 1.234, 2.0, links), (999, "2024-01-01", 1.0, 1.0, links)],
                                 "category_id int, date string, predicted_trend double, today_trend double, urls string")
    got = dashboards.trend_cards(rows).collect()
    assert [(r.category, r.predicted_trend, r.lag, r.urls) for r in got] == [("정치", 1.23, 129, ["u0", "u1", "u2", "u3", "u4"])]


def test_current_notices(spark):
    rows = spark.createDataFrame([(DAY(2024, 1, d), DAY(2024, 1, d + 5), f"t{d}", "s", "u") for d in range(1, 9)],
                                 "start_date date, end_date date, title string, summary string, URL string")
    got = dashboards.current_notices(rows, F.lit("2024-01-07").cast("date"), 3).collect()
    assert [r.title for r in got] == ["t7", "t6", "t5"]

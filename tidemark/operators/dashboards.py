"""The result tables of the business flows, on the business tables' own columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed, labels, numbers
from tidemark.operators import aggregates, ranking, series


def economic_table(wide: DataFrame, indicators: dict = fixed.INDICATORS) -> DataFrame:
    """``indicator, current, previous, release, importance`` from one row per date and a column per indicator.

    Long form and two ``max_by`` rounds, not two windows per column over the whole table; an
    indicator without any value is shown as ``N/A``.
    """
    present = [name for name in indicators if name in wide.columns]
    columns = [F.col(f"`{name}`").cast("double").alias(name) for name in present]
    long = wide.filter(F.col("date").isNotNull()).select("date", *columns).unpivot(["date"], present, "series", "value")
    rows = series.latest_and_previous(long.withColumnRenamed("date", "period"))
    listed = F.explode(F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("name", "shown", "release", "importance"), (name, *indicators[name]))])
                                 for name in present])).alias("i")
    every = wide.sparkSession.range(1).select(listed).select("i.*")
    table = every.join(rows, F.col("name") == F.col("series"), "left")
    return table.select(
        F.col("shown").alias("indicator"), numbers.indicator_text("name", "latest").alias("current"),
        numbers.indicator_text("name", "previous").alias("previous"), "release", "importance",
    ).orderBy(F.length("importance").desc(), F.col("indicator").desc())


def card_matrix(card_sales: DataFrame) -> DataFrame:
    """Eight usage rows by eight issuers in millions, for the newest month; one pass."""
    latest = aggregates.latest_period(card_sales, fixed.CARD_MONTH)
    area, kind, holder = (F.col(f"`{c}`") for c in fixed.CARD_KEYS[:3])
    rows = {name: (area == a) & (kind == k) & (holder == h) for name, (a, k, h) in fixed.CARD_ROWS.items()}
    return aggregates.condition_matrix(latest, rows, list(fixed.CARD_ISSUERS))


def card_totals(card_sales: DataFrame) -> DataFrame:
    """Issuer totals of the newest month in millions and the axis bound."""
    return aggregates.column_totals(aggregates.latest_period(card_sales, fixed.CARD_MONTH), list(fixed.CARD_ISSUERS))


def card_paths(card_sales: DataFrame, issuer: str) -> DataFrame:
    """Positive sums of one issuer along the four keys for the newest month, with display text."""
    latest = aggregates.latest_period(card_sales, fixed.CARD_MONTH)
    sums = aggregates.group_sum_positive(latest, list(fixed.CARD_KEYS), issuer)
    return sums.withColumn("shown", numbers.millions_text(F.col("total")))


def interest_facets(survey: DataFrame, sex: str = "SEXDSTN_FLAG_CD", age: str = "AGRDE_FLAG_NM") -> DataFrame:
    """Answer counts per region for every sex or all and every age or all; answers by their rank."""
    renamed = survey.withColumnsRenamed(fixed.SURVEY_REGIONS)
    long = renamed.unpivot([sex, age], list(fixed.SURVEY_REGIONS.values()), "region", "answer")
    counts = aggregates.facet_counts(long, [sex, age], ["region", "answer"])
    return counts.withColumn("answer_rank", labels.ordinal("answer"))


def volatile_destinations(trend: DataFrame, volatility: DataFrame, first: int = 30, second: int = 10) -> DataFrame:
    """Trend rows of the ``second`` most volatile countries among the ``first`` by mean ratio."""
    means = trend.groupBy("country").agg(F.avg("ratio").alias("mean"))
    wanted = means.orderBy(F.col("mean").desc_nulls_last(), "country").limit(first)
    spread = volatility.join(wanted, "country", "left_semi")
    chosen = spread.orderBy(F.col("trend_cv").desc_nulls_last(), "country").limit(second)
    return trend.join(chosen, "country", "left_semi")


def price_pairs(spending: DataFrame, prices: DataFrame) -> DataFrame:
    """Spending and price series of each of the eleven categories, joined on the period."""
    return series.category_pairs(spending, prices, fixed.PRICE_CATEGORIES, ("pce", "cpi"))


def travel_warnings(countries: DataFrame, flags: DataFrame, name: str) -> DataFrame:
    """Every country with its severest warning; one without flags, or with none set, has no information."""
    columns = [c for c, _ in fixed.WARNINGS]
    joined = countries.join(flags.select(name, *columns), name, "left").na.fill(False, columns)
    return joined.withColumn("warning", labels.priority_by_flag(fixed.WARNINGS, fixed.NO_WARNING))


def named_sources(forecast: DataFrame) -> DataFrame:
    """Forecast rows with the shown name of their source; an unknown source keeps its tag."""
    return forecast.withColumn("source_name", labels.code_label("source", fixed.SOURCE_NAMES, keep_unknown=True))


def trend_cards(predictions: DataFrame, order: str = "date") -> DataFrame:
    """One row per news category with rounded trends, its look-back and the first five links."""
    names, lags = ({k: v for k, v in m.items()} for m in (fixed.NEWS_CATEGORIES, fixed.NEWS_LAGS))
    known = predictions.filter(F.col("category_id").isin(*names))
    first = ranking.first_per_category(known, "category_id", order, ["predicted_trend", "today_trend", "urls"])
    links = F.slice(F.from_json("urls", "array<string>"), 1, 5)
    return first.select(
        "category_id", labels.code_label("category_id", names).alias("category"),
        F.round("predicted_trend", 2).alias("predicted_trend"), F.round("today_trend", 2).alias("today_trend"),
        labels.code_label("category_id", lags).alias("lag"), links.alias("urls"))


def current_notices(notices: DataFrame, instant, count: int = 30) -> DataFrame:
    """The newest notices in force at an instant."""
    active = series.active_at(notices, "start_date", "end_date", instant)
    rows = ranking.newest(active, [F.col("start_date").desc(), F.col("title"), F.col("URL")], count)
    return rows.select("start_date", "end_date", "title", "summary", "URL")

"""Forecasts and fitted models."""

from pyspark.sql import functions as F

from tidemark.operators import forecasts, models, series
from tidemark.plans import query
from tidemark.plans.joins import EVENT_TYPES, daily

# Two lags, so that SQL can state the least-squares solution in closed form.
LAGS = 2
FIT = """
d AS (SELECT event_type AS series, CAST(ts AS DATE) AS period, avg(value) AS y FROM events GROUP BY ALL),
w AS (SELECT *, lag(y, 1) OVER k AS p1, lag(y, 2) OVER k AS p2, lead(1) OVER k AS more FROM d WINDOW k AS (PARTITION BY series ORDER BY period)),
g AS (SELECT series, avg(y) AS my, avg(p1) AS m1, avg(p2) AS m2, var_pop(p1) AS v1, var_pop(p2) AS v2,
        covar_pop(p1, p2) AS c12, covar_pop(p1, y) AS c1, covar_pop(p2, y) AS c2 FROM w WHERE p2 IS NOT NULL GROUP BY series),
s AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM g),
b AS (SELECT series, my - b1 * m1 - b2 * m2 AS b0, b1, b2 FROM s)"""
FUTURE = FIT + """,
n AS (SELECT series, max(period) AS last, arg_max(y, period) AS y1, arg_max(p1, period) AS y2 FROM w GROUP BY series),
r AS (SELECT series, 1 AS step, b0 + b1 * y1 + b2 * y2 AS y, y1 AS before FROM n JOIN b USING (series)
      UNION ALL SELECT r.series, step + 1, b0 + b1 * r.y + b2 * r.before, r.y FROM r JOIN b ON b.series = r.series WHERE step < 30)"""


BOUNDS = """
WITH m AS (SELECT {series} AS series, date_trunc('month', l_shipdate)::DATE AS period, sum(l_quantity) AS value FROM lineitem GROUP BY ALL),
x AS (SELECT *, year(period) * 12 + month(period) AS x FROM m),
t AS (SELECT series, regr_slope(value, x) AS b, regr_intercept(value, x) AS a, max(period) AS last FROM x GROUP BY series),
f AS (SELECT x.series, period, value, a + b * x AS line, month(period) AS moy FROM x JOIN t USING (series)),
s AS (SELECT series, moy, avg(value - line) AS season FROM f GROUP BY ALL),
h AS (SELECT f.series, period, value, line + season AS pred FROM f JOIN s USING (series, moy)),
d AS (SELECT series, stddev_pop(value - pred) AS sd FROM h GROUP BY series),
u AS (SELECT series, (last + to_months(k::INT))::DATE AS period, a, b FROM t, (SELECT unnest([1, 2, 3]) AS k)),
n AS (SELECT u.series, period, NULL::DOUBLE AS value, a + b * (year(period) * 12 + month(period)) + coalesce(season, 0) AS pred
      FROM u LEFT JOIN s ON s.series = u.series AND s.moy = month(period))"""


@query("forecast_bounds", oracle=BOUNDS.format(series="l_returnflag || l_linestatus") + """
SELECT series, CAST(period AS VARCHAR) AS period, round(pred, 3) AS pred, round(pred - 1.2815515655446004 * sd, 3) AS lower,
  round(pred + 1.2815515655446004 * sd, 3) AS upper, value IS NULL AS future
FROM (SELECT * FROM h UNION ALL SELECT * FROM n) JOIN d USING (series)""")
def forecast_bounds(t):
    rows = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("flags"), "l_shipdate", "l_quantity")
    bounds = forecasts.forecast_bounds(forecasts.monthly_series(rows, "flags", "l_shipdate", "l_quantity"))
    return bounds.select("series", F.col("period").cast("string").alias("period"), *[F.round(c, 3).alias(c) for c in ("pred", "lower", "upper")],
                         F.col("value").isNull().alias("future"))


@query("forecast_table_wide", oracle=BOUNDS.format(series="l_returnflag") + """,
z AS (SELECT period, series AS f, pred, sd FROM (SELECT * FROM h UNION ALL SELECT * FROM n) JOIN d USING (series))
SELECT CAST(period AS VARCHAR) AS period, """ + ", ".join(
    f"round(max(pred) FILTER (f = '{f}'), 3) AS {f}_pred, round(max(pred - 1.2815515655446004 * sd) FILTER (f = '{f}'), 3) AS {f}_lower, round(max(pred + 1.2815515655446004 * sd) FILTER (f = '{f}'), 3) AS {f}_upper" for f in "ANR") + """
FROM z GROUP BY period""")
def forecast_table_wide(t):
    """The forecasts of all series, known months and the three to come, merged on the month into one wide table."""
    rows = forecasts.forecast_bounds(forecasts.monthly_series(t.lineitem, "l_returnflag", "l_shipdate", "l_quantity"))
    wide = rows.groupBy("period").pivot("series", ["A", "N", "R"]).agg(*(F.round(F.max(c), 3).alias(c) for c in ("pred", "lower", "upper")))
    return wide.withColumn("period", F.col("period").cast("string")).orderBy("period")


@query("lag_model_fit", oracle=f"""
WITH {FIT} SELECT series, t AS term, round(CASE t WHEN 0 THEN b0 WHEN 1 THEN b1 ELSE b2 END, 6) AS weight FROM b, (SELECT unnest([0, 1, 2]) AS t)""")
def lag_model_fit(t):
    return forecasts.lag_model(daily(t), LAGS).withColumn("weight", F.round("weight", 6))


@query("recursive_forecast", oracle=f"""
WITH RECURSIVE {FUTURE} SELECT r.series, CAST(last + step AS VARCHAR) AS period, step, round(y, 6) AS predicted FROM r JOIN n ON n.series = r.series""")
def recursive_forecast(t):
    rows = forecasts.recursive_forecast(daily(t), LAGS, 30)
    return rows.select("series", F.col("period").cast("string").alias("period"), "step", F.round("predicted", 6).alias("predicted"))


@query("forecast_tagged", oracle=f"""
WITH RECURSIVE {FUTURE},
u AS (SELECT series, period, 'REAL' AS source, y AS v FROM w WHERE p2 IS NOT NULL AND more = 1
      UNION ALL SELECT w.series, period, 'PREDICTION', b0 + b1 * p1 + b2 * p2 FROM w JOIN b ON b.series = w.series WHERE p2 IS NOT NULL AND more = 1
      UNION ALL SELECT r.series, last + step, 'FUTURE', r.y FROM r JOIN n ON n.series = r.series)
SELECT CAST(period AS VARCHAR) AS period, source, {', '.join(f"round(avg(v) FILTER (series = '{e}'), 6) AS {e}" for e in EVENT_TYPES)}
FROM u GROUP BY ALL""")
def forecast_tagged(t):
    table = forecasts.tagged_forecast(daily(t), LAGS, 30, EVENT_TYPES)
    return table.select(F.col("period").cast("string").alias("period"), "source", *[F.round(e, 6).alias(e) for e in EVENT_TYPES])


@query("topics")
def topics(t):
    return models.topics(t.wide("documents"), "text").withColumn("weight", F.round("weight", 6))


@query("text_label")
def text_label(t):
    return models.label_texts(t.wide("documents"), t.labels, "doc_id", "text", "quality", {0: "negative", 1: "positive"}).withColumn("score", F.round("score", 4))


@query("category_prediction", oracle="""
WITH d AS (SELECT event_type AS category, CAST(ts AS DATE) AS period, avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS a, avg(value) AS v FROM events GROUP BY ALL),
n AS (SELECT *, lead(v) OVER (PARTITION BY category ORDER BY period) AS y FROM d),
m AS (SELECT category, avg(a) AS a, avg(v) AS v FROM d GROUP BY category),
g AS (SELECT avg(y) AS my, avg(a) AS m1, avg(v) AS m2, var_pop(a) AS v1, var_pop(v) AS v2, covar_pop(a, v) AS c12,
        covar_pop(a, y) AS c1, covar_pop(v, y) AS c2 FROM n WHERE y IS NOT NULL),
s AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1, (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM g),
l(category) AS (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('refund'))
SELECT l.category, round(my + b1 * (m.a - m1) + b2 * (m.v - m2), 4) AS predicted_trend, round(m.v, 4) AS today_trend,
  CASE WHEN m.category IS NULL THEN 'No data for category ' || l.category END AS error FROM l LEFT JOIN m USING (category), s""")
def category_prediction(t):
    k = F.get_json_object("props", "$.k").cast("double")
    rows = t.events.groupBy(F.col("event_type").alias("category"), F.to_date("ts").alias("period")).agg(
        F.avg(k).alias("sentiment"), F.avg("value").alias("trend"))
    table = models.predict_categories(rows, [*EVENT_TYPES, "refund"], "sentiment", "trend")
    return table.select("category", F.round("predicted_trend", 4).alias("predicted_trend"), F.round("today_trend", 4).alias("today_trend"), "error")

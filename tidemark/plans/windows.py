"""Operators on dated series: fills, changes, windows, splits."""

from pyspark.sql import functions as F

from tidemark.functions import numbers
from tidemark.operators import keywords, ranking, scaling, series
from tidemark.plans import query
from tidemark.plans.joins import TOKENS, TOP_WORDS, daily

# Daily means of large values only: many days of a series have none and stay null.
GAPPED = "d AS (SELECT event_type AS series, CAST(ts AS DATE) AS period, avg(value) FILTER (value > 200) AS value FROM events GROUP BY ALL)"
DAILY = "d AS (SELECT event_type AS series, CAST(ts AS DATE) AS period, avg(value) AS value FROM events GROUP BY ALL)"
PAST = "OVER (PARTITION BY series ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
AHEAD = "OVER (PARTITION BY series ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def gapped(t):
    return daily(t, F.when(F.col("value") > 200, F.col("value")))


def shown(df, *columns):
    return df.select("series", F.col("period").cast("string").alias("period"), *[F.round(c, 8).alias(c) for c in columns])


@query("forward_fill", oracle=f"""
WITH {GAPPED} SELECT series, CAST(period AS VARCHAR) AS period, round(value, 8) AS value,
  round(last_value(value IGNORE NULLS) {PAST}, 8) AS filled FROM d""")
def forward_fill(t):
    return shown(series.forward_fill(gapped(t)), "value", "filled")


# Raw events as one long series per type: nearly every stamp is its own row.
RAW = "d AS (SELECT event_id, event_type AS series, ts, CASE WHEN value > 100 THEN value END AS value FROM events)"


@query("forward_fill_raw", oracle=f"""
WITH {RAW} SELECT event_id, series, value, last_value(value IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM d""")
def forward_fill_raw(t):
    return series.forward_fill(_raw(t), spread=True).select("event_id", "series", "value", "filled")


def _raw(t):
    value = F.when(F.col("value") > 100, F.col("value"))
    return t.events.select("event_id", F.col("event_type").alias("series"), F.struct("ts", "event_id").alias("period"), value.alias("value"))


RAW_PAST = "OVER (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
RAW_AHEAD = "OVER (PARTITION BY series ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@query("fill_both_raw", oracle=f"""
WITH {RAW} SELECT event_id, coalesce(last_value(value IGNORE NULLS) {RAW_PAST}, first_value(value IGNORE NULLS) {RAW_AHEAD}) AS filled FROM d""")
def fill_both_raw(t):
    return series.fill_both(_raw(t), spread=True).select("event_id", "filled")


@query("fill_mean_raw", oracle=f"""
WITH {RAW} SELECT event_id, round((last_value(value IGNORE NULLS) {RAW_PAST} + first_value(value IGNORE NULLS) {RAW_AHEAD}) / 2, 8) AS filled FROM d""")
def fill_mean_raw(t):
    return series.fill_mean(_raw(t), spread=True).select("event_id", F.round("filled", 8).alias("filled"))


@query("fill_both", oracle=f"""
WITH {GAPPED} SELECT series, CAST(period AS VARCHAR) AS period,
  round(coalesce(last_value(value IGNORE NULLS) {PAST}, first_value(value IGNORE NULLS) {AHEAD}), 8) AS filled FROM d""")
def fill_both(t):
    return shown(series.fill_both(gapped(t)), "filled")


@query("fill_mean", oracle=f"""
WITH {GAPPED} SELECT series, CAST(period AS VARCHAR) AS period,
  round((last_value(value IGNORE NULLS) {PAST} + first_value(value IGNORE NULLS) {AHEAD}) / 2, 8) AS filled FROM d""")
def fill_mean(t):
    return shown(series.fill_mean(gapped(t)), "filled")


@query("change_direction", oracle=f"""
WITH {DAILY} SELECT series, CAST(period AS VARCHAR) AS period,
  CAST(coalesce(sign(value - lag(value) OVER (PARTITION BY series ORDER BY period)), 0) AS INTEGER) AS direction FROM d""")
def change_direction(t):
    return series.direction(daily(t)).select("series", F.col("period").cast("string").alias("period"), "direction")


BANDS = "d AS (SELECT event_type AS series, CAST(ts AS DATE) AS period, floor(avg(value) / 10) * 10 AS value FROM events GROUP BY ALL)"


@query("previous_run_value", oracle=f"""
WITH {BANDS},
f AS (SELECT *, coalesce(value <> lag(value) OVER (PARTITION BY series ORDER BY period), true)::INT AS start FROM d),
r AS (SELECT *, sum(start) OVER (PARTITION BY series ORDER BY period) AS run FROM f),
v AS (SELECT series, run, max(value) AS value FROM r GROUP BY ALL)
SELECT r.series, CAST(r.period AS VARCHAR) AS period, r.value, CAST(r.run AS BIGINT) AS run, v.value AS previous_run
FROM r LEFT JOIN v ON v.series = r.series AND v.run = r.run - 1""")
def previous_run_value(t):
    banded = daily(t).withColumn("value", F.floor(F.col("value") / 10) * 10.0)
    runs = series.previous_run(banded)
    return runs.select("series", F.col("period").cast("string").alias("period"), "value", F.col("run").cast("bigint").alias("run"), "previous_run")


@query("latest_and_previous", oracle=f"""
WITH {GAPPED},
l AS (SELECT *, first_value(value) OVER (PARTITION BY series ORDER BY CASE WHEN value IS NOT NULL THEN period END DESC NULLS LAST) AS latest FROM d),
p AS (SELECT series, arg_max(value, period) AS previous FROM l WHERE value <> latest GROUP BY series)
SELECT DISTINCT l.series, round(l.latest, 8) AS latest, round(p.previous, 8) AS previous
FROM l LEFT JOIN p USING (series) WHERE l.latest IS NOT NULL""")
def latest_and_previous(t):
    rows = series.latest_and_previous(gapped(t))
    return rows.select("series", F.round("latest", 8).alias("latest"), F.round("previous", 8).alias("previous"))


@query("dedup_latest", oracle="""
SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, round(value, 4) AS value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def dedup_latest(t):
    newest = ranking.latest_per_key(t.events.drop("props"), ["user_id", "event_type"], ["ts", "event_id"])
    return newest.select("event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"), F.round("value", 4).alias("value"))


def _delta(value):
    return f"""
WITH {value},
r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY period DESC) AS k FROM d{{where}})
SELECT a.series, round(a.value, 8) AS current, round(b.value, 8) AS previous, round(a.value - b.value, 8) AS delta
FROM (SELECT * FROM r WHERE k = 1) a LEFT JOIN (SELECT * FROM r WHERE k = 2) b USING (series)"""


def _rounded(df, *columns):
    return df.select("series", *[F.round(c, 8).alias(c) for c in columns])


@query("indicator_delta", oracle=_delta(GAPPED).format(where=" WHERE value IS NOT NULL"))
def indicator_delta(t):
    return _rounded(series.newest_delta(gapped(t)), "current", "previous", "delta")


@query("indicator_delta_with_nulls", oracle=_delta(GAPPED).format(where=""))
def indicator_delta_with_nulls(t):
    return _rounded(series.newest_delta(gapped(t), skip_nulls=False), "current", "previous", "delta")


def _windows(t, boundary):
    rows = series.sliding_windows(daily(t), 7, boundary)
    return rows.select("series", F.col("period").cast("string").alias("period"), F.round("target", 8).alias("target"),
                       F.posexplode("inputs").alias("lag", "input")).withColumn("input", F.round("input", 8))


def _window_sql(last):
    return f"""
WITH {DAILY}, n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY period) AS k, count(*) OVER (PARTITION BY series) AS n FROM d)
SELECT a.series, CAST(a.period AS VARCHAR) AS period, round(a.value, 8) AS target, CAST(b.k - a.k + 7 AS INTEGER) AS lag, round(b.value, 8) AS input
FROM n a JOIN n b ON a.series = b.series AND b.k BETWEEN a.k - 7 AND a.k - 1 WHERE a.k > 7 AND a.k <= a.n - {last}"""


@query("sliding_windows", oracle=_window_sql(0))
def sliding_windows(t):
    return _windows(t, "training")


@query("sliding_windows_evaluation", oracle=_window_sql(1))
def sliding_windows_evaluation(t):
    return _windows(t, "evaluation")


@query("rank_band_words", oracle=f"""
WITH {TOKENS},
c AS (SELECT lang, word, count(*) AS count FROM tok GROUP BY lang, word),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY count, word) - 1 AS k, count(*) OVER (PARTITION BY lang) AS n FROM c)
SELECT lang, word, count, k - (n * 7) // 10 + 1 AS rank FROM r WHERE k >= (n * 7) // 10 AND k < (n * 8) // 10 AND k < (n * 7) // 10 + 15""")
def rank_band_words(t):
    counts = keywords.word_counts(t.wide("documents"), "text", "lang")
    return ranking.rank_band(counts, "lang", "word", "count")


@query("top_words", oracle=f"WITH {TOP_WORDS} SELECT lang, word, n AS count, rank FROM top")
def top_words(t):
    return keywords.top_words(keywords.word_counts(t.wide("documents"), "text", "lang"), "lang", 15)


@query("first_links", oracle=f"""
WITH {TOP_WORDS}, m AS (SELECT DISTINCT tok.lang, tok.word, tok.doc_id FROM tok JOIN top ON tok.lang = top.lang AND tok.word = top.word)
SELECT lang, word, doc_id, row_number() OVER (PARTITION BY lang, word ORDER BY doc_id) AS rank FROM m QUALIFY rank <= 3""")
def first_links(t):
    documents = t.wide("documents")
    top = keywords.top_words(keywords.word_counts(documents, "text", "lang"), "lang", 15)
    matches = keywords.documents_with(documents, "doc_id", "text", "lang", top)
    return keywords.first_documents(matches, "lang", "doc_id", 3).select("lang", "word", "doc_id", "rank")


@query("chrono_split", oracle="""
SELECT event_id, CASE WHEN row_number() OVER w <= (count(*) OVER (PARTITION BY event_type) * 8) // 10 THEN 'train' ELSE 'test' END AS part
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def chrono_split(t):
    return ranking.chronological_split(t.events.select("event_type", "ts", "event_id"), "event_type", ["ts", "event_id"]).select("event_id", "part")


@query("hash_split", oracle="""
SELECT doc_id, CASE WHEN CAST('0x' || substring(md5('42|' || doc_id), 1, 8) AS BIGINT) % 1000000 < 800000 THEN 'train' ELSE 'test' END AS part
FROM documents""")
def hash_split(t):
    return ranking.repeatable_split(t.documents.select("doc_id"), ["doc_id"])


@query("future_spine", oracle="""
WITH l AS (SELECT event_type AS series, max(CAST(ts AS DATE)) AS last FROM events GROUP BY 1)
SELECT series, unit, step, CAST(CASE unit WHEN 'day' THEN last + CAST(step AS INTEGER) WHEN 'month_end' THEN last_day(last + to_months(CAST(step AS INTEGER)))
  ELSE date_trunc('month', last) + to_months(CAST(step AS INTEGER)) END AS DATE)::VARCHAR AS period
FROM l, (SELECT unnest(range(1, 31)) AS step), (VALUES ('day'), ('month_end'), ('month')) u(unit)""")
def future_spine(t):
    rows = daily(t)
    parts = [series.future_spine(rows, 30, unit).select("series", F.lit(unit).alias("unit"), "step", F.col("period").cast("string").alias("period"))
             for unit in ("day", "month_end", "month")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("batch_number", oracle="""
SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // 5 AS batch FROM part""")
def batch_number(t):
    return ranking.batch_numbers(t.part.select("p_partkey"), ["p_partkey"], 5).select("p_partkey", "batch")


@query("min_max_scale", oracle=f"""
WITH {DAILY}, b AS (SELECT *, min(value) OVER (PARTITION BY series) AS lo, max(value) OVER (PARTITION BY series) AS hi FROM d)
SELECT series, CAST(period AS VARCHAR) AS period, round(CASE WHEN hi = lo THEN 0 ELSE (value - lo) / (hi - lo) END, 8) AS scaled,
  round(value, 8) AS restored FROM b""")
def min_max_scale(t):
    scaled = scaling.min_max(daily(t)).withColumn("restored", scaling.inverse_min_max())
    return shown(scaled, "scaled", "restored")


ROBUST = f"""
WITH {DAILY}, b AS (SELECT series, min(value) AS lo, quantile_cont(value, 0.6) AS hi FROM d GROUP BY series)
SELECT series, CAST(period AS VARCHAR) AS period, """


@query("robust_scale", oracle=ROBUST + """round(CASE WHEN hi = lo THEN value ELSE (value - lo) / (hi - lo) END, 8) AS scaled
FROM d JOIN b USING (series)""")
def robust_scale(t):
    return shown(scaling.robust(daily(t)), "scaled")


@query("robust_scale_raw", oracle="""
WITH b AS (SELECT l_returnflag AS series, min(l_extendedprice) AS lo, quantile_cont(l_extendedprice::DOUBLE, 0.6) AS hi FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, round(CASE WHEN hi = lo THEN l_extendedprice ELSE (l_extendedprice - lo) / (hi - lo) END, 8) AS scaled
FROM lineitem JOIN b ON series = l_returnflag""")
def robust_scale_raw(t):
    """Every order line scaled by the exact percentile of its flag, found by counting."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("series"), F.col("l_extendedprice").cast("double").alias("value"))
    return scaling.robust_raw(rows).select("l_orderkey", "l_linenumber", F.round("scaled", 8).alias("scaled"))


@query("percentiles_raw", oracle="""
SELECT event_type AS series, p AS fraction, round(quantile_cont(value, [0.0, 0.05, 0.5, 0.95, 1.0])[i], 9) AS quantile
FROM events, (SELECT unnest([0.0, 0.05, 0.5, 0.95, 1.0]) AS p, unnest([1, 2, 3, 4, 5]) AS i) GROUP BY event_type, p, i""")
def percentiles_raw(t):
    made = scaling.quantiles(t.events.select(F.col("event_type").alias("series"), "value"), [0.0, 0.05, 0.5, 0.95, 1.0])
    return made.withColumn("quantile", F.round("quantile", 9))


@query("inverse_scale", oracle=ROBUST + "round(value, 8) AS restored FROM d JOIN b USING (series)")
def inverse_scale(t):
    return shown(scaling.robust(daily(t)).withColumn("restored", scaling.inverse_robust()), "restored")


@query("indicator_table", oracle=f"""
WITH {GAPPED},
f AS (SELECT series, period, last_value(value IGNORE NULLS) {PAST} AS value FROM d),
l AS (SELECT *, first_value(value) OVER (PARTITION BY series ORDER BY CASE WHEN value IS NOT NULL THEN period END DESC NULLS LAST) AS latest FROM f),
p AS (SELECT series, arg_max(value, period) AS previous FROM l WHERE value <> latest GROUP BY series),
r AS (SELECT DISTINCT l.series AS indicator, l.latest, p.previous FROM l LEFT JOIN p USING (series) WHERE l.latest IS NOT NULL),
i AS (SELECT *, CASE indicator WHEN 'click' THEN '***' WHEN 'purchase' THEN '***' WHEN 'view' THEN '**' ELSE '*' END AS importance FROM r)
SELECT indicator, importance,
  CASE indicator WHEN 'click' THEN printf('%.2f%%', latest) WHEN 'purchase' THEN printf('$%.2fB', latest) WHEN 'view' THEN printf('%.2fK', latest) ELSE printf('%.2f', latest) END AS latest,
  coalesce(CASE indicator WHEN 'click' THEN printf('%.2f%%', previous) WHEN 'purchase' THEN printf('$%.2fB', previous) WHEN 'view' THEN printf('%.2fK', previous) ELSE printf('%.2f', previous) END, 'N/A') AS previous,
  round(latest - previous, 8) AS delta FROM i""")
def indicator_table(t):
    """The economic-indicator table: filled series, latest and previous different value, delta, display text."""
    filled = series.forward_fill(gapped(t)).select("series", "period", F.col("filled").alias("value"))
    rows = series.latest_and_previous(filled)
    importance = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for x in ("click", "***", "purchase", "***", "view", "**")]), F.col("series")), F.lit("*"))
    units = (("click",), ("purchase",), ("view",))
    table = rows.select(
        F.col("series").alias("indicator"), importance.alias("importance"),
        numbers.indicator_text("series", "latest", *units).alias("latest"),
        numbers.indicator_text("series", "previous", *units).alias("previous"),
        F.round(F.col("latest") - F.col("previous"), 8).alias("delta"))
    return table.orderBy(F.length("importance").desc(), F.col("indicator").desc())

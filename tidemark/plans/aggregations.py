"""Aggregations."""

from pyspark.sql import functions as F

from tidemark.operators import aggregates, keywords, ranking, reshape, series
from tidemark.plans import query
from tidemark.plans.joins import EVENT_TYPES, daily

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("group_mean", oracle="""
SELECT user_id, round(avg(value), 8) AS mean_value, round(avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)), 8) AS mean_k
FROM events GROUP BY user_id""")
def group_mean(t):
    k = F.get_json_object("props", "$.k").cast("double")
    return t.events.groupBy("user_id").agg(F.round(F.avg("value"), 8).alias("mean_value"), F.round(F.avg(k), 8).alias("mean_k"))


@query("group_sum_positive", oracle="""
SELECT l_returnflag, l_linestatus, l_linenumber, year(l_shipdate) AS year, round(sum(l_extendedprice * (l_discount - 0.05)), 4) AS total
FROM lineitem GROUP BY ALL HAVING sum(l_extendedprice * (l_discount - 0.05)) > 0""")
def group_sum_positive(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", F.year("l_shipdate").alias("year"),
                             (F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("amount"))
    sums = aggregates.group_sum_positive(rows, ["l_returnflag", "l_linestatus", "l_linenumber", "year"], "amount")
    return sums.withColumn("total", F.round("total", 4))


FLAG_ROWS = [(flag, status) for flag in "ANRX" for status in "FO"]


@query("conditional_matrix", oracle=" UNION ALL ".join(f"""
SELECT '{flag}{status}' AS category, {', '.join(f"round(coalesce(sum({m}), 0) / 1e6, 8) AS {m}" for m in MEASURES)}
FROM lineitem WHERE l_returnflag = '{flag}' AND l_linestatus = '{status}'""" for flag, status in FLAG_ROWS))
def conditional_matrix(t):
    rows = {f + s: (F.col("l_returnflag") == f) & (F.col("l_linestatus") == s) for f, s in FLAG_ROWS}
    matrix = aggregates.condition_matrix(t.lineitem, rows, MEASURES)
    return matrix.select("category", *[F.round(m, 8).alias(m) for m in MEASURES])


@query("column_totals", oracle="""
SELECT round(sum(l_quantity) / 1e6, 8) AS l_quantity, round(sum(l_extendedprice) / 1e6, 8) AS l_extendedprice,
  round(sum(l_discount) / 1e6, 8) AS l_discount, round(sum(l_tax) / 1e6, 8) AS l_tax,
  round(greatest(sum(l_quantity), sum(l_extendedprice), sum(l_discount), sum(l_tax)) / 1e6 * 1.1, 8) AS axis_bound FROM lineitem""")
def column_totals(t):
    totals = aggregates.column_totals(t.lineitem, MEASURES)
    return totals.select(*[F.round(c, 8).alias(c) for c in totals.columns])


@query("collect_values", oracle="""
WITH r AS (SELECT c_mktsegment || ' customers' AS segment, c_name, (row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) - 1) // 1000 AS chunk FROM customer)
SELECT segment, chunk, string_agg(c_name, ',' ORDER BY c_name) AS names FROM r GROUP BY segment, chunk""")
def collect_values(t):
    named = t.customer.select(F.concat("c_mktsegment", F.lit(" customers")).alias("segment"), "c_name")
    lists = ranking.list_chunks(named, ["segment"], "c_name", ["c_name"], 1000)
    return lists.select("segment", "chunk", F.array_join("items", ",").alias("names"))


@query("catalog_digest", oracle="""
WITH r AS (SELECT p_brand AS table_name, p_type AS table_description, p_partkey, p_name || ' (' || p_size || '): key ' || p_partkey AS col,
  (row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) - 1) // 1000 AS chunk FROM part)
SELECT table_name, table_description, chunk, string_agg(col, ', ' ORDER BY p_partkey) AS columns FROM r GROUP BY table_name, table_description, chunk""")
def catalog_digest(t):
    described = t.part.select(F.col("p_brand").alias("table_name"), F.col("p_type").alias("table_description"), "p_partkey",
                              F.format_string("%s (%d): key %d", "p_name", "p_size", "p_partkey").alias("column"))
    lists = ranking.list_chunks(described, ["table_name", "table_description"], "column", ["p_partkey"], 1000)
    return lists.select("table_name", "table_description", "chunk", F.array_join("items", ", ").alias("columns"))


@query("word_count", oracle="""
SELECT word, count(*) AS count FROM (
  SELECT unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 1)) AS word FROM documents)
GROUP BY word""")
def word_count(t):
    return keywords.word_counts(t.wide("documents"), "text")


@query("max_or_default", oracle="""
SELECT 'orders' AS source, max(year(o_orderdate)) AS mark FROM orders
UNION ALL SELECT 'none', coalesce(max(year(o_orderdate)), 2016) FROM orders WHERE o_orderstatus = 'missing'""")
def max_or_default(t):
    none = t.orders.filter(F.col("o_orderstatus") == "missing")
    parts = [aggregates.max_or_default(df, F.year("o_orderdate"), 2016).select(F.lit(name).alias("source"), "mark")
             for name, df in (("orders", t.orders), ("none", none))]
    return parts[0].unionByName(parts[1])


@query("latest_period_rows", oracle="""
SELECT o_orderkey, o_totalprice FROM orders
WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)""")
def latest_period_rows(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "MM").alias("month"))
    return aggregates.latest_period(rows, "month").drop("month")


@query("distinct_per_group", oracle="SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem WHERE l_suppkey IS NOT NULL")
def distinct_per_group(t):
    return aggregates.distinct_per_group(t.lineitem, "l_suppkey", "l_returnflag")


def _wide(statistic):
    cells = ", ".join(f"round({statistic}(value) FILTER (event_type = '{e}'), 8) AS {e}" for e in EVENT_TYPES)
    return f"SELECT strftime(ts, '%Y-%m-%d') AS day, {cells} FROM events GROUP BY 1"


def _pivoted(t, statistic):
    rows = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    wide = reshape.pivot(rows, ["day"], "event_type", EVENT_TYPES, "value", statistic)
    return wide.select("day", *[F.round(e, 8).alias(e) for e in EVENT_TYPES])


@query("pivot_mean", oracle=_wide("avg"))
def pivot_mean(t):
    return _pivoted(t, "avg")


@query("pivot_max", oracle=_wide("max"))
def pivot_max(t):
    return _pivoted(t, "max")


@query("row_mean", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, round((coalesce(nullif(l_discount, 0), 0) + coalesce(nullif(l_tax, 0), 0) + l_quantity)
  / (1 + (l_discount <> 0)::INT + (l_tax <> 0)::INT), 8) AS mean FROM lineitem""")
def row_mean(t):
    from tidemark.functions.numbers import row_mean as mean
    cells = [F.nullif("l_discount", F.lit(0.0)), F.nullif("l_tax", F.lit(0.0)), F.col("l_quantity")]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.round(mean(cells), 8).alias("mean"))


@query("consolidate_sparse", oracle="""
SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN value > 50 THEN 'HIGH' ELSE 'LOW' END AS source,
  round(avg(value) FILTER (event_type = 'click'), 8) AS click, round(avg(value) FILTER (event_type = 'view'), 8) AS view
FROM events GROUP BY 1, 2""")
def consolidate_sparse(t):
    source = F.when(F.col("value") > 50, "HIGH").otherwise("LOW").alias("source")
    sparse = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), source,
                             *[F.when(F.col("event_type") == e, F.col("value")).alias(e) for e in ("click", "view")])
    folded = aggregates.consolidate(sparse, ["day", "source"], ["click", "view"])
    return folded.select("day", "source", F.round("click", 8).alias("click"), F.round("view", 8).alias("view"))


USER_STEPS = """
d AS (SELECT user_id AS series, CAST(ts AS DATE) AS period, avg(CASE WHEN value < 2 THEN 0 ELSE value END) AS v FROM events GROUP BY ALL),
p AS (SELECT series, v, lag(v) OVER (PARTITION BY series ORDER BY period) AS prev FROM d),
s AS (SELECT series, CASE WHEN prev <> 0 THEN (v - prev) / prev * 100 ELSE 0 END AS g,
             CASE WHEN prev <> 0 THEN v / prev ELSE 1 END AS r FROM p WHERE prev IS NOT NULL),
a AS (SELECT DISTINCT series FROM d)"""


def _user_trend(t):
    value = F.when(F.col("value") < 2, 0.0).otherwise(F.col("value"))
    return series.trend_statistics(series.daily_series(t.events, "user_id", "ts", value))


@query("trend_growth", oracle=f"""
WITH {USER_STEPS} SELECT a.series, round(coalesce(avg(g), 0), 4) AS trend_growth FROM a LEFT JOIN s USING (series) GROUP BY 1""")
def trend_growth(t):
    return _user_trend(t).select("series", F.round("trend_growth", 4).alias("trend_growth"))


@query("trend_variance", oracle=f"""
WITH {USER_STEPS} SELECT a.series, round(coalesce(var_pop(r), 0), 4) AS trend_var FROM a LEFT JOIN s USING (series) GROUP BY 1""")
def trend_variance(t):
    return _user_trend(t).select("series", F.round("trend_var", 4).alias("trend_var"))


@query("trend_cv", oracle=f"""
WITH {USER_STEPS}
SELECT a.series, round(coalesce(CASE WHEN avg(r) <> 0 THEN stddev_pop(r) / avg(r) END, 0), 8) AS trend_cv
FROM a LEFT JOIN s USING (series) GROUP BY 1""")
def trend_cv(t):
    return _user_trend(t).select("series", F.round("trend_cv", 8).alias("trend_cv"))


@query("rollup_path", oracle="""
SELECT l_returnflag, l_linestatus, ship_year, l_linenumber, round(sum(l_extendedprice), 2) AS total,
  4 - grouping(l_returnflag) - grouping(l_linestatus) - grouping(ship_year) - grouping(l_linenumber) AS level
FROM (SELECT *, year(l_shipdate) AS ship_year FROM lineitem)
GROUP BY ROLLUP (l_returnflag, l_linestatus, ship_year, l_linenumber)""")
def rollup_path(t):
    rows = t.lineitem.withColumn("ship_year", F.year("l_shipdate"))
    totals = aggregates.path_totals(rows, ["l_returnflag", "l_linestatus", "ship_year", "l_linenumber"], "l_extendedprice")
    return totals.withColumn("total", F.round("total", 2))


@query("facet_cube", oracle="""
WITH m AS (SELECT c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation, region, answer FROM customer,
  LATERAL (SELECT 'balance' AS region, CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS answer
           UNION ALL SELECT 'parity', CASE WHEN c_custkey % 3 = 0 THEN 'low' ELSE 'high' END) x)
SELECT region, answer, CASE WHEN grouping(segment) = 1 THEN 'ALL' ELSE segment END AS segment,
  CASE WHEN grouping(nation) = 1 THEN 'ALL' ELSE nation END AS nation, count(*) AS n
FROM m GROUP BY GROUPING SETS ((region, answer), (region, answer, segment), (region, answer, nation), (region, answer, segment, nation))""")
def facet_cube(t):
    balance = F.when(F.col("c_acctbal") < 0, "low").when(F.col("c_acctbal") < 5000, "mid").otherwise("high")
    parity = F.when(F.col("c_custkey") % 3 == 0, "low").otherwise("high")
    wide = t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"),
                             balance.alias("balance"), parity.alias("parity"))
    long = reshape.unpivot(wide, ["segment", "nation"], ["balance", "parity"], "region", "answer")
    return aggregates.facet_counts(long, ["segment", "nation"], ["region", "answer"])


@query("session_summary", oracle="""
SELECT conv_id, max(turn) AS last_turn, md5(arg_max(text, turn)) AS last_text, count(*) AS messages FROM conversations GROUP BY conv_id""")
def session_summary(t):
    grouped = t.conversations.groupBy("conv_id").agg(
        F.max("turn").alias("last_turn"), F.md5(F.max_by("text", "turn")).alias("last_text"), F.count(F.lit(1)).alias("messages"))
    return grouped.orderBy(F.col("last_turn").desc(), "conv_id")


@query("regression_metrics", oracle="""
SELECT l_returnflag, count(*) AS n, round(avg(power(l_extendedprice - l_quantity * 1500, 2)), 2) AS mse,
  round(1 - sum(power(l_extendedprice - l_quantity * 1500, 2)) / sum(power(l_extendedprice - m, 2)), 8) AS r2
FROM (SELECT *, avg(l_extendedprice) OVER (PARTITION BY l_returnflag) AS m FROM lineitem) GROUP BY l_returnflag""")
def regression_metrics(t):
    rows = t.lineitem.withColumn("predicted", F.col("l_quantity") * 1500)
    stats = aggregates.regression_metrics(rows, ["l_returnflag"], "l_extendedprice", "predicted")
    return stats.select("l_returnflag", "n", F.round("mse", 2).alias("mse"), F.round("r2", 8).alias("r2"))


@query("period_mean_or_zero", oracle="""
SELECT user_id, round(coalesce(avg(value) FILTER (CAST(ts AS DATE) = DATE '2024-01-15'), 0), 8) AS mean FROM events GROUP BY user_id""")
def period_mean_or_zero(t):
    that_day = F.to_date("ts") == F.lit("2024-01-15").cast("date")
    return t.events.groupBy("user_id").agg(F.round(aggregates.mean_or_zero("value", that_day), 8).alias("mean"))


def _spend(t):
    joined = t.customer.select("c_custkey", "c_mktsegment").join(
        t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderpriority", "o_totalprice"), "c_custkey")
    names = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}
    return joined.select("c_mktsegment", *[F.when(F.col("o_orderpriority") == p, F.col("o_totalprice")).alias(n) for p, n in names.items()]), list(names.values())


SPEND = """
x AS (SELECT c_mktsegment, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium'
  WHEN '4-NOT SPECIFIED' THEN 'unspecified' ELSE 'low' END AS category, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey)"""


@query("segment_category_profile", oracle=f"""
WITH {SPEND} SELECT c_mktsegment, category, round(avg(o_totalprice), 6) AS amount,
  row_number() OVER (PARTITION BY c_mktsegment ORDER BY avg(o_totalprice) DESC, category) AS rank FROM x GROUP BY c_mktsegment, category QUALIFY rank <= 3""")
def segment_category_profile(t):
    wide, names = _spend(t)
    profile = aggregates.segment_profile(wide, "c_mktsegment", names)
    top = ranking.top_per_key(profile, ["c_mktsegment"], [F.col("amount").desc(), F.col("category")], 3)
    return top.withColumn("amount", F.round("amount", 6))


@query("segment_method_sum", oracle=f"""
WITH {SPEND} SELECT c_mktsegment, category, round(sum(o_totalprice), 2) AS amount FROM x GROUP BY ALL""")
def segment_method_sum(t):
    wide, names = _spend(t)
    return aggregates.segment_profile(wide, "c_mktsegment", names, "sum").withColumn("amount", F.round("amount", 2))

"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from tidemark.functions import dates, labels, numbers
from tidemark.operators import aggregates, ranking, series
from tidemark.plans import query
from tidemark.sources import sinks


@query("rename_map", oracle="""
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS balance FROM supplier""")
def rename_map(t):
    names = {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_acctbal": "balance"}
    return t.supplier.select(*names).withColumnsRenamed(names)


@query("date_strict", oracle="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def date_strict(t):
    packed = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("packed"))
    return packed.select("o_orderkey", dates.date_strict("packed").cast("string").alias("day"))


@query("date_coerce", oracle="""
SELECT doc_id, CASE WHEN doc_id % 28 BETWEEN 1 AND 12 AND n_chars % 28 > 0
  THEN '20' || lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0') || '-' || lpad(CAST(doc_id % 28 AS VARCHAR), 2, '0') || '-'
       || lpad(CAST(n_chars % 28 AS VARCHAR), 2, '0') END AS day FROM documents""")
def date_coerce(t):
    # Month and day come from the numbers of each row, so many of the stamps are no dates.
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    stamp = F.concat(F.lit("20"), two(F.col("doc_id") % 24), F.lit("-"), two(F.col("doc_id") % 28), F.lit("-"), two(F.col("n_chars") % 28))
    return t.documents.select("doc_id", dates.date_coerced(stamp, "yyyy-MM-dd").alias("day"))


@query("month_start", oracle="""
SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders""")
def month_start(t):
    return t.orders.select("o_orderkey", dates.month_start(F.date_format("o_orderdate", "yyyyMM")).cast("string").alias("month"))


@query("numeric_cast", oracle="""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS strict_k,
       TRY_CAST(event_type AS DOUBLE) AS coerced FROM events""")
def numeric_cast(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("strict_k"),
                           numbers.number_or_null("event_type").alias("coerced"))


@query("ampm_parse", oracle="""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') END AS stamp
FROM events""")
def ampm_parse(t):
    half = F.when(F.hour("ts") < 12, "오전").otherwise("오후")
    text = F.concat(F.date_format("ts", "yyyy.MM.dd. "), half, F.date_format("ts", " h:mm"))
    text = F.when(F.col("event_type") == "error", "").otherwise(text)
    return t.events.select("event_id", dates.ampm_stamp(text).alias("stamp"))


@query("rfc822_parse", oracle="""
SELECT event_id, CASE WHEN event_type <> 'view' THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS stamp
FROM events""")
def rfc822_parse(t):
    offset = F.when(F.col("event_type") == "view", " GMT").otherwise(" +0900")
    text = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), offset)
    return t.events.select("event_id", dates.rfc822_stamp(text).alias("stamp"))


@query("quarter_label", oracle="""
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders""")
def quarter_label(t):
    return t.orders.select("o_orderkey", dates.quarter_label("o_orderdate").alias("quarter"),
                           F.trunc("o_orderdate", "MM").cast("string").alias("month"))


@query("fill_default", oracle="""
SELECT d.doc_id, coalesce(CAST(l.quality AS BIGINT), -1) AS quality, coalesce(l.toxic = 1, false) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def fill_default(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    flags = joined.select("doc_id", F.col("quality").cast("bigint").alias("quality"), (F.col("toxic") == 1).alias("toxic"))
    return flags.na.fill({"quality": -1, "toxic": False})


@query("drop_any_null", oracle="""
SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE d.doc_id IS NOT NULL AND d.lang IS NOT NULL AND l.quality IS NOT NULL""")
def drop_any_null(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return joined.na.drop("any")


@query("trailing_5y", oracle="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE CAST(o_orderdate AS DATE) >= CAST((SELECT max(o_orderdate) FROM orders) - INTERVAL 60 MONTH AS DATE)""")
def trailing_5y(t):
    rows = series.trailing_months(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", 60)
    return rows.orderBy("o_orderdate").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("trailing_days", oracle="""
SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 2 DAY""")
def trailing_days(t):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    return series.trailing_days(t.events, "ts", as_of, 2).select("event_id", "event_type")


def _notices(t):
    """Orders as notices that run from the order date for ten to a hundred days by price."""
    days = (F.floor(F.col("o_totalprice") % 91) + 10).cast("int")
    start = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", start.alias("start_date"),
                           F.date_add(start, days).alias("end_date"))


NOTICES = """
notices AS (SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS start_date,
    CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice % 91) + 10 AS INTEGER) AS end_date FROM orders)"""


@query("active_notices", oracle=f"""
WITH {NOTICES}
SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
FROM notices WHERE start_date <= DATE '1998-06-01' AND end_date >= DATE '1998-06-01'
ORDER BY notices.start_date DESC, o_orderkey LIMIT 30""")
def active_notices(t):
    active = series.active_at(_notices(t), "start_date", "end_date", F.lit("1998-06-01").cast("date"))
    rows = ranking.newest(active, [F.col("start_date").desc(), F.col("o_orderkey")], 30)
    return rows.withColumns({c: F.col(c).cast("string") for c in ("start_date", "end_date")})


@query("contained_interval", oracle=f"""
WITH {NOTICES}
SELECT o_orderkey, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date
FROM notices WHERE start_date >= DATE '1998-01-01' AND end_date <= DATE '1998-12-31'
ORDER BY notices.start_date DESC, o_orderkey LIMIT 10""")
def contained_interval(t):
    lower, upper = (F.lit(d).cast("date") for d in ("1998-01-01", "1998-12-31"))
    inside = series.contained_in(_notices(t), "start_date", "end_date", lower, upper)
    rows = ranking.newest(inside, [F.col("start_date").desc(), F.col("o_orderkey")], 10)
    return rows.select("o_orderkey", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date"))


@query("optional_filter", oracle="""
SELECT c_custkey, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 7""")
def optional_filter(t):
    wanted = {"c_mktsegment": "MACHINERY", "c_nationkey": 7, "c_name": None}
    return t.customer.filter(labels.optional_match(wanted)).select("c_custkey", "c_nationkey", "c_mktsegment")


PART_LEVELS = {"PROMO": 4, "LARGE": 3, "MEDIUM": 2, "SMALL": 1}


@query("risk_level", oracle="""
SELECT p_partkey, CASE WHEN contains(p_type, 'PROMO') THEN 4 WHEN contains(p_type, 'LARGE') THEN 3
  WHEN contains(p_type, 'MEDIUM') THEN 2 WHEN contains(p_type, 'SMALL') THEN 1 ELSE 0 END AS level FROM part""")
def risk_level(t):
    return t.part.select("p_partkey", labels.priority_by_substring("p_type", PART_LEVELS).alias("level"))


@query("risk_from_flags", oracle="""
SELECT p_partkey, CASE WHEN p_name LIKE '%red%' THEN 'ban' WHEN p_name LIKE '%hot%' THEN 'special'
  WHEN p_name LIKE '%ring%' THEN 'leave' WHEN p_name LIKE '%bolt%' THEN 'refrain'
  WHEN p_name LIKE '%gear%' THEN 'caution' ELSE 'safe' END AS outcome FROM part""")
def risk_from_flags(t):
    words = {"red": "ban", "hot": "special", "ring": "leave", "bolt": "refrain", "gear": "caution"}
    flags = [(F.col("p_name").contains(word), outcome) for word, outcome in words.items()]
    return t.part.select("p_partkey", labels.priority_by_flag(flags, "safe").alias("outcome"))


@query("flag_expand", oracle="""
SELECT p_partkey, list_contains(string_split(p_name, ' '), 'red') AS is_red,
       list_contains(string_split(p_name, ' '), 'hot') AS is_hot, list_contains(string_split(p_name, ' '), 'ring') AS is_ring
FROM part""")
def flag_expand(t):
    tokens = t.part.select("p_partkey", F.split("p_name", " ").alias("tokens"))
    return labels.flag_columns(tokens, "tokens", {"red": "is_red", "hot": "is_hot", "ring": "is_ring"}).drop("tokens")


@query("code_label", oracle="""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS label,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS label_or_code FROM orders""")
def code_label(t):
    names = {"F": "finished", "O": "open"}
    return t.orders.select("o_orderkey", labels.code_label("o_orderstatus", names).alias("label"),
                           labels.code_label("o_orderstatus", names, keep_unknown=True).alias("label_or_code"))


@query("ordinal_sort", oracle="""
SELECT o_orderpriority, count(*) AS n, max(CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '3-MEDIUM' THEN 2
  WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 END) AS rank FROM orders GROUP BY o_orderpriority""")
def ordinal_sort(t):
    order = ("5-LOW", "3-MEDIUM", "2-HIGH", "1-URGENT")
    counted = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("rank", labels.ordinal("o_orderpriority", order)).orderBy(F.col("rank").asc_nulls_last())


@query("format_millions", oracle="""
SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice) / 1e6, 1) || 'M' AS shown
FROM lineitem GROUP BY ALL""")
def format_millions(t):
    sums = aggregates.group_sum_positive(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return sums.select("l_returnflag", "l_linestatus", numbers.millions_text(F.col("total")).alias("shown"))


@query("format_indicator", oracle="""
SELECT event_id, CASE event_type WHEN 'click' THEN printf('%.2f%%', value) WHEN 'view' THEN printf('$%.2fB', value)
  WHEN 'signup' THEN printf('%.2fK', value) WHEN 'error' THEN 'N/A' ELSE printf('%.2f', value) END AS shown FROM events""")
def format_indicator(t):
    value = F.when(F.col("event_type") != "error", F.col("value"))
    shown = numbers.indicator_text("event_type", value, ("click",), ("view",), ("signup",))
    return t.events.select("event_id", shown.alias("shown"))


@query("combined_score", oracle="""
WITH trend AS (SELECT user_id, max(value) AS trend FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT d.doc_id, round(d.n_chars * (1 + coalesce(t.trend, 0) / 100), 4) AS score
FROM documents d LEFT JOIN trend t ON t.user_id = d.doc_id""")
def combined_score(t):
    bought = t.events.filter(F.col("event_type") == "purchase")
    trend = bought.groupBy(F.col("user_id").alias("doc_id")).agg(F.max("value").alias("trend"))
    joined = t.documents.select("doc_id", "n_chars").join(trend, "doc_id", "left")
    return joined.select("doc_id", F.round(numbers.weighted_score(F.col("n_chars"), F.col("trend")), 4).alias("score"))


@query("clean_money", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price, round(round(l_discount * 100) / 100, 4) AS discount FROM lineitem""")
def clean_money(t):
    shown = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)).alias("money"),
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%")).alias("percent"))
    return shown.select("l_orderkey", "l_linenumber", "l_partkey", numbers.clean_money("money").alias("price"),
                        F.round(numbers.percent_fraction("percent"), 4).alias("discount"))


@query("drop_pii", oracle="SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_pii(t):
    return sinks.drop_sensitive(t.customer, ["C_NAME", "c_acctbal"])


@query("time_of_day", oracle="""
SELECT event_id, strftime(date_trunc('minute', ts), '%H:%M:%S') AS clock, NULL::VARCHAR AS bad FROM events""")
def time_of_day(t):
    return t.events.select("event_id", dates.time_of_day(F.date_format("ts", "HH:mm")).alias("clock"),
                           dates.time_of_day("event_type").alias("bad"))

"""Sorts, limits and top rows."""

from pyspark.sql import functions as F

from tidemark.operators import ranking
from tidemark.plans import query


@query("newest_n", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20""")
def newest_n(t):
    return ranking.newest(t.orders, [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey")], 20).select("o_orderkey", "o_custkey", "o_totalprice")


@query("top_k_per_measure", oracle="""
WITH s AS (SELECT l_suppkey, sum(l_extendedprice) AS price, sum(l_quantity) AS quantity, sum(l_tax) AS tax FROM lineitem GROUP BY 1),
u AS (SELECT l_suppkey, 'price' AS measure, price AS amount FROM s UNION ALL SELECT l_suppkey, 'quantity', quantity FROM s
      UNION ALL SELECT l_suppkey, 'tax', tax FROM s)
SELECT l_suppkey, measure, round(amount, 2) AS amount, row_number() OVER (PARTITION BY measure ORDER BY round(amount, 4) DESC, l_suppkey) AS rank
FROM u QUALIFY rank <= 10""")
def top_k_per_measure(t):
    # Rounded sums: the last bits of a sum depend on the order of addition and would decide ties.
    sums = t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.sum("l_extendedprice"), 4).alias("price"), F.round(F.sum("l_quantity"), 4).alias("quantity"), F.round(F.sum("l_tax"), 4).alias("tax"))
    top = ranking.top_per_measure(sums, "l_suppkey", ["price", "quantity", "tax"], 10)
    return top.withColumn("amount", F.round("amount", 2))


@query("cascade_top_k", oracle="""
WITH s AS (SELECT user_id, round(avg(value), 8) AS m, round(stddev_pop(value) / avg(value), 8) AS cv FROM events GROUP BY 1),
a AS (SELECT * FROM s ORDER BY m DESC, user_id LIMIT 30), b AS (SELECT user_id FROM a ORDER BY cv DESC, user_id LIMIT 10)
SELECT event_id, user_id, value FROM events WHERE user_id IN (SELECT user_id FROM b)""")
def cascade_top_k(t):
    spread = F.round(F.stddev_pop("value") / F.avg("value"), 8)
    return ranking.cascade(t.events, "user_id", "value", spread, 30, 10).select("event_id", "user_id", "value")


@query("importance_sort", oracle="""
SELECT o_orderkey, o_orderpriority, length(o_orderpriority) AS weight FROM orders""")
def importance_sort(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.length("o_orderpriority").alias("weight"))
    return rows.orderBy(F.col("weight").desc(), F.col("o_orderpriority").desc(), F.col("o_orderkey"))


@query("first_per_category", oracle="""
SELECT event_type, arg_min(user_id, event_id) AS user_id, min(event_id) AS event_id, round(arg_min(value, event_id), 4) AS value
FROM events GROUP BY event_type""")
def first_per_category(t):
    rows = ranking.first_per_category(t.events, "event_type", "event_id", ["user_id", "value"])
    return rows.withColumn("value", F.round("value", 4))


@query("paginate", oracle="""
WITH p AS (SELECT p_partkey, p_name, (row_number() OVER (ORDER BY p_partkey) + 4) // 5 AS page FROM part)
SELECT * FROM p WHERE page = least(37, (SELECT max(page) FROM p))""")
def paginate(t):
    return ranking.page(t.part.select("p_partkey", "p_name"), ["p_partkey"], 37, 5)


@query("paginate_past_end", oracle="""
WITH p AS (SELECT s_suppkey, s_name, (row_number() OVER (ORDER BY s_suppkey) + 4) // 5 AS page FROM supplier)
SELECT * FROM p WHERE page = (SELECT max(page) FROM p)""")
def paginate_past_end(t):
    return ranking.page(t.supplier.select("s_suppkey", "s_name"), ["s_suppkey"], 1_000_000_000, 5)

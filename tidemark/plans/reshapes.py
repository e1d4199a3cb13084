"""Set operations and reshaping."""

from pyspark.sql import functions as F

from tidemark.operators import reshape
from tidemark.plans import query
from tidemark.plans.aggregations import MEASURES


@query("union_missing", oracle="""
SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS o_orderpriority, 'REAL' AS source FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, NULL, o_orderpriority, 'FUTURE' FROM orders WHERE o_orderstatus = 'O'""")
def union_missing(t):
    real = t.orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice", F.lit("REAL").alias("source"))
    future = t.orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_orderpriority", F.lit("FUTURE").alias("source"))
    return real.unionByName(future, allowMissingColumns=True)


@query("distinct_rows", oracle="SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus").dropDuplicates()


@query("unpivot_measures", oracle=" UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_partkey, '{m}' AS measure, nullif({m}, 0) AS amount FROM lineitem" for m in MEASURES))
def unpivot_measures(t):
    wide = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *[F.nullif(F.col(m), F.lit(0.0)).alias(m) for m in MEASURES])
    return reshape.unpivot(wide, ["l_orderkey", "l_linenumber", "l_partkey"], MEASURES, "measure", "amount")


@query("transpose_matrix", oracle=" UNION ALL ".join(
    f"SELECT '{m}' AS \"column\", " + ", ".join(f"round(sum({m}) FILTER (l_returnflag = '{f}'), 2) AS {f}" for f in "ANR") + " FROM lineitem" for m in MEASURES))
def transpose_matrix(t):
    matrix = t.lineitem.groupBy("l_returnflag").agg(*[F.round(F.sum(m), 2).alias(m) for m in MEASURES])
    return reshape.transpose(matrix, "l_returnflag", ["A", "N", "R"], MEASURES)


def _ratios(t):
    """Events with ``k`` as a repeatable period per user: the later event of a period wins."""
    rows = t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("period"), F.round("value", 4).alias("ratio"), "event_id")
    return reshape.ratio_map(rows, ["user_id"], "period", "ratio", "event_id")


LAST_RATIO = "SELECT user_id, strftime(ts, '%Y-%m-%d') AS period, round(arg_max(value, event_id), 4) AS ratio FROM events GROUP BY 1, 2"


@query("explode_ratios", oracle=LAST_RATIO)
def explode_ratios(t):
    return reshape.explode_ratios(_ratios(t), ["user_id"])


@query("ratios_map", oracle=f"""
SELECT user_id, count(*) AS periods, string_agg(period, ',' ORDER BY period) AS stamps, round(sum(ratio), 3) AS total, round(arg_max(ratio, period), 4) AS newest
FROM ({LAST_RATIO}) GROUP BY user_id""")
def ratios_map(t):
    rows = _ratios(t)
    values = F.map_values("ratios")
    return rows.select(
        "user_id", F.size("ratios").cast("bigint").alias("periods"), F.array_join(F.map_keys("ratios"), ",").alias("stamps"),
        F.round(F.aggregate(values, F.lit(0.0), lambda total, x: total + x), 3).alias("total"), F.round(F.element_at(values, -1), 4).alias("newest"))


@query("split_tables", oracle="""
SELECT 'dimension' AS kind, event_type AS name, count(DISTINCT user_id) AS rows FROM events GROUP BY event_type
UNION ALL SELECT 'fact', event_type, count(*) FROM events GROUP BY event_type""")
def split_tables(t):
    dimension, fact = reshape.split_tables(t.events, ["user_id", "event_type"], ["event_type", "ts", "value"])
    counts = [df.groupBy(F.lit(kind).alias("kind"), F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("rows"))
              for kind, df in (("dimension", dimension), ("fact", fact))]
    return counts[0].unionByName(counts[1])

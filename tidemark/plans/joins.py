"""Joins."""

from pyspark.sql import functions as F

from tidemark.functions import geometry, text
from tidemark.operators import joins, keywords, ranking, reshape, series
from tidemark.plans import query
from tidemark.session import pin

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def daily(t, value="value"):
    return series.daily_series(t.events, "event_type", "ts", value)


@query("outer_merge_series", oracle="""
SELECT strftime(ts, '%Y-%m-%d') AS period, round(avg(value) FILTER (event_type = 'click' AND value > 0), 8) AS click,
  round(avg(value) FILTER (event_type = 'view' AND value > 150), 8) AS view_high,
  round(avg(value) FILTER (event_type = 'purchase' AND value > 200), 8) AS purchase_high, NULL::DOUBLE AS refund
FROM events WHERE (event_type = 'click' AND value > 0) OR (event_type = 'view' AND value > 150) OR (event_type = 'purchase' AND value > 200)
GROUP BY 1""")
def outer_merge_series(t):
    kind, value = F.col("event_type"), F.col("value")
    name = F.when((kind == "click") & (value > 0), "click").when((kind == "view") & (value > 150), "view_high")
    named = t.events.withColumn("name", name.when((kind == "purchase") & (value > 200), "purchase_high"))
    rows = pin(series.daily_series(named, "name", "ts", "value"))
    order = ["chargeback", "click", "view_high", "refund", "purchase_high"]
    merged = reshape.outer_merge([(n, rows.filter(F.col("series") == n).select("period", "value")) for n in order])
    names = [c for c in merged.columns if c != "period"]
    return merged.orderBy("period").select(F.col("period").cast("string").alias("period"), *[F.round(c, 8).alias(c) for c in names])


@query("merge_chain", oracle="""
SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def merge_chain(t):
    orders = t.orders.select("o_orderkey", "o_custkey")
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    joined = joined.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select("o_orderkey", "c_name", "n_name", "r_name")


@query("category_pair_join", oracle="""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS period, avg(value) AS v FROM events GROUP BY ALL),
m(l, r) AS (VALUES ('click', 'purchase'), ('view', 'signup'), ('error', 'view'))
SELECT m.l AS series, CAST(a.period AS VARCHAR) AS period, round(a.v, 8) AS spend, round(b.v, 8) AS price
FROM m JOIN d a ON a.event_type = m.l JOIN d b ON b.event_type = m.r AND b.period = a.period""")
def category_pair_join(t):
    rows = pin(daily(t))
    mapping = {"click": "purchase", "view": "signup", "error": "view"}
    pairs = series.category_pairs(rows, rows, mapping, ("spend", "price"))
    return pairs.select("series", F.col("period").cast("string").alias("period"), F.round("spend", 8).alias("spend"), F.round("price", 8).alias("price"))


def titled(df):
    """Documents with the key columns of a notice: title (first line), language and source."""
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return df.select("doc_id", title.alias("title"), "lang", "source")


@query("new_rows_only", oracle="""
WITH d AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, lang, source FROM documents)
SELECT doc_id, md5(title) AS title_hash FROM d WHERE NOT EXISTS (
  SELECT 1 FROM d s JOIN labels l ON l.doc_id = s.doc_id
  WHERE s.title IS NOT DISTINCT FROM d.title AND s.lang IS NOT DISTINCT FROM d.lang AND s.source IS NOT DISTINCT FROM d.source)""")
def new_rows_only(t):
    incoming = titled(t.documents)
    stored = incoming.join(t.labels, "doc_id", "left_semi")
    return joins.new_rows_only(incoming, stored, ["title", "lang", "source"]).select("doc_id", F.md5("title").alias("title_hash"))


@query("semi_join", oracle="""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def semi_join(t):
    overdrawn = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return joins.rows_with_keys(t.orders.select("o_orderkey", "o_custkey"), overdrawn, "o_custkey")


@query("outer_join_dim", oracle="""
WITH s AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
SELECT coalesce(n_nationkey, k) AS nation, n_name, suppliers FROM nation FULL JOIN s ON n_nationkey = k""")
def outer_join_dim(t):
    counts = t.supplier.filter(F.col("s_acctbal") > 5000).groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("suppliers"))
    names = t.nation.select(F.col("n_nationkey").alias("nation"), "n_name")
    return joins.outer_by_name(names, counts, "nation", "s_nationkey").select("nation", "n_name", "suppliers")


@query("lookup_default", oracle="""
SELECT s_suppkey, s_nationkey, coalesce(n_name, 'unknown') AS n_name, coalesce(n_regionkey, -1) AS n_regionkey
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON s_nationkey = n_nationkey""")
def lookup_default(t):
    known = t.nation.filter(F.col("n_regionkey") != 2)
    rows = t.supplier.select("s_suppkey", "s_nationkey")
    return joins.lookup_with_default(rows, known, "s_nationkey", "n_nationkey", {"n_name": "unknown", "n_regionkey": -1})


TOKENS = """
tok AS (SELECT doc_id, lang, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 1)) AS word
        FROM documents)"""
TOP_WORDS = f"""{TOKENS},
top AS (SELECT lang, word, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS rank
        FROM tok GROUP BY lang, word QUALIFY rank <= 15)"""


@query("keyword_documents", oracle=f"""
WITH {TOP_WORDS}
SELECT DISTINCT tok.lang, tok.word, tok.doc_id FROM tok JOIN top ON tok.lang = top.lang AND tok.word = top.word""")
def keyword_documents(t):
    documents = t.wide("documents")
    chosen = keywords.top_words(keywords.word_counts(documents, "text", "lang"), "lang", 15)
    return keywords.documents_with(documents, "doc_id", "text", "lang", chosen).select("lang", "word", "doc_id")


WORD_LABELS = {"function": ["the", "and"], "romance": ["tion", "eau", "ción"], "german": ["sch", "ung"], "rare": ["zzq"]}


@query("multi_label_match", oracle="""
SELECT doc_id, array_to_string(list_filter([
  CASE WHEN contains(text, 'the') OR contains(text, 'and') THEN 'function' END,
  CASE WHEN contains(text, 'tion') OR contains(text, 'eau') OR contains(text, 'ción') THEN 'romance' END,
  CASE WHEN contains(text, 'sch') OR contains(text, 'ung') THEN 'german' END,
  CASE WHEN contains(text, 'zzq') THEN 'rare' END], lambda x: x IS NOT NULL), ',') AS labels FROM documents""")
def multi_label_match(t):
    return t.documents.select("doc_id", F.array_join(text.labels_by_word("text", WORD_LABELS), ",").alias("labels"))


@query("session_latest", oracle="""
SELECT conv_id, turn, role, text FROM conversations c
WHERE turn = (SELECT max(turn) FROM conversations i WHERE i.conv_id = c.conv_id)""")
def session_latest(t):
    return ranking.latest_per_key(t.conversations, ["conv_id"], ["turn"]).select("conv_id", "turn", "role", "text")


@query("parent_children", oracle="""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, l_linenumber, l_partkey, l_quantity
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def parent_children(t):
    parents = t.orders.select("o_orderkey", "o_orderdate")
    children = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_quantity")
    listing = joins.parents_with_children(parents, children, "o_orderkey", "o_orderdate", ["l_linenumber", "l_partkey"])
    return listing.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")).drop("o_orderdate")


@query("ring_centroid", oracle="""
SELECT n_nationkey, n_name, round(n_nationkey * 5.0 + 2 + coalesce(w, 0) / 2.0, 8) AS lon, round(n_regionkey * 10.0 - 20 + 1.5, 8) AS lat
FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS w FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey""")
def ring_centroid(t):
    # One rectangle per nation, as wide as it has suppliers; its centre is known.
    width = t.supplier.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("w"))
    box = t.nation.join(width, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    west, south = F.col("n_nationkey") * 5.0, F.col("n_regionkey") * 10.0 - 20
    east, north = west + 4 + F.coalesce("w", F.lit(0)), south + 3
    corners = [(west, south), (east, south), (east, north), (west, north), (west, south)]
    ring = F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in corners])
    centre = geometry.centroid(F.array(ring))
    return box.select("n_nationkey", "n_name", centre.alias("c")).select("n_nationkey", "n_name", F.round("c.lon", 8).alias("lon"), F.round("c.lat", 8).alias("lat"))


@query("code_lookup", oracle="""
WITH codes AS (SELECT n_name AS name, upper(substring(md5(n_name), 1, 3)) AS code FROM nation WHERE n_regionkey <> 1)
SELECT c_custkey, n_name, code FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN codes ON name = n_name""")
def code_lookup(t):
    """Country code by exact name; a name the dimension lacks gives null."""
    codes = t.nation.filter(F.col("n_regionkey") != 1).select(F.col("n_name").alias("name"), F.upper(F.substring(F.md5("n_name"), 1, 3)).alias("code"))
    named = t.customer.select("c_custkey", "c_nationkey").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joins.lookup_with_default(named.select("c_custkey", "n_name"), codes, "n_name", "name", {"code": None})

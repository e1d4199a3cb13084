"""Scans, payloads, pages and sinks. Sink queries write the given table and read it back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import tables as tb
from tidemark.plans import query
from tidemark.session import run_folder
from tidemark.sources import pages, readers, sinks


@query("sql_scan", oracle="""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus""")
def sql_scan(t):
    t.register_views("orders")
    return tb.execute_query(t.spark, """
        SELECT `o_orderstatus`, count(*) AS n, round(sum(`o_totalprice`), 2) AS total
        FROM orders GROUP BY `o_orderstatus`""")


@query("scan_project_filter", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def scan_project_filter(t):
    recent = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return t.orders.filter(recent).select("o_orderkey", "o_custkey", "o_totalprice")


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_mktsegment", T.StringType()),
])


@query("read_csv", oracle="SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def read_csv(t):
    path = run_folder(t.spark, "csv")
    sinks.csv_export(t.customer, path, CUSTOMER_SCHEMA.names)
    return readers.read_csv(t.spark, path, CUSTOMER_SCHEMA)


@query("read_json", oracle="SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def read_json(t):
    # The landed shape: files of one JSON array each, here per thousand customer numbers (unique keys).
    path = run_folder(t.spark, "json")
    block = F.floor(F.col("c_custkey") / 1000).alias("block")
    record = F.to_json(F.struct(*CUSTOMER_SCHEMA.names))
    text = F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]"))
    blocks = t.customer.groupBy(block).agg(text.alias("value"))
    blocks.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).partitionBy("block").text(path)
    return readers.read_json_records(t.spark, path, CUSTOMER_SCHEMA).drop("block")


@query("json_envelope", oracle="""
SELECT event_id, json_extract_string(props, '$.k') AS item, round(value, 2) AS data_value
FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def json_envelope(t):
    row = F.array(F.struct(F.get_json_object("props", "$.k").alias("ITEM"), F.col("value").cast("string").alias("DATA_VALUE")))
    payload = F.when(F.get_json_object("props", "$.k").isNotNull(),
                     F.to_json(F.struct(F.struct(row.alias("row")).alias("StatisticSearch")))).otherwise("{}")
    landed = t.events.select("event_id", payload.alias("payload"))
    schema = "StatisticSearch struct<row: array<struct<ITEM: string, DATA_VALUE: string>>>"
    rows = readers.envelope_rows(landed, "payload", schema, "StatisticSearch.row", "event_id")
    return rows.select("event_id", F.col("ITEM").alias("item"), F.round(F.col("DATA_VALUE").cast("double"), 2).alias("data_value"))


@query("read_xml", oracle="""
SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part""")
def read_xml(t):
    schema = T.StructType([
        T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()), T.StructField("p_size", T.LongType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ])
    path = run_folder(t.spark, "xml")
    t.part.select(*schema.names).write.format("xml").option("rootTag", "items").option("rowTag", "item").save(path)
    return readers.read_xml_items(t.spark, path, schema)


@query("html_fields", oracle="""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           regexp_replace(regexp_extract(html, '(?s)<title(?:\\s[^>]*)?>(.*?)</title>', 1), '<[^>]*>', '', 'g'),
           '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&nbsp;?', ' ', 'g'), '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&amp;?', '&', 'g')) AS title,
       array_to_string(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1), ' ') AS links,
       'no date' AS date
FROM pages""")
def html_fields(t):
    return t.pages.select(
        "page_id", pages.tag_text("html", "title", "no title").alias("title"),
        F.array_join(pages.links("html"), " ").alias("links"), pages.tag_text("html", "time", "no date").alias("date"))


@query("html_body", oracle="""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<[^>]*>', '', 'g'),
    '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) AS body FROM pages""")
def html_body(t):
    return pages.element_text(t.pages, "page_id", "html", "article", {}, "no body")


@query("html_selected", oracle="""
WITH parts AS (
  SELECT page_id, html, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav, regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1) AS ad,
         regexp_extract(html, '(?s)<a href="/the">(.*?)</a>', 1) AS the
  FROM pages)
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, regexp_extract(html, '<meta charset="([^"]*)"', 1) AS charset,
       array_to_string(regexp_extract_all(nav, '<a href="([^"]*)"', 1), ' ') AS nav_links,
       CASE WHEN contains(html, '<div class="ad">') THEN trim(regexp_replace(replace(replace(replace(replace(
           regexp_replace(ad, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) ELSE 'no ad' END AS ad,
       CASE WHEN contains(html, '<a href="/the">') THEN the ELSE 'no link' END AS link
FROM parts""")
def html_selected(t):
    return pages.fields_by_selector(t.pages, "page_id", "html", {
        "lang": ("html", "lang", "", None), "charset": ("head meta[charset]", "charset", "", None),
        "nav_links": ("nav li a", "href", "", " "), "ad": ("body div.ad", None, "no ad", None), "link": ('a[href="/the"]', None, "no link", None)})


@query("html_text", oracle="""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
        '(?s)<script(\\s[^>]*)?>.*?</script>', ' ', 'g'),
        '(?s)<style(\\s[^>]*)?>.*?</style>', ' ', 'g'),
        '(?s)<sup(\\s[^>]*)?>.*?</sup>', ' ', 'g'),
        '(?s)<table(\\s[^>]*)?>.*?</table>', ' ', 'g'),
      '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
    '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&nbsp;?', ' ', 'g'), '&copy;?', '©', 'g'), '&middot;?', '·', 'g'), '&amp;?', '&', 'g'),
    '\\s+', ' ', 'g')) AS text
FROM pages""")
def html_text(t):
    return t.wide("pages").select("page_id", pages.readable_text("html").alias("text"))


@query("html_list_items", oracle="""
WITH items AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1)) AS item,
         generate_subscripts(regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1), 1) AS position
  FROM pages)
SELECT page_id, position, trim(regexp_extract(item, '(?s)<a(?:\\s[^>]*)?>(.*?)</a>', 1)) AS name,
       array_to_string(regexp_extract_all(item, '<img\\s[^>]*?alt="([^"]*)"', 1), ',') AS tokens
FROM items""")
def html_list_items(t):
    rows = pages.list_items(t.pages, "html", "page_id")
    return rows.withColumn("tokens", F.array_join("tokens", ","))


@query("sink_append", oracle="""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def sink_append(t):
    path = run_folder(t.spark, "append")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.append(rows, path, ["o_orderstatus"])
    sinks.append(rows.filter(F.col("o_orderstatus") == "F"), path, ["o_orderstatus"])
    return t.spark.read.parquet(path)


@query("sink_overwrite", oracle="""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
FROM orders""")
def sink_overwrite(t):
    path = run_folder(t.spark, "replace")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.replace(rows, path, ["o_orderstatus"])
    changed = rows.filter(F.col("o_orderstatus") == "F").withColumn("o_totalprice", -F.col("o_totalprice"))
    sinks.replace(changed, path, ["o_orderstatus"], only_touched=True)
    return t.spark.read.parquet(path)


@query("sink_documents", oracle="""
SELECT s_suppkey, s_name, round(s_acctbal, 2) AS balance, s_nationkey AS nation FROM supplier""")
def sink_documents(t):
    path = run_folder(t.spark, "documents")
    nested = t.supplier.select("s_suppkey", "s_name", F.struct(F.col("s_acctbal").alias("balance"),
                               F.array("s_nationkey").alias("nations")).alias("detail"))
    sinks.documents(nested, path)
    schema = "s_suppkey bigint, s_name string, detail struct<balance: double, nations: array<bigint>>"
    back = t.spark.read.schema(schema).json(path)
    return back.select("s_suppkey", "s_name", F.round("detail.balance", 2).alias("balance"), F.get("detail.nations", F.lit(0)).alias("nation"))


@query("sink_csv", oracle="SELECT s_suppkey, s_name FROM supplier")
def sink_csv(t):
    path = run_folder(t.spark, "export")
    sinks.csv_export(t.supplier, path, ["s_suppkey", "s_name"])
    return readers.read_csv(t.spark, path, T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType())]))


@query("json_records", oracle="""
SELECT o_orderkey, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
  || '","o_totalprice":' || o_totalprice || ',"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
  || '","o_orderpriority":"' || o_orderpriority || '"}' AS record FROM orders""")
def json_records(t):
    rows = t.orders
    return rows.select("o_orderkey", sinks.json_records(rows).alias("record"))


@query("sink_jsonl", oracle="""
SELECT s_suppkey AS key, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer""")
def sink_jsonl(t):
    path = run_folder(t.spark, "lines")
    sinks.json_lines(t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), path)
    sinks.json_lines(t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), path)
    return t.spark.read.schema("key bigint, name string").json(path)


@query("bulk_load", oracle="SELECT c_custkey, c_mktsegment FROM customer")
def bulk_load(t):
    path = run_folder(t.spark, "bulk")
    sinks.bulk_load(t.spark, t.path("customer"), path, ["c_custkey", "c_mktsegment"])
    sinks.bulk_load(t.spark, t.path("customer"), path, ["c_custkey", "c_mktsegment"], truncate=True)
    return t.spark.read.parquet(path)


@query("enforce_schema", oracle="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, TRY_CAST(c_name AS DOUBLE) AS c_name,
       c_acctbal, TRY_CAST(c_mktsegment AS BIGINT) AS c_mktsegment FROM customer""")
def enforce_schema(t):
    return readers.enforce_schema(t.customer, T.StructType([
        T.StructField("c_custkey", T.StringType(), False), T.StructField("c_name", T.DoubleType()),
        T.StructField("c_acctbal", T.DoubleType()), T.StructField("c_mktsegment", T.LongType())]))


@query("flatten_trend", oracle="""
SELECT event_type AS group_name, strftime(ts, '%Y-%m-%d') AS period, round(sum(value), 2) AS ratio
FROM events GROUP BY 1, 2""")
def flatten_trend(t):
    # Nested as the landed trend files are: one file per day, groups with their data points.
    day = F.date_format("ts", "yyyy-MM-dd")
    daily = t.events.groupBy("event_type", day.alias("period")).agg(F.round(F.sum("value"), 2).alias("ratio"))
    group = F.struct(F.col("event_type").alias("title"), F.array(F.struct("period", "ratio")).alias("data"))
    return readers.flatten_trend(daily.select(F.array(group).alias("results")))

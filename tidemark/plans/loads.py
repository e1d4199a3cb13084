"""Loads, upserts, feedback and transcripts."""

from pyspark.sql import functions as F

from tidemark.operators import joins, quality, ranking
from tidemark.plans import query
from tidemark.plans.joins import titled
from tidemark.session import run_folder
from tidemark.sources import sinks
from tidemark.sources.versioned import VersionedTable


SUMMARY = "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus"


def _summary(orders):
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("published_summary", oracle=SUMMARY)
def published_summary(t):
    """A checked summary as a version of its table; a summary that fails its check does not become one."""
    made = VersionedTable(t.spark, run_folder(t.spark, "summaries"))
    quality.check_counts([(t.orders, ">=", 1)])
    sound = lambda written: quality.check_counts([(written.filter(F.col("n") <= 0), "eq", 0)])
    made.replace(_summary(t.orders.filter(F.year("o_orderdate") < 1996)), [sound])
    made.replace(_summary(t.orders), [sound])
    return made.read()


@query("checked_summary", oracle=SUMMARY)
def checked_summary(t):
    orders, target = t.orders, run_folder(t.spark, "summary")

    quality.checked_build(t.spark, target, lambda: _summary(orders), [(orders, ">=", 1)], [(lambda df: df.filter(F.col("n") <= 0), "eq", 0)])
    return t.spark.read.parquet(target)


@query("incremental_by_mark", oracle="SELECT o_orderkey, year(o_orderdate) AS yr FROM orders")
def incremental_by_mark(t):
    source, target = t.orders.select("o_orderkey", F.year("o_orderdate").alias("yr")), run_folder(t.spark, "yearly")
    quality.append_past_mark(t.spark, source, target, "yr", 0, 1997, ["yr"])
    quality.append_past_mark(t.spark, source, target, "yr", 0, None, ["yr"])
    quality.append_past_mark(t.spark, source, target, "yr", 0, None, ["yr"])
    return t.spark.read.parquet(target)


NOTICES = """
WITH d AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, lang, source FROM documents),
s AS (SELECT d.* FROM d JOIN labels USING (doc_id))
SELECT doc_id, lang, source FROM s UNION ALL
SELECT doc_id, lang, source FROM d WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.title IS NOT DISTINCT FROM d.title
  AND s.lang IS NOT DISTINCT FROM d.lang AND s.source IS NOT DISTINCT FROM d.source)"""


@query("notice_load", oracle=NOTICES)
def notice_load(t):
    """The labelled documents are stored first; then all documents arrive, twice."""
    notices, target = titled(t.documents), run_folder(t.spark, "notices")
    sinks.append(notices.join(t.labels, "doc_id", "left_semi"), target)
    for _ in range(2):
        quality.append_new_rows(t.spark, notices, target, ["title", "lang", "source"])
    return t.spark.read.parquet(target).select("doc_id", "lang", "source")


@query("published_notices", oracle=NOTICES)
def published_notices(t):
    """The same load into a table of versions, in which each arrival is one version or none."""
    made, notices = VersionedTable(t.spark, run_folder(t.spark, "notices")), titled(t.documents)
    made.replace(notices.join(t.labels, "doc_id", "left_semi"))
    for _ in range(2):
        made.append_new(notices, ["title", "lang", "source"])
    return made.read().select("doc_id", "lang", "source")


def _sides(t):
    stored = t.customer.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_mktsegment", F.round("c_acctbal", 2).alias("balance"))
    incoming = t.customer.filter(F.col("c_acctbal") < 5000).select("c_custkey", F.lit("CHANGED").alias("c_mktsegment"), F.lit(0.0).alias("balance"))
    return stored, incoming


ADDED = """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_acctbal < 0 THEN 0 ELSE round(c_acctbal, 2) END AS balance FROM customer"""


@query("upsert", oracle=ADDED)
def upsert(t):
    return joins.upsert(*_sides(t), ["c_custkey"], force=False)


REPLACED = """
SELECT c_custkey, CASE WHEN c_acctbal < 5000 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_acctbal < 5000 THEN 0 ELSE round(c_acctbal, 2) END AS balance FROM customer"""


@query("upsert_forced", oracle=REPLACED)
def upsert_forced(t):
    return joins.upsert(*_sides(t), ["c_custkey"], force=True)


def _merged(t, force):
    stored, incoming = _sides(t)
    made = VersionedTable(t.spark, run_folder(t.spark, "customers"))
    made.replace(stored.repartitionByRange(8, "c_custkey"))
    made.merge(incoming, ["c_custkey"], force)
    return made


@query("merge_insert", oracle=ADDED)
def merge_insert(t):
    return _merged(t, False).read()


@query("merge_replace", oracle=REPLACED)
def merge_replace(t):
    return _merged(t, True).read()


@query("merge_untouched_files", oracle="""
SELECT 1 AS rewritten, count(*) AS "rows", count(*) FILTER (c_custkey <= 5) AS changed FROM customer WHERE c_acctbal >= 0 OR c_custkey <= 5""")
def merge_untouched_files(t):
    """A merge of a few neighbouring keys: one file of eight is written anew, all others go on as they are."""
    stored, _ = _sides(t)
    made = VersionedTable(t.spark, run_folder(t.spark, "customers"))
    made.replace(stored.repartitionByRange(8, "c_custkey"))
    before = set(made.files())
    few = t.customer.filter(F.col("c_custkey") <= 5)
    made.merge(few.select("c_custkey", F.lit("CHANGED").alias("c_mktsegment"), F.lit(0.0).alias("balance")), ["c_custkey"])
    rewritten = len(before - set(made.files()))
    return made.read().agg(F.lit(rewritten).alias("rewritten"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("c_mktsegment") == "CHANGED").alias("changed"))


FEEDBACK = """
f AS (SELECT user_id AS conv_id, CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS turn, ts, event_id,
  CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS liked FROM events),
l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY ts DESC, event_id DESC) = 1)"""


def _with_feedback(t):
    liked = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "error", -1).otherwise(0)
    given = t.events.select(F.col("user_id").alias("conv_id"), (F.get_json_object("props", "$.k").cast("bigint") % 4).alias("turn"),
                            "ts", "event_id", liked.alias("liked"))
    messages = t.conversations.select("conv_id", "turn", "role")
    return quality.apply_feedback(messages, given, ["conv_id", "turn"], ["ts", "event_id"], "liked")


@query("apply_feedback", oracle=f"""
WITH {FEEDBACK} SELECT c.conv_id, c.turn, c.role, l.liked FROM conversations c LEFT JOIN l ON l.conv_id = c.conv_id AND l.turn = c.turn""")
def apply_feedback(t):
    return _with_feedback(t)


@query("feedback_totals", oracle=f"""
WITH {FEEDBACK} SELECT c.role, count(*) FILTER (l.liked = 1) AS likes, count(*) FILTER (l.liked = -1) AS dislikes, count(*) AS messages
FROM conversations c LEFT JOIN l ON l.conv_id = c.conv_id AND l.turn = c.turn GROUP BY c.role""")
def feedback_totals(t):
    return _with_feedback(t).groupBy("role").agg(
        F.count_if(F.col("liked") == 1).alias("likes"), F.count_if(F.col("liked") == -1).alias("dislikes"), F.count(F.lit(1)).alias("messages"))


@query("session_transcript", oracle="""
SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS message FROM conversations""")
def session_transcript(t):
    return ranking.with_positions(t.conversations, ["conv_id"], ["turn"], "message")

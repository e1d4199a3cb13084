"""Text, JSON and number functions on whole columns."""

from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import keywords, ranking
from tidemark.plans import query
from tidemark.plans.joins import TOP_WORDS
from tidemark.session import pin
from tidemark.sources import sinks

# Sections of the test prose: from one common word to the next, in two spellings.
SECTION_PATTERNS = (r"\bthe\s+(.*?)\s*\.\s*The\b", r"\bthe\s+(.*?)\s*\.", r"\bde\s+(.*?)\s*\.")
SECTION_SQL = " ".join(
    f"WHEN regexp_matches(text, '(?s){p}') THEN trim(regexp_extract(text, '(?s){p}', 1), chr(32) || chr(10))" for p in SECTION_PATTERNS)


@query("section_extract", oracle=f"SELECT doc_id, CASE {SECTION_SQL} ELSE 'not found' END AS section FROM documents")
def section_extract(t):
    return t.wide("documents").select("doc_id", text.first_section("text", SECTION_PATTERNS, "not found").alias("section"))


@query("notice_sections", oracle="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '사유 ' || o_custkey ELSE '개정이유를 찾을 수 없습니다.' END AS reason,
  CASE WHEN o_orderstatus <> 'P' THEN '내용 ' || o_orderpriority ELSE '주요내용을 찾을 수 없습니다.' END AS content,
  CASE WHEN o_orderstatus = 'F' THEN '사유 ' || o_custkey ELSE '개정이유를 찾을 수 없습니다.' END || ' ' ||
  CASE WHEN o_orderstatus <> 'P' THEN '내용 ' || o_orderpriority ELSE '주요내용을 찾을 수 없습니다.' END AS both
FROM orders""")
def notice_sections(t):
    """Notices in the regulation layout, made from the order columns, with both default patterns."""
    reason = F.concat(F.lit("1. 개정 이유\n 사유 "), F.col("o_custkey").cast("string"), F.lit("\n"))
    content = F.concat(F.lit("2. 주요 내용\n내용 "), F.col("o_orderpriority"), F.lit("\n 3. "),
                       F.when(F.col("o_orderstatus") == "F", "의견제출").otherwise("기타"))
    body = F.when(F.col("o_orderstatus") == "F", F.concat(reason, content)).when(F.col("o_orderstatus") == "O", content).otherwise("공고 없음")
    found = t.orders.select("o_orderkey", text.revision_reason(body).alias("reason"), text.main_content(body).alias("content"))
    return found.withColumn("both", F.concat("reason", F.lit(" "), "content"))


@query("compose_content", oracle="""
SELECT doc_id, md5(CASE WHEN lang = 'en' THEN '제목' || source || chr(10) || '시작날짜: 2024-01-01 종료날짜: 2024-02-01' || chr(10) || '내용: ' || trim(text)
  ELSE source || '내용 없음' END) AS content FROM documents""")
def compose_content(t):
    body = F.when(F.col("lang") == "en", F.col("text"))
    content = text.compose_notice("source", F.lit("2024-01-01"), F.lit("2024-02-01"), body)
    return t.documents.select("doc_id", F.md5(content).alias("content"))


@query("period_split", oracle="""
SELECT doc_id, CASE WHEN lang = 'en' OR lang = 'fr' THEN source ELSE '날짜 정보 없음' END AS start_date,
  CASE lang WHEN 'en' THEN CAST(n_chars AS VARCHAR) WHEN 'fr' THEN NULL ELSE '날짜 정보 없음' END AS end_date FROM documents""")
def period_split(t):
    label = F.lit("공고 예고기간 ")
    line = F.when(F.col("lang") == "en", F.concat(label, "source", F.lit(" ~ "), F.col("n_chars").cast("string")))
    line = line.when(F.col("lang") == "fr", F.concat(label, "source")).otherwise("공고")
    bounds = t.documents.select("doc_id", text.period_bounds(line).alias("b"))
    return bounds.select("doc_id", F.col("b.start").alias("start_date"), F.col("b.end").alias("end_date"))


@query("url_normalise", oracle="""
SELECT page_id, 'https://host.example' || CASE WHEN starts_with(link, './') THEN replace(link, './', '/') ELSE link END AS url
FROM (SELECT page_id, CASE WHEN starts_with(url, 'https') THEN './' || split_part(url, '/', 4) ELSE '/' || split_part(url, '/', 4) END AS link FROM pages)""")
def url_normalise(t):
    part = F.split_part("url", F.lit("/"), F.lit(4))
    link = F.when(F.col("url").startswith("https"), F.concat(F.lit("./"), part)).otherwise(F.concat(F.lit("/"), part))
    return t.pages.select("page_id", text.absolute_url(link, "https://host.example").alias("url"))


@query("text_date", oracle="""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def text_date(t):
    written = F.concat(F.lit("개정일은 "), F.date_format("o_orderdate", "yyyy년 M월 d일"), F.lit(" 입니다"))
    sentence = F.when(F.col("o_orderstatus") == "P", "날짜 없음").otherwise(written)
    return t.orders.select("o_orderkey", dates.text_date(sentence).alias("day"))


@query("label_value", oracle="""
SELECT doc_id, 'src: ' || source AS title, CASE WHEN lang = 'en' THEN CAST(n_chars AS VARCHAR) ELSE 'N/A' END AS fees FROM documents""")
def label_value(t):
    answer = F.concat(F.lit("Title: src: "), "source", F.lit("\n"),
                      F.when(F.col("lang") == "en", F.concat(F.lit("Fees: "), F.col("n_chars").cast("string"))).otherwise("none"))
    return t.documents.select("doc_id", text.labelled_value(answer, "Title").alias("title"), text.labelled_value(answer, "Fees").alias("fees"))


TOKEN_LIST = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: length(w) > 1 AND w NOT IN ('the', 'la', 'und'))"


@query("tokens", oracle=f"""
SELECT doc_id, array_to_string(list_filter({TOKEN_LIST}, lambda w: w <> lang), ' ') AS tokens FROM documents""")
def tokens(t):
    found = text.tokens("text", ("the", "la", "und"), category="lang")
    return t.documents.select("doc_id", F.array_join(found, " ").alias("tokens"))


@query("keywords5", oracle=f"""
WITH w AS (SELECT doc_id, unnest({TOKEN_LIST}[1:5]) AS word, generate_subscripts({TOKEN_LIST}[1:5], 1) AS k FROM documents),
f AS (SELECT doc_id, word, min(k) AS k FROM w GROUP BY ALL)
SELECT d.doc_id, coalesce(string_agg(word, ',' ORDER BY k), '') AS keywords FROM documents d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id""")
def keywords5(t):
    lead = text.lead_keywords("text", ("the", "la", "und"))
    return t.documents.select("doc_id", F.array_join(lead, ",").alias("keywords"))


@query("prefix", oracle="SELECT doc_id, substring(text, 1, 512) AS short, substring(text, 1, 1000) AS preview FROM documents")
def prefix(t):
    return t.documents.select("doc_id", F.substring("text", 1, 512).alias("short"), F.substring("text", 1, 1000).alias("preview"))


@query("collapse_ws", oracle="""
SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS text_hash FROM documents""")
def collapse_ws(t):
    return t.documents.select("doc_id", F.md5(text.collapse_whitespace("text")).alias("text_hash"))


@query("row_template", oracle="""
SELECT p_partkey, 'name: ' || p_name || ', brand: ' || p_brand || ', size: ' || p_size AS text FROM part""")
def row_template(t):
    return t.part.select("p_partkey", F.format_string("name: %s, brand: %s, size: %d", "p_name", "p_brand", "p_size").alias("text"))


@query("nested_to_json", oracle="""
SELECT event_id, '["' || event_type || '","' || user_id || '"]' AS tags, '{"type":"' || event_type || '","user":' || user_id || '}' AS detail FROM events""")
def nested_to_json(t):
    nested = t.events.select("event_id", F.array("event_type", F.col("user_id").cast("string")).alias("tags"),
                             F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("detail"))
    return sinks.nested_to_json(nested)


@query("json_list_head", oracle="""
SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type))[1:5], ',') AS head FROM events GROUP BY user_id""")
def json_list_head(t):
    # Event types are a small fixed set, so the list per user is short.
    stored = t.events.groupBy("user_id").agg(F.to_json(F.sort_array(F.collect_set("event_type"))).alias("types"))
    head = F.slice(F.from_json("types", "array<string>"), 1, 5)
    return stored.select("user_id", F.array_join(head, ",").alias("head"))


@query("json_vector", oracle="""
SELECT vec_id, len(embedding) AS dims, round(CAST(embedding[1] AS DOUBLE), 5) AS first, round(CAST(embedding[64] AS DOUBLE), 5) AS last FROM embeddings""")
def json_vector(t):
    stored = t.embeddings.select("vec_id", F.to_json("embedding").alias("vector"))
    vector = stored.select("vec_id", F.from_json("vector", "array<float>").alias("v"))
    return vector.select("vec_id", F.size("v").cast("bigint").alias("dims"), F.round(F.get("v", F.lit(0)).cast("double"), 5).alias("first"),
                         F.round(F.get("v", F.lit(63)).cast("double"), 5).alias("last"))


@query("join_tokens", oracle="""
SELECT p_partkey, coalesce(nullif(array_to_string(list_filter(string_split(p_name, ' '), lambda w: length(w) > 3), ', '), ''), '정보 없음') AS shown FROM part""")
def join_tokens(t):
    words = F.filter(F.split("p_name", " "), lambda w: F.length(w) > 3)
    return t.part.select("p_partkey", text.join_tokens(words, "정보 없음").alias("shown"))


@query("related_items", oracle=f"""
WITH {TOP_WORDS}, m AS (SELECT DISTINCT tok.lang, tok.word, tok.doc_id FROM tok JOIN top ON tok.lang = top.lang AND tok.word = top.word),
r AS (SELECT *, (row_number() OVER (PARTITION BY lang, word ORDER BY doc_id) - 1) // 100 AS chunk FROM m)
SELECT lang, word, chunk, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS items FROM r GROUP BY ALL""")
def related_items(t):
    """Related documents of each top word, all of them, in lists of a hundred."""
    documents = t.wide("documents")
    top = keywords.top_words(keywords.word_counts(documents, "text", "lang"), "lang", 15)
    matches = pin(keywords.documents_with(documents, "doc_id", "text", "lang", top))
    lists = ranking.list_chunks(matches, ["lang", "word"], "doc_id", ["doc_id"], 100)
    return lists.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@query("round2", oracle="""
SELECT event_type, round(avg(value), 2) AS mean, round(sum(value), 2) AS total FROM events GROUP BY event_type""")
def round2(t):
    return t.events.groupBy("event_type").agg(F.round(F.avg("value"), 2).alias("mean"), F.round(F.sum("value"), 2).alias("total"))


@query("lead_sentence", oracle="""
SELECT doc_id, CASE WHEN regexp_matches(text, '(?s)^(.*?[.!?])') THEN regexp_extract(text, '(?s)^(.*?[.!?])', 1) ELSE text END AS sentence FROM documents""")
def lead_sentence(t):
    return t.documents.select("doc_id", text.lead_sentence("text").alias("sentence"))


@query("url_encode_word", oracle="SELECT p_partkey, url_encode(p_name) AS encoded FROM part")
def url_encode_word(t):
    return t.part.select("p_partkey", text.url_word("p_name").alias("encoded"))

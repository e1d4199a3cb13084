"""The registered queries of this package, over their whole tables, and their SQL twins where SQL can state them."""

from __future__ import annotations

import public_tokenizers

from tidemark.llm import (
    bpe, codebooks, exact_dedup, hamming, merkle, mixing, ngram_join, packing, secrets, substring_dedup, suffix_dedup, toxicity, warc,
)
from tidemark.tables import NamedQueries

REGISTRY = NamedQueries()

#: Target weights of the sources, and rows in a block. Sources without a weight share the lane "(other)" with weight 1.
MIX_WEIGHTS = {f"src{i}": 1 + i % 5 for i in range(20)}
BLOCK_ROWS = 64
NEIGHBOURS = 10
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

WHITE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_SQL = f"""
WITH RECURSIVE split AS (SELECT doc_id, {WORDS_SQL.format(LOWER_SQL)} AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [list_aggregate(w, 'string_agg', ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) END) AS g FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.b) AS component_id,
  (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id"""

WARC_SQL = """
WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
tops AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to FROM tops"""

DEDUP_SQL = f"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS c, sha256(translate(coalesce(text, ''), {WHITE_SQL}, '')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h ORDER BY c DESC, doc_id)"""

MIX_SQL = f"""
WITH RECURSIVE weights(lane, weight) AS (VALUES {", ".join(f"('{name}', {w})" for name, w in sorted({**MIX_WEIGHTS, mixing.OTHER: 1}.items()))}),
lanes AS (SELECT row_number() OVER (ORDER BY lane) AS i, lane, weight FROM weights),
total AS (SELECT sum(weight)::BIGINT AS period, count(*) AS n FROM weights),
edf AS (
  SELECT -1::BIGINT AS slot, list_transform(range(0, (SELECT n FROM total)), lambda x: 0::BIGINT) AS done, 0::BIGINT AS chosen
  UNION ALL
  SELECT e.slot + 1, list_transform(e.done, lambda d, i: d + CASE WHEN i = e.next THEN 1 ELSE 0 END), e.next
  FROM (SELECT edf.slot, edf.done, (SELECT arg_min(l.i, (t.period * (edf.done[l.i] + 1) + l.weight - 1) // l.weight * 1000 + l.i)
          FROM lanes l, total t WHERE t.period * edf.done[l.i] // l.weight <= edf.slot + 1) AS next FROM edf) e, total
  WHERE e.slot + 1 < total.period),
plan AS (SELECT lane, weight, slot, row_number() OVER (PARTITION BY lane ORDER BY slot) AS nth FROM edf JOIN lanes ON i = chosen),
placed AS (SELECT doc_id, source, CASE WHEN source IN (SELECT lane FROM weights WHERE lane <> '{mixing.OTHER}') THEN source ELSE '{mixing.OTHER}' END AS lane FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY doc_id) - 1 AS position FROM placed),
blocks AS (SELECT doc_id, source, b.lane, weight, position // {BLOCK_ROWS} + 1 AS block, position % {BLOCK_ROWS} AS "offset"
  FROM numbered b JOIN weights w ON w.lane = b.lane)
SELECT doc_id, source, b.lane, block, "offset",
  (block - 1) // b.weight * period + period * (nth - 1) // b.weight AS "release",
  (block - 1) // b.weight * period + (period * nth + b.weight - 1) // b.weight AS deadline,
  (block - 1) // b.weight * period + slot AS slot
FROM blocks b JOIN plan p ON p.lane = b.lane AND p.nth = (block - 1) % b.weight + 1, total"""

SUBSTRING_SQL = f"""
WITH split AS (SELECT doc_id, {WORDS_SQL.format("coalesce(text, '')")} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM split),
windows AS (SELECT doc_id, p, sha256(list_aggregate(w[p:p + 49], 'string_agg', ' ')) AS h FROM starts),
gone AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) AS first FROM windows) WHERE first < doc_id),
places AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM gone),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM split),
kept AS (SELECT w.doc_id, count(*) FILTER (WHERE g.p IS NOT NULL) AS n_removed,
  string_agg(word, ' ' ORDER BY w.p) FILTER (WHERE g.p IS NULL) AS body FROM words w LEFT JOIN places g ON g.doc_id = w.doc_id AND g.p = w.p GROUP BY w.doc_id)
SELECT s.doc_id, len(s.w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM split s LEFT JOIN kept k ON k.doc_id = s.doc_id"""

TOP_K_SQL = f"""
WITH codes AS (SELECT vec_id AS id,
  list_sum(list_transform(range(0, 32), lambda i: CASE WHEN embedding[i + 1] > 0 THEN (1::BIGINT << i) ELSE 0 END))::BIGINT AS low,
  list_sum(list_transform(range(0, 32), lambda i: CASE WHEN embedding[i + 33] > 0 THEN (1::BIGINT << i) ELSE 0 END))::BIGINT AS high
  FROM embeddings WHERE len(embedding) = 64),
pairs AS (SELECT q.id AS query_id, c.id AS neighbour_id, bit_count(xor(q.low, c.low)) + bit_count(xor(q.high, c.high)) AS distance
  FROM codes q JOIN codes c ON q.id <> c.id WHERE q.id % 100 = 0)
SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank, neighbour_id, distance::BIGINT AS distance
  FROM pairs) WHERE rank <= {NEIGHBOURS}"""


def _leaf_sql(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    marked = (f"CASE WHEN {x} IS NULL THEN '-' ELSE octet_length(encode({x}::VARCHAR)) || ':' || {x}::VARCHAR END" for x in fields)
    return f"sha256({' || '.join(marked)})"


#: CRC-32 bit by bit: a byte is taken in, then eight steps (marked -1) shift it through.
CRC_SQL = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""

MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf, CASE WHEN doc_id IS NOT NULL AND {CRC_SQL} % 5 = 0
    THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed FROM documents)),
up AS (SELECT source, 0 AS level, pos, n, leaf AS digest FROM leaves UNION ALL
  SELECT source, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY source, level, pos // 16, n),
subroots AS (SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, pos, n, subroot AS digest FROM subroots UNION ALL
  SELECT level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY level, pos // 16, n),
low_steps AS (SELECT l.source, l.pos, u.level AS step, coalesce(string_agg(digest, '' ORDER BY u.pos) FILTER (u.pos < l.pos >> (4 * u.level)), '') AS a,
    coalesce(string_agg(digest, '' ORDER BY u.pos) FILTER (u.pos > l.pos >> (4 * u.level)), '') AS b
  FROM leaves l JOIN up u ON u.source IS NOT DISTINCT FROM l.source AND u.n > 1 AND u.pos >> 4 = l.pos >> (4 * u.level + 4) GROUP BY l.source, l.pos, u.level),
top_steps AS (SELECT s.source, s.height + t.level AS step, coalesce(string_agg(digest, '' ORDER BY t.pos) FILTER (t.pos < s.pos >> (4 * t.level)), '') AS a,
    coalesce(string_agg(digest, '' ORDER BY t.pos) FILTER (t.pos > s.pos >> (4 * t.level)), '') AS b
  FROM subroots s JOIN top t ON t.n > 1 AND t.pos >> 4 = s.pos >> (4 * t.level + 4) GROUP BY s.source, s.height, t.level),
steps AS (SELECT * FROM low_steps UNION ALL SELECT l.source, l.pos, step, a, b FROM leaves l JOIN top_steps t ON t.source IS NOT DISTINCT FROM l.source),
proofs AS (SELECT source, pos, list([a, b] ORDER BY step) AS proof, string_agg(a || b, '' ORDER BY step) AS beside FROM steps GROUP BY source, pos),
folded AS (SELECT l.*, subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(coalesce(beside, '')) AS proof_sha256,
    list_reduce(list_prepend([coalesce(changed, leaf), ''], coalesce(proof, [])), lambda acc, x: [sha256(x[1] || acc[1] || x[2]), ''])[1] AS folded_root
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.pos = l.pos)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


def _codes_sql(rounds: int = 4) -> str:
    steps = []
    for r in range(rounds + 1):
        if r:
            steps.append(f"""sums{r} AS MATERIALIZED (SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM near{r - 1} JOIN parts USING (id, p), range(1, 17) t(i) GROUP BY p, e, i),
book{r} AS MATERIALIZED (SELECT p, e, coalesce(y, x) AS x FROM book{r - 1} LEFT JOIN (
  SELECT p, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS y FROM sums{r} GROUP BY p, e) USING (p, e))""")
        steps.append(f"""near{r} AS MATERIALIZED (SELECT id, p, m % 256 AS e, m // 256 AS d FROM (
  SELECT id, p, min((list_dot_product(a.x, a.x) - 2 * list_dot_product(a.x, b.x) + list_dot_product(b.x, b.x))::BIGINT * 256 + e) AS m
  FROM parts a JOIN book{r} b USING (p) GROUP BY id, p))""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT id, p, v[p * 16 + 1:p * 16 + 16]::DOUBLE[] AS x FROM kept, range(4) t(p)),
book0 AS MATERIALIZED (SELECT p, e, x FROM parts JOIN (SELECT id, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept QUALIFY e < 256) USING (id)),
{", ".join(steps)},
codes AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY id),
books AS (SELECT sha256(string_agg(z::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (SELECT p, e, unnest(x) AS z, generate_subscripts(x, 1) AS i FROM book{rounds}))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN codes USING (id), books"""


CODES_SQL = _codes_sql()


@REGISTRY.add("op1_ngram_join", oracle=NGRAM_SQL)
def op1_ngram_join(t):
    return ngram_join.join(t.documents).select("doc_id", "n_shingles", "component_id", "n_links")


@REGISTRY.add("op2_warc", oracle=WARC_SQL)
def op2_warc(t):
    return warc.archive(t.pages).drop("record_id")


@REGISTRY.add("op3_bpe")
def op3_bpe(t):
    return bpe.digest(t.documents, VOCABULARY)


@REGISTRY.add("op4_secrets")
def op4_secrets(t):
    return secrets.digest(t.documents)


@REGISTRY.add("op5_toxicity")
def op5_toxicity(t):
    return toxicity.digest(t.documents, t.labels)


@REGISTRY.add("op6_exact_dedup", oracle=DEDUP_SQL)
def op6_exact_dedup(t):
    return exact_dedup.decide(t.documents).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@REGISTRY.add("op7_suffix_dedup")
def op7_suffix_dedup(t):
    return suffix_dedup.digest(t.documents)


@REGISTRY.add("op8_mixing", oracle=MIX_SQL)
def op8_mixing(t):
    return mixing.place(t.documents, MIX_WEIGHTS, BLOCK_ROWS).drop("row_id")


@REGISTRY.add("op9_substring_dedup", oracle=SUBSTRING_SQL)
def op9_substring_dedup(t):
    return substring_dedup.digest(t.documents)


@REGISTRY.add("op10_hamming_top_k", oracle=TOP_K_SQL)
def op10_hamming_top_k(t):
    vectors = t.embeddings
    return hamming.top_k(vectors, vectors.where("vec_id % 100 = 0"), NEIGHBOURS)


@REGISTRY.add("op11_packing")
def op11_packing(t):
    return packing.digest(t.documents, VOCABULARY)


@REGISTRY.add("op12_merkle_manifest", oracle=MERKLE_SQL)
def op12_merkle_manifest(t):
    return merkle.digest(t.documents)


@REGISTRY.add("op13_vector_codes", oracle=CODES_SQL)
def op13_vector_codes(t):
    return codebooks.digest(t.embeddings)

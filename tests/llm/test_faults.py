"""Words that a polynomial takes for equal, long texts that share passages, sketches of several lengths, and clashing column names."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import bpe, common, exact_dedup, fingerprints, mixing, ngram_join, queries, secrets, substring_dedup, toxicity


def thue_morse(bits, letters="ab"):
    return "".join(letters[i.bit_count() & 1] for i in range(1 << bits))


def test_word_fingerprints():
    pick = random.Random(5)
    words = [thue_morse(k, letters) for k in range(1, 13) for letters in ("ab", "ba")]
    words += ["".join(pick.choices("xyé\0", k=pick.randint(1, 80))) for _ in range(5000)] + ["a" * n for n in range(1, 200)]
    words = list(dict.fromkeys(words))
    data = " \n".join(words).encode()
    for lane in (0, 1):
        starts, ends, prints = fingerprints.words(data, lane)
        assert [data[a:b].decode() for a, b in zip(starts, ends)] == words
        assert len(set(prints.tolist())) == len(words)
        # A word's print does not depend on what is around it.
        assert all(fingerprints.words(w.encode(), lane)[2].tolist() == [p] for w, p in zip(words[:300], prints.tolist()))
    assert not set(fingerprints.words(data, 0)[2].tolist()) & set(fingerprints.words(data, 1)[2].tolist())
    assert len(fingerprints.words(b"")[2]) == len(fingerprints.words(b" \n")[2]) == 0


def test_unlike_words_stay_apart(spark):
    tail = " ".join(f"t{i}" for i in range(49))
    rows = [(1, thue_morse(10) + " " + tail), (2, thue_morse(10, "ba") + " " + tail), (3, thue_morse(10)), (4, thue_morse(10, "ba"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.digest(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.join(docs).collect()}
    # 45 of 47 shingles are shared by the first two; the other two are one word each.
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}


def brute(rows):
    sets = {}
    for i, text in rows:
        words = text.lower().split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def long_texts():
    pick = random.Random(11)
    passage = [f"p{i}" for i in range(300)]
    rows = []
    for i in range(14):
        words = [f"u{i}x{pick.randint(0, 10 ** 6)}" for _ in range(pick.choice([1000, 2500, 5000]))]
        rows.append((i, " ".join(words[:200] + passage + words[200:])))
        if i % 4 == 0:
            # A near copy and a text that shares just too little.
            cut = len(words) * 24 // 100
            rows.append((100 + i, " ".join(words[:200] + passage + words[200:-cut // 2])))
            rows.append((200 + i, " ".join(words[:200] + passage + words[200:-2 * cut])))
    return rows


def test_long_texts_that_share_a_passage(spark):
    rows = long_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(docs).collect()}
    assert got == brute(rows)


def test_blocks_refute_unlike_long_sets(spark):
    scheme, pick = ngram_join.Scheme(75, 5, 0.15), np.random.default_rng(1)
    sets = [np.unique(pick.integers(0, 1 << 63, n).astype(np.uint64)) for n in (400, 900, 1000, 1010, 1300, 2000, 2047, 2049, 5000, 5001)]
    near = np.unique(np.concatenate([sets[8][300:], pick.integers(0, 1 << 63, 200).astype(np.uint64)]))
    sets.append(near)
    rows = [(1, i, i, len(g), bytearray(scheme.sketch(g, max(ngram_join.SHORT, 1 << len(g).bit_length())))) for i, g in enumerate(sets)]
    members = spark.createDataFrame(rows, "gid long, cls long, label long, n long, meeting binary")
    for block, block_bytes in ((4096, 4 << 20), (3, 2000)):
        assert [tuple(r) for r in ngram_join.block_pairs(members, scheme, block, block_bytes).collect()] == [(8, 10)]
    labels = members.select("cls", "label")
    marked = members.selectExpr("cls % 3 AS gid", "label").union(members.selectExpr("9L AS gid", "label").where("label in (8, 10, 3)"))
    marked = marked.distinct().selectExpr("gid", "label", "count(*) OVER (PARTITION BY gid) AS n_labels")
    assert [tuple(r) for r in ngram_join.label_pairs(marked, labels, members.select("cls", "n", "meeting"), scheme).distinct().collect()] == [(8, 10)]


def test_folding_never_refutes_a_link():
    scheme, pick = ngram_join.Scheme(75, 5, 0.15), np.random.default_rng(2)
    for n in (5, 300, 511, 513, 1023, 1025, 3000):
        own = np.unique(pick.integers(0, 1 << 63, n).astype(np.uint64))
        other = np.unique(np.concatenate([own[n // 8:], pick.integers(0, 1 << 63, n // 10).astype(np.uint64)]))
        sizes = np.array([len(own), len(other)])
        assert scheme.linked(len(np.intersect1d(own, other)), *sizes.tolist())
        sketches = [scheme.sketch(g, max(ngram_join.SHORT, 1 << len(g).bit_length())) for g in (own, other)]
        short = ngram_join.folded(sketches, ngram_join.SHORT // 8)
        for g, row in zip((own, other), short):
            assert row.tobytes() == scheme.sketch(g, ngram_join.SHORT)
        assert ngram_join.unrefuted(scheme, sizes, sketches, short, np.array([0]), np.array([1])).tolist() == [True]


CLASHES = ["__text", "_text", "__bytes", "bytes", "__row", "row", "ROW", "__slot", "slot", "__locator", "locator", "_metadata", "whole_text", "row_id"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, s, *(f"{c}{i}" for c in CLASHES if c != "ROW")) for i, (t, s) in enumerate(
        [("one two three", "a"), ("one two three", "b"), (None, None), ("", "a"), ("password = hunter22", "c")])]
    names = ["doc_id", "text", "source", *(c for c in CLASHES if c != "ROW")]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))


def stayed(result, docs, without=()):
    """Whether the result's rows carry the values of ``docs`` in all columns it has."""
    names = [c for c in docs.columns if c not in without]
    known = {tuple(r) for r in docs.select(names).collect()}
    rows = [tuple(r) for r in result.select(names).collect()]
    assert rows and set(rows) <= known
    return len(rows)


def test_clashing_names(spark, clashing, tmp_path):
    import corpus_pipeline

    docs = common.pin(clashing, "clashing")
    for table in (clashing, docs):
        assert stayed(exact_dedup.deduplicate(table), table) == 3
        assert stayed(ngram_join.keep_one(table), table) == 4
        assert stayed(mixing.mix(table, queries.MIX_WEIGHTS, 2), table) == 5
        placed = mixing.mix(table, queries.MIX_WEIGHTS, 2, places=True)
        assert stayed(placed, table, ["slot"]) == 5 and {"lane", "slot", "offset"} <= set(placed.columns)
        assert stayed(secrets.scan(table), table) == 5
        assert stayed(bpe.round_trip(table, queries.VOCABULARY), table) == 5
    spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.toxicity_filter(spark, docs, str(tmp_path)).columns == docs.columns
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert stayed(toxicity.score(docs, model), docs) == 5


def test_decoding_in_steps():
    with open(queries.VOCABULARY, encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary.read(file.read())
    words = [b" the", b" of", b" the" * 3, b"x", " é".encode()]
    lexicon = bpe.Lexicon(memoryview(bpe.compile_lexicon({w: vocabulary.merge(w) for w in words})))
    for word in [*words, b" th", b" they", b"", b" ofx", b"y"]:
        want = np.array(vocabulary.merge(word), "<u4").tobytes() if word in words else None
        assert [lexicon.find(word, head) for head in (1, 3, 5, 5)] == [want] * 4
        lexicon.heads.clear()
    codec, pick = bpe.Codec(vocabulary, lexicon), random.Random(4)
    for text in ["", "a", "é日本\0 <|endoftext|>", "".join(pick.choices("ab é日\n.", k=5000))]:
        ids = codec.encode(text)
        assert codec.decode(ids) == codec.decode(ids, 3) == text
    odd = np.array([i for i, t in enumerate(vocabulary.tokens) if t in (b"\xc3", b"\xa9", b"a")] * 2, "<u4")
    want = b"".join(vocabulary.tokens[i] for i in odd).decode("utf-8", "replace")
    assert codec.decode(odd.tobytes()) == codec.decode(odd.tobytes(), 1) == want
    assert hashlib.sha256(codec.decode(b"").encode()).hexdigest() == hashlib.sha256(b"").hexdigest()


def test_connect_leaves_little_on_the_driver(spark, monkeypatch):
    """Garbage of finished steps goes after each turn, the smallest label of a component wins, and no turn joins once more to see what changed."""
    pick, settled, joined = random.Random(8), [], []
    settle, frame = common.settle, type(spark.range(1))
    join = frame.join
    monkeypatch.setattr(common, "settle", lambda s: (settled.append(1), settle(s)))
    monkeypatch.setattr(frame, "join", lambda *a, **b: (joined.append(1), join(*a, **b))[1])
    order = pick.sample(range(1000), 60)
    links = list(zip(order, order[1:40])) + list(zip(order[41:], order[42:])) + [(order[0], order[0])]
    pick.shuffle(links)
    labels = spark.createDataFrame([(i, i) for i in order], "cls long, label long")
    found = {r["cls"]: r["label"] for r in ngram_join.connect(labels, spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: min(part) for part in (order[:40], order[40:41], order[41:]) for i in part}
    # Two joins find the edges and one moves the labels; a turn has three.
    assert len(settled) > 1 and len(joined) == 3 + 3 * len(settled)


def test_small_sides_are_not_broadcast_late(spark, monkeypatch):
    seen, key, groups = [], "spark.sql.adaptive.autoBroadcastJoinThreshold", ngram_join.groups
    monkeypatch.setattr(ngram_join, "groups", lambda *a, **b: (seen.append(spark.conf.get(key, None)), groups(*a, **b))[1])
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "h i")], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in ngram_join.join(docs).collect()} == {1: 1, 2: 1, 3: 3}
    assert seen == ["-1"] and spark.conf.get(key, None) == before


def test_a_hub_gives_a_row_a_node(spark, monkeypatch):
    """What neighbours offer is one row a node before it is handed on, however many links a node has."""
    made, frame = [], type(spark.range(1))
    select = frame.select

    def counted(self, *columns):
        out = select(self, *columns)
        if out.columns == ["u", "root", "was"] and "rv" in self.columns:
            made.append(select(self, "u").count())
        return out

    monkeypatch.setattr(frame, "select", counted)
    labels = spark.createDataFrame([(i, i) for i in range(30)], "cls long, label long")
    links = spark.createDataFrame([(a, b) for a in range(30) for b in range(a)], "a long, b long")
    assert {r["label"] for r in ngram_join.connect(labels, links).collect()} == {0}
    assert made and max(made) == 30  # 870 directed links

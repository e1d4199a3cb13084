"""Toxic words in any script, readings against all paths of small lattices, and places of rows however ids are spread."""

import itertools
import random

import numpy as np

from tidemark.llm import mixing, toxicity


def all_paths(restorer, stretch):
    """The least cost over every path of the stretch's lattice, and the readings that have it."""
    costs = {}
    for path in itertools.product(*restorer.lattice(toxicity.RUN.sub(r"\1\1\1", stretch))):
        text, cost = "".join(t for t, _ in path), sum(c for _, c in path)
        numbers = [0, 0, *(restorer.number.get(c, toxicity.OTHER) for c in text + " ")]
        cost -= sum(float(restorer.scores[a, b, c]) for a, b, c in zip(numbers, numbers[1:], numbers[2:]))
        costs[text.strip()] = min(cost, costs.get(text.strip(), np.inf))
    least = min(costs.values())
    return {text for text, cost in costs.items() if cost < least + 1e-6}


def test_readings_are_the_best_of_all_paths():
    draw, pick = np.random.default_rng(8), random.Random(8)
    restorer = toxicity.Restorer(np.log(draw.dirichlet(np.full(toxicity.SIZE, 0.05), (toxicity.SIZE, toxicity.SIZE)) + 1e-9).astype(np.float32))
    for _ in range(300):
        stretch = "".join(pick.choice("abeios014$!|ж") * pick.choice((1, 1, 1, 2, 3, 5)) for _ in range(pick.randint(1, 5)))
        assert restorer.decode(stretch) in all_paths(restorer, stretch), stretch
        spaced = pick.choice(" .-").join(pick.choices("abio1$", k=pick.randint(3, 6)))
        assert restorer.decode(spaced) in all_paths(restorer, spaced), spaced


WORDS = ["идиот", "дурак", "바보", "멍청이", "głupi", "żałosny", "idiot", "ηλίθιος", "मूर्ख"]


def test_toxicity_in_any_script(spark):
    rows = [(i, f"добрый день 좋은 날 dobry dzień καλή μέρα अच्छा दिन {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}lo " + (WORDS[i // 4 % len(WORDS)] if i % 4 == 0 else "друг"))
            for i in range(1800)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert {f" {word} " if len(word) > 2 else f" {word}" for word in WORDS} <= set(model.terms)
    toxic = [f"добрый {word} день" for word in WORDS] + ["ИДИОТ!", "идиооооот", "바보야", "и д и о т", "GŁUPI", "żałosnyyyyy"]
    clean = ["добрый день друг", "좋은 날", "dobry dzień", "καλή μέρα", "अच्छा दिन", "друууууг", None, "", "١٢٣ 2024"]
    cases = spark.createDataFrame(list(enumerate([*toxic, *clean])), "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score(cases, model).collect()}
    assert [text for i, text in enumerate([*toxic, *clean]) if got[i] != int(i < len(toxic))] == []


def test_words_keep_marks_and_letters():
    assert toxicity.words_of("ты, głupi_मूर्ख42 바보").split() == ["ты", "głupi", "मूर्ख", "바보"]
    assert {" ab ", " баб ", " ба", " баб"} <= toxicity.features(" ab баб x ")
    assert " ab" not in toxicity.features(" ab x ") and " x " not in toxicity.features(" ab x ")
    assert f" {'a' * 40} " in toxicity.features(f" {'a' * 40} ")


def test_places_however_ids_are_spread(spark):
    pick = random.Random(3)
    for ids in ([pick.randint(-(1 << 62), 1 << 62) for _ in range(500)], [None] * 500, [7] * 400 + list(range(100))):
        rows = [(i, "b" if k % 5 == 0 else "a") for k, i in enumerate(ids)]
        placed = mixing.place(spark.createDataFrame(rows, "doc_id long, source string").repartition(6), {"a": 3, "b": 2}, 4)
        got = {}
        for r in placed.collect():
            got.setdefault(r["lane"], []).append((r["block"], r["offset"], r["doc_id"]))
        for lane, found in got.items():
            found.sort(key=lambda r: r[:2])
            want = sorted((i for i, s in rows if s == lane), key=lambda i: (i is not None, i))
            assert found == [(at // 4 + 1, at % 4, i) for at, i in enumerate(want)]
        assert sum(map(len, got.values())) == 500


def test_no_task_sorts_a_lane(spark):
    """Rows of one lane are numbered from a range partitioning; the only windows left are over counts and over the period."""
    rows = spark.range(100).selectExpr("id AS doc_id", "'a' AS source")
    plan = mixing.place(rows, {"a": 1}, 4)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_columns_count_what_features_name(spark):
    """Terms counted over columns of words, whole words and beginnings, are those that each text's set of features names."""
    pick = random.Random(11)
    texts = [toxicity.words_of("".join(pick.choices(["ab", "abc", "abcdefgh", "é", "баб", "ба", "б", "バカ", "ɐb", " ", " ", ".", "x"], k=pick.randint(0, 9)))) for _ in range(400)]
    rows = spark.createDataFrame([(i % 3 % 2, text) for i, text in enumerate(texts)], "toxic int, words string").repartition(3)
    for beginnings, of_text in ((False, toxicity.whole_words), (True, toxicity.features)):
        want = {}
        for i, text in enumerate(texts):
            for term in of_text(text):
                want.setdefault(term, [0, 0])[i % 3 % 2] += 1
        for piece, bound in ((1 << 24, 1 << 20), (64, 1)):
            got = {r["term"]: [r["clean"], r["toxic"]] for r in toxicity.counted_terms(rows, beginnings, piece, bound).collect()}
            assert got == want
    assert toxicity.counted_terms(rows.limit(0), True).count() == 0


def test_words_of_both_paths():
    pick = random.Random(12)
    for _ in range(3000):
        text = "".join(pick.choices("ab é.1_ß\x85\xa0µ×\n’Жै́", weights=[4] * 13 + [1] * 4, k=pick.randint(0, 9)))
        assert toxicity.words_of(text) == f" {toxicity.NOT_LETTERS.sub(' ', text)} "


def test_marked_texts_are_cut_as_restored():
    """A text restored once and cut when the words are known reads as one restored with the words."""
    draw, pick = np.random.default_rng(9), random.Random(9)
    scores = np.log(draw.dirichlet(np.full(toxicity.SIZE, 0.05), (toxicity.SIZE, toxicity.SIZE)) + 1e-9).astype(np.float32)
    for words in (None, {}, {"abc": 1.0, "de": 0.5, "ab": 2.0}):
        whole, marks, cut = toxicity.Restorer(scores, words), toxicity.Restorer(scores, marks=True), toxicity.Restorer(scores, words)
        for _ in range(300):
            text = " ".join(pick.choices(["a b c d e", "a.b.1", "x-y-z-a-b-c", "\0", "a\0b", "w0rd", "soooo", "Plain", "\0\0a b c\0", "..."], k=4))
            assert toxicity.words_of(cut.cut_marked(marks.restore(text))) == toxicity.words_of(whole.restore(text).replace("\0", "\1"))


def test_labelled_texts_are_restored_once(spark, monkeypatch):
    seen, marked = [], toxicity.marked
    monkeypatch.setattr(toxicity, "marked", lambda *a: (seen.append(1), marked(*a))[1])
    docs = spark.createDataFrame([(i, "you i d i o t" if i % 2 else "good d a y to all") for i in range(40)], "doc_id long, text string")
    toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    assert len(seen) == 1

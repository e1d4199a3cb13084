"""Toxicity by noisy-channel deobfuscation: suspicious stretches become character lattices, Viterbi finds their likeliest reading
under a character language model of the corpus, and the restored text is scored.

The model counts character trigrams of all texts over a fixed alphabet. The classifier is a logistic regression on beginnings
of words that labelled, restored texts show; it is fitted by Spark on every labelled row that may teach.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Matrices, SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common

#: Fixed alphabet: word boundary, Latin letters of the basic and the Latin-1 block, and one class for all else.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIZE = len(LETTERS) + 2
OTHER = SIZE - 1
#: Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e"}
#: Channel costs in nats: a sign read as a letter, a sign kept, a run shortened to one or two, a separator dropped or kept.
COST_LETTER, COST_SIGN, COST_ONE, COST_TWO, COST_JOIN, COST_APART = 0.5, 9.0, 0.3, 1.2, 0.2, 6.0

_L = r"[^\W\d_]"  # a letter of any script
_S = r"[0-9@$!|+€]"
_A = rf"(?:{_L}|{_S})"
#: From where a run of letters and signs begins: s p a c e d from three on, with a letter among a short run's; letters and signs mixed in
#: any order (l33t, h473, 5h17, a$$); letters with a run of repeats (repeeeat). What of it is a word, lattice and model decide.
SUSPICIOUS = re.compile(
    rf"(?<!{_A})(?:(?={_A}[ ._*-]{_A}[ ._*-])(?<![^\s.,;:])"
    rf"(?:(?:{_A}[ ._*-]){{3,}}{_A}(?!{_A})|(?=(?:{_S}[ ._*-]){{0,2}}{_L})(?:{_A}[ ._*-]){{2}}{_A}(?!{_A}))"
    rf"|(?:{_L}++{_S}|{_S}++{_L}){_A}*+|{_L}*?({_L})\1\1{_A}*+)")
#: Readings of longer stretches are not remembered; a word of a spaced phrase has at most as many letters.
LONGEST = 48
#: Runs that are shortened to three before a stretch is read.
RUN = re.compile(r"(.)\1{3,}")
#: Stand around the reading of a spaced phrase that is not cut yet, and for that character where a text has it: neither is part of a word or a phrase.
MARK, NO_MARK = "\0", "\1"
MARKED = re.compile(f"{MARK}([^{MARK}]*){MARK}")
NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
#: Words that begin beyond the Latin blocks are told apart by fewer letters.
BEYOND_LATIN = "\u0250"


def index_table() -> np.ndarray:
    """Alphabet numbers by code point below 0x250; white space is the boundary 0."""
    table = np.full(0x250, OTHER, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 0
    for i, letter in enumerate(LETTERS):
        table[ord(letter)] = i + 1
    return table


def count_trigrams(docs: DataFrame) -> np.ndarray:
    """Trigram counts over every text of ``docs``: a cube of ``SIZE``; tasks count their own texts, sums are shuffled."""
    def run(batches):
        table, total = index_table(), np.zeros(SIZE ** 3, np.int64)
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            text = " ".join(["", *(v.as_py().lower() for v in batch.column(0)), ""])
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            numbers = table[np.minimum(points, 0x24F)].astype(np.int32)
            total += np.bincount((numbers[:-2] * SIZE + numbers[1:-1]) * SIZE + numbers[2:], minlength=SIZE ** 3)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"trigram": hit.astype(np.int64), "n": total[hit]})

    counted = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(common.lean(run), "trigram long, n long")
    cube = np.zeros(SIZE ** 3, np.int64)
    for row in counted.groupBy("trigram").agg(F.sum("n").alias("n")).toLocalIterator():  # at most SIZE ** 3 rows
        cube[row["trigram"]] = row["n"]
    return cube.reshape(SIZE, SIZE, SIZE)


def log_probabilities(cube: np.ndarray) -> np.ndarray:
    """Natural log of P(c | a, b), trigrams interpolated with bigrams and single characters."""
    three = cube.astype(np.float64)
    two, one = three.sum(0), three.sum((0, 1))
    p1 = (one + 1) / (one + 1).sum()
    p2 = (two + 5 * p1[None, :]) / (two.sum(1, keepdims=True) + 5)
    p3 = (three + 5 * p2[None, :, :]) / (three.sum(2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


def is_spaced(stretch: str) -> bool:
    return len(stretch) >= 5 and all(c in " ._*-" for c in stretch[1::2])


class Restorer:
    """Viterbi over character lattices; spaced phrases are cut into words by ``words``, the cost of each known word.

    With ``marks`` they are left as read, between two ``MARK``, for :meth:`cut_marked` to cut once the words are known.
    """

    def __init__(self, scores: np.ndarray, words: dict[str, float] | None = None, bound: int = 100_000, marks: bool = False):
        self.scores = scores
        self.words = words or {}
        self.marks = marks
        self.number = {letter: i + 1 for i, letter in enumerate(LETTERS)} | {" ": 0}
        self.known: dict[str, str] = {}
        self.bound = bound

    def lattice(self, stretch: str) -> list[list[tuple[str, float]]]:
        """The readings of each place: (what it stands for, cost)."""
        spaced = is_spaced(stretch)
        places, at = [], 0
        while at < len(stretch):
            char, end = stretch[at], at + 1
            while end < len(stretch) and stretch[end] == char:
                end += 1
            times = end - at
            if spaced and at % 2:
                places.append([("", COST_JOIN), (" ", COST_APART)])
            elif char in LEET:
                if char == "!" and end == len(stretch) and at:  # letters, or only the end of a sentence
                    places.append([("", 0.0), *((letter * times, COST_LETTER * times) for letter in LEET[char])])
                elif times >= 3:
                    places.append([*((letter * n, COST_LETTER + cost) for letter in LEET[char] for n, cost in ((1, COST_ONE), (2, COST_TWO))),
                                   (char * times, COST_SIGN * times)])
                else:
                    places += [[*((letter, COST_LETTER) for letter in LEET[char]), (char, COST_SIGN)]] * times
            elif times >= 3:
                places.append([(char, COST_ONE), (char * 2, COST_TWO)])
            else:
                places += [[(char, 0.0)]] * times
            at = end
        return places

    def decode(self, stretch: str) -> str:
        """The reading of least cost: channel plus language model, from word boundary to word boundary."""
        number, scores = self.number, self.scores
        beams = {(0, 0): (0.0, None)}  # the last two characters: cost, and what was read as (before, text)
        for place in [*self.lattice(RUN.sub(r"\1\1\1", stretch)), [(" ", 0.0)]]:
            ahead: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, read) in beams.items():
                for text, extra in place:
                    x, y, total = a, b, cost + extra
                    for char in text:
                        c = number.get(char, OTHER)
                        total -= float(scores[x, y, c])
                        x, y = y, c
                    if (x, y) not in ahead or total < ahead[x, y][0]:
                        ahead[x, y] = (total, (read, text))
            beams = ahead
        read, texts = min(beams.values(), key=lambda beam: beam[0])[1], []
        while read is not None:
            read, text = read
            texts.append(text)
        whole = "".join(reversed(texts)).strip()
        if not is_spaced(stretch):
            return whole
        return f"{MARK}{whole}{MARK}" if self.marks else self.cut(whole.replace(" ", "")) if self.words else whole

    def cut(self, letters: str) -> str:
        """``letters`` in words at least cost: known ones by their frequency, others by the character model and the cost of a boundary."""
        number, scores = self.number, self.scores
        best: list[tuple[float, int]] = [(0.0, 0)] + [(np.inf, 0)] * len(letters)
        for start in range(len(letters)):
            x, y, total = 0, 0, best[start][0]
            for end in range(start + 1, min(start + LONGEST, len(letters)) + 1):
                c = number.get(letters[end - 1], OTHER)
                total -= float(scores[x, y, c])
                x, y = y, c
                other = total - float(scores[x, y, 0]) + COST_APART
                known = self.words.get(letters[start:end])
                cost = other if known is None else min(other, best[start][0] + known)
                if cost < best[end][0]:
                    best[end] = (cost, start)
        words, end = [], len(letters)
        while end:
            start = best[end][1]
            words.append(letters[start:end])
            end = start
        return " ".join(reversed(words))

    def _replace(self, match) -> str:
        stretch = match.group()
        read = self.known.get(stretch)
        if read is None:
            read = self.decode(stretch)
            if len(stretch) <= LONGEST:
                if len(self.known) >= self.bound:
                    self.known.clear()
                self.known[stretch] = read
        return read

    def restore(self, text: str) -> str:
        """The text in lower case with every suspicious stretch replaced by its likeliest reading."""
        text = text.lower()
        return SUSPICIOUS.sub(self._replace, text.replace(MARK, NO_MARK) if self.marks else text)

    def cut_marked(self, marked: str) -> str:
        """What :meth:`restore` gives for the text that is ``marked`` by a restorer of the same scores."""
        return MARKED.sub(self._cut_match, marked) if MARK in marked else marked

    def _cut_match(self, match) -> str:
        whole = match[1]
        if not self.words:
            return whole
        read = self.known.get(whole)
        if read is None:
            read = self.cut(whole.replace(" ", ""))
            if len(whole) <= LONGEST:
                if len(self.known) >= self.bound:
                    self.known.clear()
                self.known[whole] = read
        return read


#: The Latin-1 characters, letters as they are and a space for each other one.
LATIN = "".join(NOT_LETTERS.sub(" ", chr(c)) for c in range(256)).encode("latin-1")


def words_of(text: str) -> str:
    """Letters of any script and their marks only, one space before, between and after words; one more at an end where other characters were."""
    try:
        letters = text.encode("latin-1").translate(LATIN).decode("latin-1")
    except UnicodeEncodeError:
        return f" {NOT_LETTERS.sub(' ', text)} "
    words = " ".join(letters.split())
    if not words:
        return "   " if text else "  "
    return f"{'  ' if letters[0] == ' ' else ' '}{words}{'  ' if letters[-1] == ' ' else ' '}"


@lru_cache(1 << 16)
def of_word(word: str) -> tuple[str, ...]:
    """Beginnings of three to seven letters of a word (of two on in other scripts than Latin), and the whole word of two or more."""
    n = len(word)
    starts = [f" {word[:k]}" for k in range(3 if word < BEYOND_LATIN else 2, min(n, 7) + 1)]
    return (*starts, f" {word} ") if n > 1 else tuple(starts)


def features(words: str) -> set[str]:
    """What :func:`of_word` gives for each word of a text."""
    return {term for word in set(words.split()) for term in of_word(word)}


def whole_words(words: str) -> set[str]:
    """The words of two letters or more."""
    return {word for word in words.split() if len(word) > 1}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def marked(docs: DataFrame, scores, carry: list[str]) -> DataFrame:
    """Columns ``carry`` and ``marked``: the restored text with its spaced phrases marked, for :func:`words_in`."""
    (whole_text,) = common.fresh(docs, "whole_text")
    rows = docs.select(*carry, F.coalesce("text", F.lit("")).alias(whole_text))

    def run(batches):
        restorer = Restorer(scores.value, marks=True)
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            texts = [restorer.restore(v.as_py()) for v in batch.column(whole_text)]
            kept = batch.drop_columns([whole_text])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(texts, pa.string())], names=[*kept.schema.names, "marked"])

    return rows.mapInArrow(common.lean(run), T.StructType([*rows.schema.fields[:-1], T.StructField("marked", T.StringType())]))


def words_in(rows: DataFrame, scores, known: dict[str, float] | None = None) -> DataFrame:
    """(toxic, words), distinct, of ``rows`` (toxic, marked): texts as :func:`words_of` gives them, spaced phrases cut with the ``known`` words."""
    def run(batches):
        restorer = Restorer(scores.value, known)
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            words = [words_of(restorer.cut_marked(text)) for text in batch.column("marked").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(words, pa.string())], names=["toxic", "words"])

    return rows.select("toxic", "marked").mapInArrow(common.lean(run), T.StructType([rows.schema["toxic"], T.StructField("words", T.StringType())])).distinct()


@dataclass
class Model:
    """Character model, and the classifier's terms with their weights."""

    scores: np.ndarray
    terms: list[str]
    weights: np.ndarray
    intercept: float
    words: dict[str, float] | None = None


def counted_terms(rows: DataFrame, beginnings: bool, piece: int = 16 << 20, bound: int = 1_000_000) -> DataFrame:
    """(term, clean, toxic): in how many clean and toxic ``rows`` (toxic, words) a term is, of those that :func:`features` gives for words,
    without ``beginnings`` those of :func:`whole_words`.

    A task takes about ``piece`` bytes of words apart at a time, as columns, and holds about ``bound`` counts.
    """
    def counts(toxic: np.ndarray, words: pa.Array):
        """Tables of term, clean and toxic, the terms of a table distinct."""
        lists = pc.split_pattern(words, " ")
        coded = lists.flatten().dictionary_encode()
        row, word, known = pc.list_parent_indices(lists).to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64), coded.dictionary
        length = pc.utf8_length(known).to_numpy()

        def of(chosen: np.ndarray, terms: pa.Array, before: str, after: str):
            """The count of each term: ``terms`` are those of the ``chosen`` words."""
            coded = terms.dictionary_encode()
            number = np.full(len(known), -1, np.int64)
            number[chosen] = coded.indices.to_numpy()
            there = number[word] >= 0
            size = max(1, len(coded.dictionary))
            seen = np.unique(row[there] * size + number[word[there]])
            n = [np.bincount(seen[toxic[seen // size] == label] % size, minlength=len(coded.dictionary)) for label in (0, 1)]
            names = pc.binary_join_element_wise(before, coded.dictionary, after, "")
            return pa.table({"term": names, "clean": pa.array(n[0], pa.int64()), "toxic": pa.array(n[1], pa.int64())})

        several = length > 1
        if not beginnings:
            yield of(np.flatnonzero(several), known.filter(pa.array(several)), "", "")
            return
        yield of(np.flatnonzero(several), known.filter(pa.array(several)), " ", " ")
        beyond = pc.greater_equal(known, BEYOND_LATIN).to_numpy(zero_copy_only=False)
        for k in range(2, 8):
            enough = (length >= k) if k > 2 else (length >= k) & beyond
            yield of(np.flatnonzero(enough), pc.utf8_slice_codeunits(known.filter(pa.array(enough)), 0, k), " ", "")

    def count(batches):
        held, size = [], 0

        def emit():
            if held:
                summed = pa.concat_tables(held).group_by("term").aggregate([("clean", "sum"), ("toxic", "sum")])
                held.clear()
                yield from summed.select(["term", "clean_sum", "toxic_sum"]).rename_columns(["term", "clean", "toxic"]).to_batches(max_chunksize=20_000)

        for batch in (part for whole in batches for part in common.by_bytes(whole, "words", piece)):
            for table in counts(batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64), batch.column("words")):
                held.append(table)
                size += table.num_rows
            if size >= bound:
                yield from emit()
                size = 0
        yield from emit()

    return common.pin(rows.mapInArrow(common.lean(count), "term string, clean long, toxic long").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "terms")


def fit(docs: DataFrame, labels: DataFrame, terms: int = 1500, least: int = 3, lexicon: int = 50_000) -> Model:
    """The character model from all of ``docs``; the classifier from every labelled row that may teach, equal texts once.

    Rows whose crc32(doc_id as text) mod 3 is 1 teach nothing. Spaced phrases are cut into words with the help of the ``lexicon``
    commonest words of the labelled rows, and by the character model for others. ``terms`` word beginnings that mark toxic texts best
    enter the regression; both bound the model, not the rows it is counted and fitted on. With no labelled
    row of one of the classes the classifier has no terms and every score is the same low one.
    """
    with common.scratch(docs.sparkSession):
        return _fit(docs, labels, terms, least, lexicon)


def _fit(docs: DataFrame, labels: DataFrame, terms: int, least: int, lexicon: int) -> Model:
    spark = docs.sparkSession
    scores = log_probabilities(count_trigrams(docs))
    shared = spark.sparkContext.broadcast(scores)
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = common.pin(docs.select("doc_id", "text").join(common.pin(usable, "usable"), "doc_id").select("toxic", "text").distinct(), "labelled")

    n = F.col("clean") + F.col("toxic")
    read = common.pin(marked(labelled, shared, ["toxic"]), "marked")
    first = counted_terms(words_in(read, shared), False)
    frequent = first.where(n > 1).select(F.col("term").alias("word"), n.alias("n")).orderBy(F.desc("n"), "word").limit(lexicon).collect()
    total = sum(row["n"] for row in frequent)
    known = {row["word"]: float(np.log(total / row["n"])) for row in frequent}
    # The classifier learns from texts restored as score() restores them.
    rows = common.pin(words_in(read, shared, known), "restored")
    counted = counted_terms(rows, True)
    gain = F.col("toxic") - 10 * F.col("clean")
    found = counted.where((F.col("toxic") >= least) & (gain > 0)).orderBy(gain.desc(), F.length("term").desc(), "term").limit(terms).collect()
    chosen_terms = {row["term"] for row in found}
    # A word of two letters that is a term as a beginning says nothing more as a whole word.
    names = [row["term"] for row in found if not (len(row["term"]) == 4 and row["term"].rstrip() in chosen_terms)]
    classes = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    if not names or len(classes) < 2:
        return Model(scores, [], np.zeros(0), -4.0, known)

    def hits(batches):
        find = term_finder(names)
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic").cast(pa.int64()),
                "hits": pa.array([sorted(find(w)) for w in batch.column("words").to_pylist()], pa.list_(pa.int64()))})

    seen = common.pin(rows.mapInArrow(hits, "toxic long, hits array<long>").groupBy("toxic", "hits").count(), "hits")  # rows with the same hits are one
    weights, intercept = logistic(seen, len(names), classes)
    return Model(scores, names, weights, intercept, known)


def logistic(seen: DataFrame, size: int, classes: dict[int, int], penalty: float = 0.3, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-penalised logistic regression; weights are not negative, as terms only speak for toxicity.

    ``seen`` are (toxic, hits, count), hits below ``size``; classes, of ``classes`` rows each, are weighted alike, 1000 together. Spark
    adds up the gradients, so no row comes to the driver.
    """
    vector = F.udf(lambda hits: SparseVector(size, hits, [1.0] * len(hits)), VectorUDT())
    share = F.when(F.col("toxic") == 1, F.lit(500.0 / classes[1])).otherwise(F.lit(500.0 / classes[0]))
    training = seen.select(F.col("toxic").cast("double").alias("label"), (F.col("count") * share).alias("weight"), vector("hits").alias("features"))
    model = LogisticRegression(
        maxIter=rounds, regParam=penalty / 1000, standardization=False, weightCol="weight", family="binomial",
        lowerBoundsOnCoefficients=Matrices.dense(1, size, [0.0] * size)).fit(training)
    return model.coefficients.toArray(), float(model.intercept)


def term_finder(names: list[str]):
    """A function from :func:`words_of` text to the numbers of the terms in it."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for i, name in enumerate(names):
        automaton.add_word(name, i)
    automaton.make_automaton()
    return lambda words: {i for _, i in automaton.iter(words)}


def score(docs: DataFrame, model: Model, carry: list[str] | None = None, text: str = "text") -> DataFrame:
    """Columns ``carry`` of ``docs`` (all by default), ``score`` (0 to 1, higher: toxic is likelier) and ``predicted`` (1 from 0.7 on).

    Only the text is looked at. Null and empty texts get the score of a text without any term; long texts are restored and
    scored whole; equal texts get equal scores; an empty table gives an empty result; columns already called ``score`` or
    ``predicted`` are replaced.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast((model.scores, model.terms, np.asarray(model.weights), model.intercept, model.words))
    (whole_text,) = common.fresh(docs, "whole_text")
    rows = docs.select(*carry, F.coalesce(text, F.lit("")).alias(whole_text))

    def run(batches):
        scores, terms, weights, intercept, known = shared.value
        restorer, find = Restorer(scores, known), term_finder(terms) if terms else lambda words: ()
        for batch in (piece for whole in batches for piece in common.slices(whole)):
            sums = np.array([intercept + sum(weights[i] for i in sorted(find(words_of(restorer.restore(v.as_py()))))) for v in batch.column(whole_text)])
            chance = 1 / (1 + np.exp(-sums))
            kept = batch.drop_columns([whole_text])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(chance, pa.float64()), pa.array((chance >= 0.7).astype(np.int32))],
                names=[*kept.schema.names, "score", "predicted"])

    return rows.mapInArrow(common.lean(run), T.StructType([
        *rows.schema.fields[:-1], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted; the model is fitted on the same tables."""
    return score(docs, fit(docs, labels), carry=["doc_id"]).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

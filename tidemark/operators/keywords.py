"""Word counts and keyword to document matching on whole texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import TOKEN_BREAK
from tidemark.operators.ranking import top_per_key
from tidemark.session import pin


def token_rows(df: DataFrame, text: str, *keys: str, stop_words: Iterable[str] = (), drop_category: str | None = None,
               distinct: bool = False) -> DataFrame:
    """``keys, word``: one row per token, or per distinct token of a text.

    The token rule of :mod:`tidemark.functions.text`, with the tests on single words after the
    explode, where they are compiled instead of interpreted per array.
    """
    pieces = F.split(F.lower(text), TOKEN_BREAK)
    words = df.select(*keys, F.explode(F.array_distinct(pieces) if distinct else pieces).alias("word"))
    words = words.filter(F.length("word") > 1)
    stop = [word.lower() for word in stop_words]
    if stop:
        words = words.filter(~F.col("word").isin(*stop))
    return words.filter(F.col("word") != F.lower(drop_category)) if drop_category else words


def word_counts(df: DataFrame, text: str, *keys: str, stop_words: Iterable[str] = (), drop_category: str | None = None) -> DataFrame:
    """``keys, word, count``: partial counts in each task, then one shuffle of distinct words."""
    words = token_rows(df, text, *keys, stop_words=stop_words, drop_category=drop_category)
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("count"))


def top_words(counts: DataFrame, key: str, n: int = 15) -> DataFrame:
    """The ``n`` most frequent words per category, word order breaking ties."""
    return top_per_key(counts, [key], [F.col("count").desc(), F.col("word").asc()], n)


def documents_with(df: DataFrame, doc: str, text: str, key: str, words: DataFrame) -> DataFrame:
    """Each chosen word with every document of its category that has it as a token.

    Tokens are made distinct inside the row, then joined on (category, word). The chosen words are
    written first, so that their measured size decides at planning time: under the threshold they
    are broadcast and the tokens are not shuffled, beyond it AQE splits hot words.
    """
    words = pin(words.select(key, "word"))
    found = token_rows(df, text, doc, key, distinct=True)
    return found.join(words, [key, "word"])


def first_documents(matches: DataFrame, key: str, doc: str, n: int = 3) -> DataFrame:
    """The first ``n`` documents of each word, in document order."""
    return top_per_key(matches, [key, "word"], [F.col(doc).asc()], n)

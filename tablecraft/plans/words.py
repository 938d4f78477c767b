"""The most used words that are not stop words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft import fixed_values as fixed
from tablecraft.operators import exclude, top_rows, word_counts
from tablecraft.sources import inline_lookup


def stop_word_list(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """Stop words listed by the caller; longer lists come from a file, one word per line."""
    return inline_lookup(spark, [(word,) for word in words], "word string")


def interesting_words(texts: DataFrame, stop_words: DataFrame, text: str = "value") -> DataFrame:
    """Word counts without the stop words (column ``word``).

    Stop words go after counting: by then each word is one row, already shuffled by word.
    """
    return exclude(word_counts(texts, text), stop_words, "word")


def top_words(texts: DataFrame, stop_words: DataFrame, text: str = "value", n: int = fixed.TOP_WORDS) -> DataFrame:
    counted = interesting_words(texts, stop_words, text)
    return top_rows(counted, [F.desc("n"), F.asc("word")], n)

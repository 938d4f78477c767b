"""Word frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.functions import words_of


def word_counts(df: DataFrame, text: str = "value") -> DataFrame:
    """How often each word occurs: columns ``word`` and ``n``."""
    words = df.select(F.explode(words_of(text)).alias("word")).filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))

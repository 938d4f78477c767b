"""Aggregates. All of them combine inside each map task before any row is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Key = Column | str


def global_sum(df: DataFrame, value: Key, name: str = "total") -> DataFrame:
    return df.agg(F.sum(value).alias(name))


def global_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def grand_total(counted: DataFrame, value: str = "total") -> DataFrame:
    """Total of a column of an earlier result."""
    return counted.agg(F.sum(value).alias(value))


def count_per(df: DataFrame, keys: Key | Sequence[Key], name: str = "n") -> DataFrame:
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def extremes_per(df: DataFrame, key: Key, value: str, label: str = "score", as_text: bool = False) -> DataFrame:
    """Largest and smallest value per group; ``as_text`` compares character by character."""
    measure = F.col(value).cast("string") if as_text else F.col(value)
    return df.groupBy(key).agg(
        F.max(measure).alias(f"max_{label}"), F.min(measure).alias(f"min_{label}")
    )

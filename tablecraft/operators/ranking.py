"""Top rows, with the tie-break spelled out by the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows: each task keeps ``n`` rows, there is no full sort."""
    return df.orderBy(*order).limit(n)


def top_rows_per(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows per group with their rank from 1.

    Spark cuts each group to ``n`` rows inside the map tasks before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, place).filter(F.col(rank) <= n)

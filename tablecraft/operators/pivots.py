"""Pivots. A given value list saves the job that finds the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stats_pivot(
    df: DataFrame, key: str, column: str, value: str, values: Sequence | None = None, digits: int = 2
) -> DataFrame:
    """Rounded mean and sample deviation per group and pivot value.

    Columns are ``<value>_average_score`` and ``<value>_standard_deviation_score``. A
    single row has no deviation (null).
    """
    measure = F.col(value).cast("double")
    return (
        df.groupBy(key)
        .pivot(column, None if values is None else list(values))
        .agg(
            F.round(F.avg(measure), digits).alias("average_score"),
            F.round(F.stddev_samp(measure), digits).alias("standard_deviation_score"),
        )
    )


def count_pivot(df: DataFrame, key: str, column: str, values: Sequence) -> DataFrame:
    """Rows per group and listed value, 0 where there are none."""
    return df.groupBy(key).pivot(column, list(values)).count().na.fill(0, list(map(str, values)))

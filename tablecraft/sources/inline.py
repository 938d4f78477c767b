"""Rows held by the caller."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

BROADCAST_ROWS = 10_000

LOG_SCHEMA = StructType([
    StructField("level", StringType(), nullable=False),
    StructField("datetime", StringType(), nullable=False),
])


def inline_values(spark: SparkSession, values: Iterable, type_name: str) -> DataFrame:
    """A one-column frame ``value`` of the given type."""
    return spark.createDataFrame([(value,) for value in values], f"value {type_name}")


def inline_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: StructType | str = LOG_SCHEMA
) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def inline_lookup(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A lookup whose rows the caller lists; up to ``BROADCAST_ROWS`` of them are broadcast.

    Spark cannot tell the size of such a frame, so without the hint it would shuffle
    the large side of a join for a handful of rows. A longer list is joined by shuffle.
    """
    frame = inline_rows(spark, rows, schema)
    return F.broadcast(frame) if len(rows) <= BROADCAST_ROWS else frame

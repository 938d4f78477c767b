"""Pearson correlation of every pair of numeric columns, at one reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Columns of a block. An aggregate row holds the sums of all pairs of two blocks.
BLOCK = 2


def numeric_candidates(df: DataFrame, drop: Sequence[str] = ()) -> list[str]:
    """Numeric columns that remain after dropping ``drop``; unknown names are ignored."""
    kept = df.drop(*drop)
    return [field.name for field in kept.schema.fields if isinstance(field.dataType, NumericType)]


def pearson(a: str, b: str) -> Column:
    """Correlation over the rows that have both values; null if either never varies there.

    The built-in correlation raises on a constant column in ANSI mode. The squared one
    does not: it is null if ``b`` is constant, and 1 beside a covariance of 0 if ``a`` is.
    """
    squared, covariance = F.regr_r2(a, b), F.covar_pop(a, b)
    return F.when((covariance != 0) | (squared != 1), F.signum(covariance) * F.sqrt(squared))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(column_a, column_b, correlation)`` for all ordered pairs, itself included.

    Columns are put into blocks of ``BLOCK``. Each row is spread to all unordered pairs of
    blocks, with the values of both blocks beside the number of the pair, and the pairs are
    aggregated: a handful of sums per cell, of the same width however many columns there are,
    combined in the map tasks. So the table is read once, and what is shuffled is a row
    per task and pair of blocks.
    """
    names = list(columns) if columns is not None else numeric_candidates(df)
    blocks = range(-(-len(names) // BLOCK))
    pairs = [(i, j) for i in blocks for j in blocks if i <= j]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")

    def of_pair(side: int) -> Column:
        return F.get(F.array(*[F.lit(pair[side]) for pair in pairs]), F.col("_pair"))

    def value(block: str, place: int) -> Column:
        return F.get(F.col("_values"), F.col(block) * BLOCK + place)

    places = range(BLOCK)
    values = df.select(F.array(*[F.col(f"`{name}`").cast("double") for name in names]).alias("_values"))
    spread = values.select("_values", F.explode(F.sequence(F.lit(0), F.lit(len(pairs) - 1))).alias("_pair"))
    placed = spread.select("_values", "_pair", of_pair(0).alias("_a"), of_pair(1).alias("_b"))
    beside = placed.select(
        "_a", "_b", *[value("_a", i).alias(f"_a{i}") for i in places], *[value("_b", i).alias(f"_b{i}") for i in places]
    )
    cells = [(i, j) for i in places for j in places]
    sums = beside.groupBy("_a", "_b").agg(*[pearson(f"_a{i}", f"_b{j}").alias(f"_{i}_{j}") for i, j in cells])
    found = sums.select(F.explode(F.array(*[
        F.struct(
            (F.col("_a") * BLOCK + i).alias("a"), (F.col("_b") * BLOCK + j).alias("b"),
            F.col(f"_{i}_{j}").alias("correlation"),
        )
        for i, j in cells
    ])).alias("cell")).select("cell.*").where((F.col("a") <= F.col("b")) & (F.col("b") < len(names)))
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    )
    exact = F.when(F.col("a") != F.col("b"), F.col("correlation")).when(F.col("correlation").isNotNull(), F.lit(1.0))
    labels = F.array(*[F.lit(name) for name in names])
    return found.select(F.explode(both).alias("_cell"), exact.alias("correlation")).select(
        F.get(labels, F.col("_cell.a")).alias("column_a"), F.get(labels, F.col("_cell.b")).alias("column_b"), "correlation"
    )

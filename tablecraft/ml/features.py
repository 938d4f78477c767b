"""Features: category indices, one-hot vectors, assembled vectors, stable splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import (
    IndexToString, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tablecraft.functions import null_to_zero
from tablecraft.shared import settled


def substitute_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null to 0 in the named columns."""
    return df.withColumns({name: null_to_zero(name) for name in columns})


def index_name(column: str) -> str:
    return f"{column}_index"


def vector_name(column: str) -> str:
    return f"{column}_vector"


def string_indexer(columns: Sequence[str], on_unseen: str = "error") -> StringIndexer:
    """Most frequent label first, ties in alphabetical order.

    ``on_unseen`` says what happens to a label that was not in the fitted rows: error,
    skip the row, or keep it under one more index.
    """
    return StringIndexer(
        inputCols=list(columns), outputCols=[index_name(c) for c in columns],
        handleInvalid=on_unseen, stringOrderType="frequencyDesc",
    )


def index_labels(
    df: DataFrame, columns: Sequence[str], on_unseen: str = "error"
) -> tuple[StringIndexerModel, DataFrame]:
    """Fit an indexer on ``df`` and add the index columns.

    The model holds every label; ``label_table`` is the way for categories beyond a driver.
    """
    model = string_indexer(columns, on_unseen).fit(df)
    return model, model.transform(df)


def labels_in_use(indexed: DataFrame, column: str, name: str = "value") -> DataFrame:
    """Each index that occurs, with the label it stands for."""
    index = index_name(column)
    return IndexToString(inputCol=index, outputCol=name).transform(indexed.select(index).distinct())


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Index columns to vectors; the last label is all zeros."""
    return OneHotEncoder(
        inputCols=[index_name(c) for c in columns], outputCols=[vector_name(c) for c in columns], dropLast=True
    )


def assembler(columns: Sequence[str], output: str = "features", nulls: str = "error") -> VectorAssembler:
    """Columns side by side in one vector; a null fails, or its row is skipped."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=nulls)


def feature_stages(
    categories: Sequence[str], columns: Sequence[str], on_unseen: str = "error", nulls: str = "error"
) -> list:
    """Indexer, encoder and assembler. A category in ``columns`` stands for its vector."""
    inputs = [vector_name(c) if c in categories else c for c in columns]
    stages = [string_indexer(categories, on_unseen), one_hot_encoder(categories)] if categories else []
    return [*stages, assembler(inputs, nulls=nulls)]


def fill_or_keep(df: DataFrame, columns: Sequence[str], nulls: str) -> tuple[DataFrame, str]:
    """Apply a null policy: zero replaces here, skip and error are left to the assembler."""
    if nulls not in ("zero", "skip", "error"):
        raise ValueError(f"nulls must be 'zero', 'skip' or 'error', not {nulls!r}")
    if nulls != "zero":
        return df, nulls
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, NumericType)]
    return substitute_nulls(df, numeric), "error"


def feature_terms(df: DataFrame, features: str = "features") -> list[str]:
    """Name of every slot of an assembled vector, from the column's metadata."""
    groups: Mapping[str, list] = df.schema[features].metadata["ml_attr"]["attrs"]
    slots = sorted((slot for group in groups.values() for slot in group), key=lambda slot: slot["idx"])
    return [slot["name"] for slot in slots]


def label_table(df: DataFrame, column: str) -> DataFrame:
    """label, index: the indices of ``string_indexer`` as a table, for any number of labels.

    Labels are counted, laid over range partitions by falling count, and numbered inside
    each; only the sizes of the partitions are added up in one place. Nulls get no index.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    order = [F.desc("_n"), F.asc("label")]
    laid = settled(counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    numbered = laid.withColumn("_place", place).join(before, "_part")
    return numbered.select("label", (F.col("_before") + F.col("_place")).cast("double").alias("index"))


def table_indexed(
    df: DataFrame, columns: Sequence[str], on_unseen: str = "error", tables: Mapping[str, DataFrame] | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The index columns of ``index_labels`` by joins with label tables, which no driver holds.

    ``tables`` are those of earlier rows, by default made from ``df``. A label that they do not
    have, or a null, is an error, or its row is skipped.
    """
    if on_unseen not in ("error", "skip"):
        raise ValueError(f"label tables take 'error' or 'skip', not {on_unseen!r}")
    tables = dict(tables) if tables else {column: settled(label_table(df, column), "labels") for column in columns}
    indexed = df
    for column in columns:
        index = index_name(column)
        table = tables[column].select(F.col("label").alias("_label"), F.col("index").alias(index))
        how = "inner" if on_unseen == "skip" else "left"
        indexed = indexed.join(table, F.col(column).cast("string") == F.col("_label"), how).drop("_label")
        if on_unseen == "error":
            message = F.concat(F.lit(f"Unseen label in {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
            indexed = indexed.withColumn(index, F.coalesce(index, F.raise_error(message).cast("double")))
    return tables, indexed


def stable_split(
    df: DataFrame, share: float, keys: Sequence[str], seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Two parts, the first with about ``share`` of the rows, decided by the row's keys.

    A row always lands in the same part: when a lost task is run again, when the data is
    partitioned differently, and when rows are added.
    """
    flagged = df.withColumn("_first", in_first_part(keys, share, seed))
    return flagged.filter("_first").drop("_first"), flagged.filter("NOT _first").drop("_first")


def in_first_part(keys: Sequence[str], share: float, seed: int = 0):
    """True for about ``share`` of all keys: the leading digits of their MD5 hash decide."""
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.substring(digest, 1, 8) < F.lit(f"{min(round(share * 16**8), 16**8 - 1):08x}")


def random_split(df: DataFrame, share: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Seeded random split, repeatable while the rows and their partitions stay the same."""
    first, second = df.randomSplit([share, 1 - share], seed=seed)
    return first, second

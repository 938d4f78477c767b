"""File sources. Every reader takes one path, a glob, or a list of paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Paths = str | Sequence[str]

VIEW_COLUMNS = "user_id int, chapter_id int, viewed_at string"
CHAPTER_COLUMNS = "chapter_id int, course_id int"
TITLE_COLUMNS = "course_id int, title string"


def _paths(paths: Paths) -> str | list[str]:
    return paths if isinstance(paths, str) else list(paths)


def text_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row per line, in column ``value``."""
    return spark.read.text(_paths(paths))


def positional_csv(
    spark: SparkSession, paths: Paths, columns: str | StructType, required: Sequence[str] = ()
) -> DataFrame:
    """Comma file without a header, typed by position.

    A value that does not parse, a row with more or fewer fields than ``columns``, or a blank
    value of a ``required`` column fails the read, whatever columns are selected
    later. Quotes are plain characters and spaces are kept.
    """
    reader = spark.read.schema(columns).option("quote", "").option("columnPruning", False)
    rows = reader.csv(_paths(paths), header=False, mode="FAILFAST")
    for name in required:
        missing = F.raise_error(F.lit(f"blank value of {name}")).cast("boolean")
        rows = rows.filter(F.when(F.col(name).isNotNull(), True).otherwise(missing))
    return rows


def read_views(spark: SparkSession, paths: Paths) -> DataFrame:
    return positional_csv(spark, paths, VIEW_COLUMNS, ["user_id", "chapter_id"]).select("user_id", "chapter_id")


def read_chapters(spark: SparkSession, paths: Paths) -> DataFrame:
    return positional_csv(spark, paths, CHAPTER_COLUMNS, ["chapter_id", "course_id"])


def read_titles(spark: SparkSession, paths: Paths) -> DataFrame:
    return positional_csv(spark, paths, TITLE_COLUMNS, ["course_id", "title"])


def headered_csv(
    spark: SparkSession,
    paths: Paths,
    columns: str | StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV whose files each start with a header.

    All columns are strings by default. ``columns`` types them without another pass
    over the data; ``infer`` lets Spark find the types with one more pass.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.schema(columns)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(_paths(paths))

"""Values of a group as ordered lists of bounded length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

PAGE_SIZE = 10_000
#: Parts of a bucket, divided at quantiles of its different values, and the accuracy of these.
PARTS, ACCURACY = 64, 2_000


def _beside(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right`` of equal ``columns``; nulls are equal."""
    renamed = right.withColumnsRenamed({column: f"{column}_r" for column in columns})
    same = F.lit(True)
    for column in columns:
        same = same & F.col(column).eqNullSafe(F.col(f"{column}_r"))
    return left.join(renamed, same).drop(*[f"{column}_r" for column in columns])


def _divided(runs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``runs`` with the part of the bucket to which each value belongs."""
    if not isinstance(runs.schema[value].dataType, (NumericType, DateType, TimestampType, TimestampNTZType)):
        return runs.withColumn("_part", F.lit(0))
    shares = [F.lit(i / PARTS) for i in range(1, PARTS)]
    bounds = runs.groupBy(*keys, "_bucket").agg(F.percentile_approx(value, F.array(*shares), F.lit(ACCURACY)).alias("_bounds"))
    part = F.size(F.filter("_bounds", lambda bound: bound < F.col(value)))
    return _beside(runs, bounds, [*keys, "_bucket"]).withColumn("_part", part).drop("_bounds")


def collect_pages(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    bucket: Column,
    page_size: int = PAGE_SIZE,
    name: str = "values",
) -> DataFrame:
    """All non-null values per group in ascending order, cut into pages.

    Pages 0, 1, 2, ... of a group, put end to end, are the sorted list of the group; no
    row holds more than ``page_size`` values, however large the group is.

    Equal values are counted before anything is shuffled, so a value that repeats a
    billion times travels as one row. ``bucket`` must not decrease as the value grows, such as
    the day of a time. Numbers, dates and times of a bucket are divided further at quantiles of
    its different values, which sketches of the tasks give, so that a bucket with most of a group
    is not ordered in one task either. Positions are summed within parts, over the
    parts of a bucket, and over the buckets of a group.
    """
    keys = list(keys)
    runs = (
        df.filter(F.col(value).isNotNull())
        .withColumn("_bucket", bucket)
        .groupBy(*keys, "_bucket", value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    divided = _divided(runs, keys, value)
    groups = [*keys, "_bucket", "_part"]
    sizes = divided.groupBy(*groups).agg(F.sum("_n").alias("_size"))
    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("_part")
    parts = sizes.withColumn("_before", F.sum("_size").over(in_bucket) - F.col("_size"))
    per_bucket = sizes.groupBy(*keys, "_bucket").agg(F.sum("_size").alias("_size"))
    in_group = Window.partitionBy(*keys).orderBy("_bucket")
    buckets = per_bucket.withColumn("_first", F.sum("_size").over(in_group) - F.col("_size"))
    starts = _beside(parts.drop("_size"), buckets.drop("_size"), [*keys, "_bucket"])
    starts = starts.select(*groups, (F.col("_first") + F.col("_before")).alias("_start"))

    within = Window.partitionBy(*groups).orderBy(value)
    first = F.col("_start") + F.col("_through") - F.col("_n")
    placed = _beside(divided.withColumn("_through", F.sum("_n").over(within)), starts, groups).select(
        *keys, value, first.alias("_from"), (first + F.col("_n")).alias("_to")
    )

    size = F.lit(page_size)

    def page_of(position: Column) -> Column:
        return F.floor(position / size)

    pieces = placed.withColumn(
        "page", F.explode(F.sequence(page_of(F.col("_from")), page_of(F.col("_to") - 1)))
    ).select(
        *keys, "page",
        F.struct(
            F.col(value).alias("value"),
            (
                F.least(F.col("_to"), (F.col("page") + 1) * size)
                - F.greatest(F.col("_from"), F.col("page") * size)
            ).cast("int").alias("copies"),
        ).alias("_piece"),
    )
    repeated = F.transform(
        F.sort_array(F.collect_list("_piece")),
        lambda piece: F.array_repeat(piece["value"], piece["copies"]),
    )
    return pieces.groupBy(*keys, "page").agg(F.flatten(repeated).alias(name))

"""Recommendations from what users watched."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecraft import fixed_values as fixed
from tablecraft.ml.retrieval import best_items
from tablecraft.operators import top_rows_per
from tablecraft.shared import settled


def watch_ratings(
    views: DataFrame, user: str = "user_id", item: str = "item_id", share: str = "share", scale: float = fixed.RATING_SCALE
) -> DataFrame:
    """One rating per user and item: the sum of the watched shares times ``scale``.

    Ids must fit an int; a larger one fails instead of being cut. ``dense_ids`` numbers ids of any
    other type.
    """
    return (
        views.groupBy(F.col(user).cast("int").alias("user_id"), F.col(item).cast("int").alias("item_id"))
        .agg((F.sum(share) * scale).cast("float").alias("rating"))
    )


def dense_ids(rows: DataFrame, column: str) -> DataFrame:
    """id, number: the different non-null ids of a column, in order, numbered from 0.

    Ids are laid over range partitions and numbered inside each; only the sizes of the partitions are
    added up in one place. Numbers are ints: 2 ** 31 different ids, which models hold, fail beyond.
    """
    ids = rows.where(F.col(column).isNotNull()).select(F.col(column).alias("id")).distinct()
    laid = settled(ids.repartitionByRange("id").withColumn("_part", F.spark_partition_id()), "ids")
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select("_part", (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("id")) - 1
    numbered = laid.withColumn("_place", place).join(before, "_part")
    return settled(numbered.select("id", (F.col("_before") + F.col("_place")).cast("int").alias("number")), "dense-ids")


@dataclass
class NumberedViews:
    """Views with int ids, and the ids behind the numbers."""

    views: DataFrame
    users: DataFrame
    items: DataFrame

    def restored(self, report: DataFrame) -> DataFrame:
        """``report`` with the ids that its user_id and item_id stand for."""
        columns = report.columns
        for name, table in (("user_id", self.users), ("item_id", self.items)):
            named = table.select(F.col("number").alias(name), F.col("id").alias("_id"))
            report = report.join(named, name).drop(name).withColumnRenamed("_id", name)
        return report.select(*columns)


def numbered_views(views: DataFrame, user: str, item: str, share: str) -> NumberedViews:
    """Views whose ids, of any type that has an order, are replaced by dense numbers.

    Views of a null user or item are left out, since they can't be recommended to or by.
    """
    users, items = dense_ids(views, user), dense_ids(views, item)
    numbered = views.select(F.col(user).alias("_user"), F.col(item).alias("_item"), F.col(share).alias("share"))
    for name, table in (("user", users), ("item", items)):
        numbered = numbered.join(table.select(F.col("id").alias(f"_{name}"), F.col("number").alias(f"{name}_id")), f"_{name}")
    return NumberedViews(numbered.select("user_id", "item_id", "share"), users, items)


def fit_recommender(
    ratings: DataFrame,
    iterations: int = fixed.ALS_ITERATIONS,
    reg_param: float = fixed.ALS_REG_PARAM,
    rank: int = 10,
    blocks: int = 10,
    seed: int = 0,
) -> ALSModel:
    """Alternating least squares; rows of unknown users or items drop out of ``transform``.

    ``blocks`` is the number of parts users and items are divided into, to be raised with
    the cluster.
    """
    model = ALS(
        maxIter=iterations, regParam=reg_param, rank=rank, numUserBlocks=blocks, numItemBlocks=blocks,
        userCol="user_id", itemCol="item_id", ratingCol="rating", seed=seed,
    ).fit(ratings)
    return model.setColdStartStrategy("drop")


def _recommended(model: ALSModel, users: DataFrame) -> DataFrame:
    """user_id, rank, item_id, predicted: the first ``k`` items of each of ``users`` (id, k).

    Users the model does not know have no rows.
    """
    known = model.userFactors.select("id", F.col("features").alias("v")).join(users, "id")
    items = model.itemFactors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("v"))
    return best_items(known, items).select(
        F.col("user").cast("int").alias("user_id"), "rank", F.col("item").cast("int").alias("item_id"),
        F.col("score").cast("float").alias("predicted"),
    )


def top_items(model: ALSModel, n: int = fixed.RECOMMENDED_ITEMS, users: DataFrame | None = None) -> DataFrame:
    """The best ``n`` items of every user, or of the given ``users`` only; ties by item.

    Items a user already watched can be among them.
    """
    wanted = model.userFactors.select("id") if users is None else users.select(F.col("user_id").alias("id")).distinct()
    return _recommended(model, wanted.withColumn("k", F.lit(n)))


def new_items(
    model: ALSModel, ratings: DataFrame, n: int = fixed.RECOMMENDED_ITEMS, users: DataFrame | None = None
) -> DataFrame:
    """The best ``n`` items that the user has not watched, of every user or of ``users`` only.

    A user with ``w`` watched items needs a raw list of ``n + w`` for ``n`` new ones to remain,
    so the lists of all users together stay in proportion to the ratings.
    """
    if users is not None:
        ratings = ratings.join(users.select("user_id").distinct(), "user_id", "left_semi")
    per_user = ratings.groupBy(F.col("user_id").alias("id")).agg((F.count(F.lit(1)) + n).cast("int").alias("k"))
    seen = ratings.select("user_id", "item_id")
    unseen = _recommended(model, per_user).join(seen, ["user_id", "item_id"], "left_anti")
    order = [F.desc("predicted"), F.asc("item_id")]
    ranked = top_rows_per(unseen.drop("rank"), ["user_id"], order, n)
    return ranked.select("user_id", "rank", "item_id", "predicted")


def beside_history(recommended: DataFrame, ratings: DataFrame) -> DataFrame:
    """Recommended and watched items of the recommended users, one row each.

    ``kind`` tells them apart; ``already_watched`` marks a recommended item the user has
    seen. Watched rows have a rating and no rank.
    """
    watched = ratings.select("user_id", "item_id", "rating")
    offered = recommended.join(watched, ["user_id", "item_id"], "left").select(
        "user_id", F.lit("recommended").alias("kind"), "rank", "item_id", "predicted", "rating",
        F.col("rating").isNotNull().alias("already_watched"),
    )
    users = recommended.select("user_id").distinct()
    history = watched.join(users, "user_id", "left_semi").select(
        "user_id", F.lit("watched").alias("kind"), F.lit(None).cast("int").alias("rank"), "item_id",
        F.lit(None).cast("float").alias("predicted"), "rating", F.lit(True).alias("already_watched"),
    )
    return offered.unionByName(history)

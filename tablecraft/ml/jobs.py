"""Model reports on their usual columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft import fixed_values as fixed
from tablecraft.functions import category_group, flag_above, ratio
from tablecraft.ml import models
from tablecraft.ml.features import (
    assembler, feature_stages, index_labels, index_name, labels_in_use, stable_split, substitute_nulls,
)
from tablecraft.ml.recommend import (
    beside_history, fit_recommender, new_items, numbered_views, top_items, watch_ratings,
)
from tablecraft.operators import correlation_matrix, numeric_candidates
from tablecraft.shared import settled

# ---- repetitions: plain regression and clusters ---------------------------------------


def repetitions_regression(
    df: DataFrame, label: str = "NoOfReps", columns: Sequence[str] = fixed.GYM_COLUMNS, categories: Sequence[str] = ("Gender",)
) -> models.Fitted:
    return models.linear_regression(df, label, columns, categories)


def competitor_clusters(
    df: DataFrame,
    columns: Sequence[str] = fixed.GYM_CLUSTER_COLUMNS,
    categories: Sequence[str] = ("Gender",),
    counts: Sequence[int] = fixed.CLUSTER_COUNTS,
    seed: int = 0,
) -> models.Clusters:
    prepared = df
    for stage in feature_stages(categories, columns):
        prepared = (stage.fit(prepared) if hasattr(stage, "fit") else stage).transform(prepared)
    return models.cluster_sweep(prepared, counts, seed)


# ---- house prices ---------------------------------------------------------------------


def house_correlations(df: DataFrame, drop: Sequence[str] = fixed.NOT_CORRELATED) -> DataFrame:
    return correlation_matrix(df, numeric_candidates(df, drop))


def with_share_above(df: DataFrame, above: str = "sqft_above", living: str = "sqft_living") -> DataFrame:
    """Share of the living area above ground; null where the living area is 0."""
    return df.withColumn("sqft_above_percentage", ratio(above, living))


def house_price_model(
    df: DataFrame,
    label: str = "price",
    columns: Sequence[str] = fixed.HOUSE_COLUMNS,
    categories: Sequence[str] = fixed.HOUSE_CATEGORIES,
    keys: Sequence[str] = ("id",),
    share: float = 0.8,
    seed: int = 0,
    **tuning,
) -> models.Fitted:
    training, holdout = stable_split(df, share, keys, seed)
    return models.tuned_linear_regression(
        training, holdout, label, columns, categories, seed=seed, keys=keys, **tuning
    )


# ---- subscriptions --------------------------------------------------------------------


def churn_rows(df: DataFrame) -> DataFrame:
    """Subscriptions not cancelled, nulls replaced, ``label`` 1 for no view next month.

    A null flag counts as cancelled and null views as none.
    """
    active = substitute_nulls(df.filter("is_cancelled = false"), fixed.COUNTED_COLUMNS)
    watched = flag_above("next_month_views", 0)
    return active.withColumn("next_month_views", 1 - watched).withColumnRenamed("next_month_views", "label")


def churn_model(
    df: DataFrame,
    columns: Sequence[str] = fixed.CHURN_COLUMNS,
    categories: Sequence[str] = fixed.CHURN_CATEGORIES,
    keys: Sequence[str] | None = None,
    share: float = 0.9,
    seed: int = 0,
    **tuning,
) -> models.Fitted:
    """Tuned classifier of subscriptions that stop viewing; ``keys`` default to all columns."""
    rows = churn_rows(df)
    training, holdout = stable_split(rows, share, keys or df.drop("next_month_views").columns, seed)
    return models.tuned_logistic_regression(
        training, holdout, "label", columns, categories, seed=seed, **tuning
    )


# ---- free trials ----------------------------------------------------------------------


def trial_rows(df: DataFrame, country: str = "country", payments: str = "payments_made") -> DataFrame:
    """Countries in groups, ``label`` 1 for at least one payment."""
    return df.withColumns({
        country: category_group(country), "label": flag_above(payments, 1, inclusive=True)
    })


@dataclass
class TrialParts:
    """Training and hold-out rows (``label``, ``features``), and the country of each index."""

    training: DataFrame
    holdout: DataFrame
    countries: DataFrame


def trial_parts(
    rows: DataFrame,
    country: str = "country",
    columns: Sequence[str] = fixed.TRIAL_COLUMNS,
    keys: Sequence[str] | None = None,
    share: float = fixed.TRIAL_TRAIN_SHARE,
    seed: int = 0,
) -> TrialParts:
    """Assemble and split the trials; the country index stays a category for the trees."""
    _, indexed = index_labels(rows, [country])
    features = assembler([index_name(country), *columns]).transform(indexed)
    training, holdout = stable_split(features, share, keys or rows.columns, seed)
    return TrialParts(
        training.select("label", "features"), holdout.select("label", "features"), labels_in_use(indexed, country)
    )


def trial_models(
    parts: TrialParts, depth: int = fixed.TREE_DEPTH, seed: int = 0
) -> tuple[models.Fitted, models.Fitted]:
    """A tree and a forest on the same parts."""
    with models.kept(parts.training, parts.holdout) as (training, holdout):
        tree = models.decision_tree(training, holdout, depth, seed)
        forest = models.random_forest(training, holdout, depth, seed=seed)
    return tree, forest


# ---- recommendations ------------------------------------------------------------------


def course_recommendations(
    views: DataFrame,
    user: str = "userId",
    item: str = "courseId",
    share: str = "proportionWatched",
    n: int = fixed.RECOMMENDED_ITEMS,
    first_users: int | None = None,
    exclude_seen: bool = False,
    seed: int = 0,
    **fitting,
) -> DataFrame:
    """Recommended items of every user beside the watched ones.

    Ids that are no ints (bigint, string) are numbered for the model and given back.
    ``first_users`` limits the report to that many users with the lowest ids. The ratings
    are written once, for the fit and for the history.
    """
    plain = all(views.schema[name].dataType.simpleString() in ("tinyint", "smallint", "int") for name in (user, item))
    numbered = None if plain else numbered_views(views, user, item, share)
    rated = watch_ratings(views, user, item, share) if plain else watch_ratings(numbered.views)
    ratings = settled(rated)
    model = fit_recommender(ratings, seed=seed, **fitting)
    users = None if first_users is None else settled(_lowest(ratings, first_users))
    recommended = settled(new_items(model, ratings, n, users) if exclude_seen else top_items(model, n, users))
    report = beside_history(recommended, ratings)
    return report if plain else numbered.restored(report)


def _lowest(ratings: DataFrame, n: int) -> DataFrame:
    return ratings.select("user_id").distinct().orderBy(F.asc("user_id")).limit(n)

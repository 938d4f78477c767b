"""Models: each fit returns the model beside frames that describe it."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, ClusteringEvaluator, Evaluator,
    MulticlassClassificationEvaluator, RegressionEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft import fixed_values as fixed
from tablecraft.ml import sums
from tablecraft.ml.features import (
    feature_stages, feature_terms, fill_or_keep, in_first_part, table_indexed, vector_name,
)
from tablecraft.shared import settled

METRICS = "metric string, value double"


@dataclass
class Fitted:
    """A fitted model, its predictions and its figures.

    ``metrics`` has columns ``metric`` and ``value``; ``coefficients`` has ``term`` and
    ``coefficient``; ``grid`` has one row per tried parameter point.
    """

    model: Any
    predictions: DataFrame
    metrics: DataFrame
    coefficients: DataFrame | None = None
    grid: DataFrame | None = None
    stages: PipelineModel | None = field(default=None, repr=False)
    rules: str | None = field(default=None, repr=False)


def metric_frame(spark: SparkSession, metrics: dict[str, float]) -> DataFrame:
    return spark.createDataFrame([(name, float(value)) for name, value in metrics.items()], METRICS)


def coefficient_frame(spark: SparkSession, terms: Sequence[str], model) -> DataFrame:
    rows = [("intercept", float(model.intercept))]
    rows += [(term, float(value)) for term, value in zip(terms, model.coefficients)]
    return spark.createDataFrame(rows, "term string, coefficient double")


@contextmanager
def kept(*frames: DataFrame) -> Iterator[list[DataFrame]]:
    """Frames that are read many times, held in memory and on disk until the block ends."""
    held = [frame.persist(StorageLevel.MEMORY_AND_DISK) for frame in frames]
    try:
        yield held
    finally:
        for frame in held:
            frame.unpersist()


# ---- linear and logistic regression ---------------------------------------------------


def linear_regression(
    df: DataFrame,
    label: str,
    columns: Sequence[str],
    categories: Sequence[str] = (),
    on_unseen: str = "error",
    nulls: str = "error",
    label_tables: bool = False,
) -> Fitted:
    """Plain least squares on all rows, with predictions for the same rows.

    With ``label_tables`` the labels of the categories stay in tables, joined to the rows and to the
    coefficients; the driver holds a number for each slot, but no label and no name of a slot.
    """
    rows, nulls = fill_or_keep(df, columns, nulls)
    if label_tables:
        tables, rows = table_indexed(rows, categories, on_unseen)
        stages = feature_stages(categories, columns, "error", nulls)[1:]
    else:
        tables, stages = None, feature_stages(categories, columns, on_unseen, nulls)
    features = Pipeline(stages=stages).fit(rows)
    prepared = features.transform(rows).withColumnRenamed(label, "label")
    with kept(prepared.select("label", "features")) as (train,):
        model = LinearRegression().fit(train)
        figures = {"train_r2": model.summary.r2, "train_rmse": model.summary.rootMeanSquaredError}
    spark = df.sparkSession
    if tables is None:
        coefficients = coefficient_frame(spark, feature_terms(prepared), model)
    else:
        coefficients = _joined_coefficients(spark, columns, tables, model)
    return Fitted(
        model=model,
        predictions=model.transform(prepared),
        metrics=metric_frame(spark, figures),
        coefficients=coefficients,
        stages=features,
    )


def _joined_coefficients(spark: SparkSession, columns: Sequence[str], tables: dict[str, DataFrame], model) -> DataFrame:
    """term, coefficient; terms of categories are made by joins with their label tables."""
    values, at = model.coefficients.toArray(), 0
    plain, parts = [("intercept", float(model.intercept))], []
    for column in columns:
        if column not in tables:
            plain.append((column, float(values[at])))
            at += 1
            continue
        n = tables[column].count() - 1  # the last label is all zeros
        slots = spark.createDataFrame([(float(i), float(x)) for i, x in enumerate(values[at : at + n])], "index double, coefficient double")
        term = F.concat(F.lit(f"{vector_name(column)}_"), "label").alias("term")
        parts.append(slots.join(tables[column], "index").select(term, "coefficient"))
        at += n
    found = spark.createDataFrame(plain, "term string, coefficient double")
    for part in parts:
        found = found.unionByName(part)
    return found


def _tune(
    training: DataFrame,
    estimator: LinearRegression | LogisticRegression,
    evaluator: Evaluator,
    reg_params: Sequence[float],
    elastic_nets: Sequence[float],
    train_share: float,
    seed: int,
    parallelism: int,
):
    """Best model of the grid on one split of ``training``, and the figure of each point.

    The split draws rows at random, so ``training`` must not change its order.
    """
    grid = (
        ParamGridBuilder()
        .addGrid(estimator.regParam, list(reg_params))
        .addGrid(estimator.elasticNetParam, list(elastic_nets))
        .build()
    )
    tuner = TrainValidationSplit(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator,
        trainRatio=train_share, seed=seed, parallelism=parallelism,
    )
    tuned = tuner.fit(training)
    points = [
        (float(point[estimator.regParam]), float(point[estimator.elasticNetParam]), float(figure))
        for point, figure in zip(grid, tuned.validationMetrics)
    ]
    frame = training.sparkSession.createDataFrame(
        points, "reg_param double, elastic_net double, validation_metric double"
    )
    return tuned.bestModel, frame


def _prepared(
    training: DataFrame, holdout: DataFrame, label: str, columns: Sequence[str],
    categories: Sequence[str], on_unseen: str, nulls: str,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Feature stages fitted on the training rows and applied to both parts."""
    rows, policy = fill_or_keep(training, columns, nulls)
    held, _ = fill_or_keep(holdout, columns, nulls)
    stages = Pipeline(stages=feature_stages(categories, columns, on_unseen, policy)).fit(rows)
    ready = stages.transform(rows).withColumnRenamed(label, "label")
    return stages, ready, stages.transform(held).withColumnRenamed(label, "label")


def tuned_linear_regression(
    training: DataFrame,
    holdout: DataFrame,
    label: str,
    columns: Sequence[str],
    categories: Sequence[str] = (),
    reg_params: Sequence[float] = fixed.HOUSE_REG_PARAMS,
    elastic_nets: Sequence[float] = fixed.ELASTIC_NET_PARAMS,
    train_share: float = fixed.HOUSE_TRAIN_SHARE,
    seed: int = 0,
    parallelism: int = 4,
    on_unseen: str = "error",
    nulls: str = "error",
    keys: Sequence[str] | None = None,
    most_terms: int = sums.MOST_TERMS,
) -> Fitted:
    """Least squares with the penalty that does best by r2; predictions for the hold-out.

    Up to ``most_terms`` slots, all parts are read once: sums of products of the rows to fit, to
    validate and to hold out give every point of the grid, the refitted model and its
    figures. Rows are divided by ``keys`` (by default by their features and label), so partitioning
    and lost tasks change nothing. Wider features are fitted point by point on written rows.
    """
    stages, ready, held = _prepared(training, holdout, label, columns, categories, on_unseen, nulls)
    terms = feature_terms(ready)
    if len(terms) > most_terms:
        return _tuned_by_passes(
            stages, ready, held, terms, reg_params, elastic_nets, train_share, seed, parallelism
        )
    row = [F.concat_ws("|", *[F.col(key).cast("string") for key in keys])] if keys else [
        F.concat_ws("|", F.col("label").cast("string"), F.array_join(vector_to_array("features"), ","))
    ]
    marked = ready.select("label", "features", row[0].alias("_row"), F.lit(True).alias("_train")).unionByName(
        held.select("label", "features", F.lit(None).cast("string").alias("_row"), F.lit(False).alias("_train"))
    )
    part = F.when(~F.col("_train"), "holdout").when(in_first_part(["_row"], train_share, seed + 1), "fit").otherwise("validate")
    found = sums.sums_by_part(marked, part)
    missing = {"fit", "validate"} - found.keys()
    if missing:
        raise ValueError(f"no rows to {' and '.join(sorted(missing))}")
    model, points = sums.best_of_grid(found["fit"], found["validate"], reg_params, elastic_nets)
    line = model.intercept, model.coefficients
    train = found["fit"] + found["validate"]
    figures = {"train_r2": train.r2(*line), "train_rmse": train.rmse(*line)}
    if "holdout" in found:
        figures |= {"holdout_r2": found["holdout"].r2(*line), "holdout_rmse": found["holdout"].rmse(*line)}
    figures |= {"reg_param": model.reg_param, "elastic_net": model.elastic_net}
    spark = training.sparkSession
    return Fitted(
        model=model,
        predictions=model.transform(held),
        metrics=metric_frame(spark, figures),
        coefficients=coefficient_frame(spark, terms, model),
        grid=spark.createDataFrame(points, "reg_param double, elastic_net double, validation_metric double"),
        stages=stages,
    )


def _tuned_by_passes(
    stages: PipelineModel, ready: DataFrame, held: DataFrame, terms: Sequence[str], reg_params: Sequence[float],
    elastic_nets: Sequence[float], train_share: float, seed: int, parallelism: int,
) -> Fitted:
    """The same for features too wide for matrices of sums."""
    with kept(settled(ready.select("label", "features")), held.select("label", "features")) as (train, test):
        model, grid = _tune(
            train, LinearRegression(), RegressionEvaluator(metricName="r2"),
            reg_params, elastic_nets, train_share, seed, parallelism,
        )
        trained, tested = model.evaluate(train), model.evaluate(test)
        figures = {
            "train_r2": trained.r2, "train_rmse": trained.rootMeanSquaredError,
            "holdout_r2": tested.r2, "holdout_rmse": tested.rootMeanSquaredError,
            "reg_param": model.getRegParam(), "elastic_net": model.getElasticNetParam(),
        }
    spark = ready.sparkSession
    return Fitted(
        model=model,
        predictions=model.transform(held),
        metrics=metric_frame(spark, figures),
        coefficients=coefficient_frame(spark, terms, model),
        grid=grid,
        stages=stages,
    )


def confusion_table(predictions: DataFrame, label: str = "label") -> DataFrame:
    return predictions.groupBy(label, "prediction").agg(F.count(F.lit(1)).alias("n"))


def classification_figures(predictions: DataFrame, label: str = "label") -> dict[str, float]:
    """Accuracy, and recall and precision of label 1, in one pass over the predictions."""
    hit = (F.col(label) == F.col("prediction")).cast("double")
    hit_if_true = F.when(F.col(label) == 1, hit)
    hit_if_said = F.when(F.col("prediction") == 1, hit)
    row = predictions.agg(
        F.avg(hit).alias("accuracy"), F.avg(hit_if_true).alias("recall_1"),
        F.avg(hit_if_said).alias("precision_1"),
    ).first()
    return {name: float("nan") if value is None else value for name, value in row.asDict().items()}


def _totals(histogram: DataFrame) -> tuple[float, float, float]:
    """Rows, rows of label 1, and the sum of all scores."""
    row = histogram.agg(F.sum("n"), F.sum(F.when(F.col("label") == 1, F.col("n"))), F.sum("total")).first()
    return tuple(float(x or 0) for x in row)


def tuned_logistic_regression(
    training: DataFrame,
    holdout: DataFrame,
    label: str,
    columns: Sequence[str],
    categories: Sequence[str] = (),
    reg_params: Sequence[float] = fixed.CHURN_REG_PARAMS,
    elastic_nets: Sequence[float] = fixed.ELASTIC_NET_PARAMS,
    train_share: float = fixed.CHURN_TRAIN_SHARE,
    metric: str = "auc",
    seed: int = 0,
    parallelism: int = 4,
    on_unseen: str = "error",
    nulls: str = "error",
) -> Fitted:
    """Binary classifier tuned by area under the curve, or by r2 of the 0/1 predictions.

    Scores of both parts are counted by label and bin; ``holdout_area`` is the area under the curve
    that follows. The intercept has no penalty, so ``train_mean_score`` is the share of label 1.
    For two labels ``likelihood_1 = tpr_1 / (tpr_1 + fpr_0)`` equals ``recall_1``; the
    share of predicted ones that are right is ``precision_1``.
    """
    if metric not in ("auc", "r2"):
        raise ValueError(f"metric must be 'auc' or 'r2', not {metric!r}")
    stages, ready, held = _prepared(training, holdout, label, columns, categories, on_unseen, nulls)
    evaluator = BinaryClassificationEvaluator() if metric == "auc" else RegressionEvaluator(metricName="r2")
    with kept(settled(ready.select("label", "features")), held.select("label", "features")) as (train, test):
        model, grid = _tune(
            train, LogisticRegression(), evaluator, reg_params, elastic_nets, train_share, seed, parallelism
        )
        trained = classification_figures(model.transform(train))
        tested = classification_figures(model.transform(test))
        one = vector_to_array("probability")[1].alias("score")
        parts = {name: sums.score_histogram(model.transform(x).select("label", one)) for name, x in (("train", train), ("holdout", test))}
        totals = {name: _totals(histogram) for name, histogram in parts.items()}
        area = sums.area_under_curve(sums.rates(parts["holdout"]))
        summary = model.evaluate(test)
        true_rates, false_rates = summary.truePositiveRateByLabel, summary.falsePositiveRateByLabel
    figures = {
        "train_accuracy": trained["accuracy"], "holdout_accuracy": tested["accuracy"],
        "recall_1": tested["recall_1"], "precision_1": tested["precision_1"], "holdout_area": area,
        "reg_param": model.getRegParam(), "elastic_net": model.getElasticNetParam(),
    }
    for name, (n, ones, score) in totals.items():
        figures |= {f"{name}_n": n, f"{name}_ones": ones, f"{name}_mean_score": score / n if n else float("nan")}
    if len(true_rates) > 1 and true_rates[1] + false_rates[0] > 0:
        figures["likelihood_1"] = true_rates[1] / (true_rates[1] + false_rates[0])
    spark = training.sparkSession
    predictions = model.transform(held)
    return Fitted(
        model=model,
        predictions=predictions,
        metrics=metric_frame(spark, figures),
        coefficients=coefficient_frame(spark, feature_terms(ready), model),
        grid=grid,
        stages=stages,
    )


# ---- trees ----------------------------------------------------------------------------


def _fit_tree(classifier, training: DataFrame, holdout: DataFrame) -> Fitted:
    model = classifier.fit(training)
    predictions = model.transform(holdout)
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(predictions)
    return Fitted(
        model=model,
        predictions=predictions,
        metrics=metric_frame(training.sparkSession, {"holdout_accuracy": accuracy}),
        rules=re.sub(r"uid=\w+, ", "", model.toDebugString),
    )


def decision_tree(training: DataFrame, holdout: DataFrame, depth: int = fixed.TREE_DEPTH, seed: int = 0) -> Fitted:
    """One tree over ``label`` and ``features``; ``rules`` holds its text."""
    return _fit_tree(DecisionTreeClassifier(maxDepth=depth, seed=seed), training, holdout)


def random_forest(
    training: DataFrame, holdout: DataFrame, depth: int = fixed.TREE_DEPTH, trees: int = 20, seed: int = 0
) -> Fitted:
    return _fit_tree(RandomForestClassifier(maxDepth=depth, numTrees=trees, seed=seed), training, holdout)


def rule_lines(fitted: Fitted) -> DataFrame:
    """The rules of a tree or forest, one numbered row per line."""
    spark = fitted.metrics.sparkSession
    rows = list(enumerate(fitted.rules.rstrip("\n").split("\n"), 1))
    return spark.createDataFrame(rows, "line int, rule string")


# ---- clusters -------------------------------------------------------------------------


@dataclass
class Clusters:
    """Figures of every tried number of clusters, and the fitted models by that number."""

    figures: DataFrame
    sizes: DataFrame
    centres: DataFrame
    models: dict[int, Any] = field(repr=False)
    sums: DataFrame | None = field(default=None, repr=False)


def cluster_sweep(
    df: DataFrame, counts: Sequence[int] = fixed.CLUSTER_COUNTS, seed: int = 0, iterations: int = 20
) -> Clusters:
    """K-means for every number of clusters: squared error, silhouette, sizes, centres.

    The feature column is kept for the whole sweep, since every fit reads it many times. ``sums`` has
    n, total and squares of the rows of every cluster and coordinate, of all numbers of clusters at
    one reading; centres and squared errors of what was assigned follow from it.
    """
    spark = df.sparkSession
    figures, sizes, centres, models = [], [], [], {}
    with kept(df.select("features")) as (features,):
        for k in counts:
            model = KMeans(k=k, seed=seed, maxIter=iterations, predictionCol=f"k{k}").fit(features)
            summary = model.summary
            silhouette = ClusteringEvaluator(predictionCol=f"k{k}").evaluate(model.transform(features))
            figures.append((k, float(summary.trainingCost), float(silhouette)))
            sizes += [(k, cluster, size) for cluster, size in enumerate(summary.clusterSizes)]
            centres += [(k, i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
            models[k] = model
    assigned = df.select("features")
    for k in counts:
        assigned = models[k].transform(assigned)
    summed = sums.cluster_sums(assigned, [f"k{k}" for k in counts])
    summed = summed.select(F.substring("model", 2, 9).cast("int").alias("k"), "cluster", "place", "n", "total", "squares")
    return Clusters(
        figures=spark.createDataFrame(figures, "k int, sse double, silhouette double"),
        sizes=spark.createDataFrame(sizes, "k int, cluster int, size bigint"),
        centres=spark.createDataFrame(centres, "k int, cluster int, centre array<double>"),
        models=models,
        sums=summed,
    )

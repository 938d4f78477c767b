"""Linear models and checks of models from sums that one reading gives.

Sums of products of all pairs of columns (X'X and X'y), of each part of the rows, are enough to
fit and to judge least squares with any penalty. They are added up inside the tasks by
matrix products over Arrow batches; what is shuffled is one small matrix per task and part, and
what reaches the driver is one per part, bounded by ``MOST_TERMS`` columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns up to which matrices of sums are held on the driver (32 MB each).
MOST_TERMS = 2000
#: Steps of coordinate descent end when no coefficient of a scaled column moves by more.
TOLERANCE = 1e-13
MOST_SWEEPS = 100_000


@dataclass
class Sums:
    """Sums of products of (1, features, label) over the rows of a part."""

    products: np.ndarray

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.products + other.products)

    @property
    def n(self) -> float:
        return float(self.products[0, 0])

    @property
    def means(self) -> np.ndarray:
        """Of the features, then of the label."""
        return self.products[0, 1:] / self.n

    @property
    def covariances(self) -> np.ndarray:
        """Population covariances of the features and the label."""
        return self.products[1:, 1:] / self.n - np.outer(self.means, self.means)

    def squared_error(self, intercept: float, coefficients: np.ndarray) -> float:
        """Sum of the squared errors of the linear prediction."""
        weights = np.concatenate([[-intercept], -coefficients, [1.0]])
        return max(0.0, float(weights @ self.products @ weights))

    def r2(self, intercept: float, coefficients: np.ndarray) -> float:
        return 1 - self.squared_error(intercept, coefficients) / (self.n * float(self.covariances[-1, -1]))

    def rmse(self, intercept: float, coefficients: np.ndarray) -> float:
        return float(np.sqrt(self.squared_error(intercept, coefficients) / self.n))


def sums_by_part(rows: DataFrame, part: Column, features: str = "features", label: str = "label") -> dict[str, Sums]:
    """Sums of each part, at one reading of ``rows``. Rows whose part is null are left out."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(len(batch), -1) if len(batch) else np.zeros((0, 0))
            names = batch.column("part").to_numpy(zero_copy_only=False)
            for name in set(names.tolist()):
                mine = x[names == name]
                total[name] = total.get(name, 0) + mine.T @ mine
        for name, matrix in total.items():
            n = matrix.size
            yield pa.RecordBatch.from_pydict({"part": [name] * n, "at": np.arange(n), "value": matrix.ravel()})

    one = F.array(F.lit(1.0))
    beside = rows.select(
        part.alias("part"), F.concat(one, vector_to_array(features), F.array(F.col(label).cast("double"))).alias("x")
    ).where("part IS NOT NULL")
    found = beside.mapInArrow(added, "part string, at long, value double").groupBy("part", "at").agg(F.sum("value").alias("value"))
    table = found.orderBy("part", "at").toArrow()
    names, values = table.column("part").to_numpy(), table.column("value").to_numpy()
    out = {}
    for name in sorted(set(names.tolist())):
        mine = values[names == name]
        width = int(round(len(mine) ** 0.5))
        out[name] = Sums(mine.reshape(width, width))
    return out


def elastic_net(sums: Sums, reg_param: float = 0.0, elastic_net: float = 0.0) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of penalised least squares.

    Columns and label are scaled to a variance of 1 first, and the penalty holds for what is so
    scaled: reg_param / sd(label) * (elastic_net * |b| + (1 - elastic_net) / 2 * b²), beside half the
    mean squared error. Columns that never vary have coefficient 0.
    """
    covariances = sums.covariances
    scale = np.sqrt(np.maximum(np.diag(covariances), 0))
    scale[scale <= 1e-12 * np.sqrt(np.maximum(np.diag(sums.products)[1:] / sums.n, 0))] = 0
    if not scale[-1]:
        return float(sums.means[-1]), np.zeros(len(scale) - 1)
    live = np.flatnonzero(scale[:-1])
    inside = covariances[np.ix_(live, live)] / np.outer(scale[live], scale[live])
    target = covariances[live, -1] / (scale[live] * scale[-1])
    strength = reg_param / scale[-1]
    ridge, lasso = strength * (1 - elastic_net), strength * elastic_net
    if lasso == 0:
        b = np.linalg.lstsq(inside + ridge * np.eye(len(live)), target, rcond=None)[0]
    else:
        b = np.zeros(len(live))
        for _ in range(MOST_SWEEPS):
            moved = 0.0
            for j in range(len(live)):
                rest = target[j] - inside[j] @ b + inside[j, j] * b[j]
                new = np.sign(rest) * max(abs(rest) - lasso, 0.0) / (inside[j, j] + ridge)
                moved = max(moved, abs(new - b[j]))
                b[j] = new
            if moved <= TOLERANCE:
                break
    coefficients = np.zeros(len(scale) - 1)
    coefficients[live] = b * scale[-1] / scale[live]
    return float(sums.means[-1] - coefficients @ sums.means[:-1]), coefficients


@dataclass
class LinearModel:
    """A fitted line; ``transform`` adds ``prediction``."""

    intercept: float
    coefficients: np.ndarray
    reg_param: float = 0.0
    elastic_net: float = 0.0

    def transform(self, rows: DataFrame, features: str = "features") -> DataFrame:
        weights = F.array(*[F.lit(float(c)) for c in self.coefficients])
        products = F.zip_with(vector_to_array(features), weights, lambda x, w: x * w)
        total = F.aggregate(products, F.lit(float(self.intercept)), lambda a, x: a + x)
        return rows.withColumn("prediction", total)


def best_of_grid(
    fit: Sums, validate: Sums, reg_params: Sequence[float], elastic_nets: Sequence[float]
) -> tuple[LinearModel, list[tuple[float, float, float]]]:
    """The model with the best r2 on ``validate``, refitted on both parts, and the r2 of each point."""
    points = [(r, e, validate.r2(*elastic_net(fit, r, e))) for r in reg_params for e in elastic_nets]
    reg_param, mixed, _ = max(points, key=lambda point: point[2])
    return LinearModel(*elastic_net(fit + validate, reg_param, mixed), reg_param, mixed), points


# ---- classifiers ----------------------------------------------------------------------

BINS = 1 << 12


def score_histogram(scored: DataFrame, score: str = "score", label: str = "label", bins: int = BINS) -> DataFrame:
    """label, bin, n, total: rows and sums of scores in equal bins of the scores 0 to 1.

    Histograms of parts add up, and every rate at every bin's edge follows from them.
    """
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(label, place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(score).alias("total"))


def rates(histogram: DataFrame, label: str = "label", bins: int = BINS) -> DataFrame:
    """threshold, tp, fp, tn, fn, recall, false_rate, precision at the edge of every bin that occurs.

    At most ``bins`` rows, whatever the number of rows behind them.
    """
    by_bin = histogram.groupBy("bin").agg(
        F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).alias("ones"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(F.col("n"))).alias("zeros"),
    )
    down, whole = Window.orderBy(F.desc("bin")), Window.partitionBy()
    counted = by_bin.select(
        (F.col("bin") / bins).alias("threshold"), F.sum("ones").over(down).alias("tp"), F.sum("zeros").over(down).alias("fp"),
        F.sum("ones").over(whole).alias("_ones"), F.sum("zeros").over(whole).alias("_zeros"),
    )
    return counted.select(
        "threshold", "tp", "fp", (F.col("_zeros") - F.col("fp")).alias("tn"), (F.col("_ones") - F.col("tp")).alias("fn"),
        F.try_divide("tp", "_ones").alias("recall"), F.try_divide("fp", "_zeros").alias("false_rate"),
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
    )


def area_under_curve(rated: DataFrame) -> float:
    """Area under recall against false rate, by trapezoids between the edges of bins.

    Not a number if a label does not occur.
    """
    found = rated.select("false_rate", "recall", "threshold").orderBy(F.desc("threshold")).collect()
    points = [(0.0, 0.0), *((row["false_rate"], row["recall"]) for row in found)]
    if not found or None in points[-1]:
        return float("nan")
    return sum((x1 - x0) * (y1 + y0) / 2 for (x0, y0), (x1, y1) in zip(points, points[1:]))


# ---- clusters -------------------------------------------------------------------------


def cluster_sums(assigned: DataFrame, cluster: Sequence[str], features: str = "features") -> DataFrame:
    """One row for each cluster and coordinate: n, total, squares.

    Centres are total / n, the squared error around them is the sum of squares - total² / n; both add
    up over clusters to what holds of all rows, whatever the clusters are. ``cluster`` may name
    the predictions of several models: all are summed at one reading.
    """
    spread = assigned.select(
        F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.col(name).alias("cluster")) for name in cluster])).alias("_c"),
        vector_to_array(features).alias("_v"),
    )
    places = spread.select("_c.model", "_c.cluster", F.posexplode("_v").alias("place", "x"))
    return places.groupBy("model", "cluster", "place").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"), F.sum(F.col("x") * F.col("x")).alias("squares")
    )


# ---- trees ----------------------------------------------------------------------------

SPLIT_BINS = 64


def split_gains(rows: DataFrame, features: str = "features", label: str = "label", bins: int = SPLIT_BINS) -> DataFrame:
    """feature, bin, threshold, left, right, gain: what each split of the rows gains in Gini impurity.

    Values of a feature are put into equal bins between its least and its greatest; labels 0 and
    1 are counted by feature and bin, in the tasks first, and prefix sums over at most ``bins`` rows
    of a feature give both sides of every split. It is the search of a tree for one node, as a
    table, and checks the split that a fitted tree starts with.
    """
    values = rows.select(F.col(label).cast("int").alias("_y"), F.posexplode(vector_to_array(features)).alias("feature", "x"))
    spans = values.groupBy("feature").agg(F.min("x").alias("_low"), F.max("x").alias("_high")).where("_low < _high")
    place = F.least(F.floor((F.col("x") - F.col("_low")) / (F.col("_high") - F.col("_low")) * bins), F.lit(bins - 1)).cast("int")
    binned = values.join(spans, "feature").groupBy("feature", "_low", "_high", place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("ones")
    )
    up, whole = Window.partitionBy("feature").orderBy("bin"), Window.partitionBy("feature")
    sides = binned.select(
        "feature", "bin", (F.col("_low") + (F.col("bin") + 1) * (F.col("_high") - F.col("_low")) / bins).alias("threshold"),
        F.sum("n").over(up).alias("left"), F.sum("ones").over(up).alias("_left_ones"),
        F.sum("n").over(whole).alias("_n"), F.sum("ones").over(whole).alias("_ones"),
    ).withColumn("right", F.col("_n") - F.col("left")).where("right > 0")

    def impurity(ones: Column, n: Column) -> Column:
        return 2 * (ones / n) * (1 - ones / n)

    below = impurity(F.col("_left_ones"), F.col("left")) * F.col("left") / F.col("_n")
    above = impurity(F.col("_ones") - F.col("_left_ones"), F.col("right")) * F.col("right") / F.col("_n")
    gain = impurity(F.col("_ones"), F.col("_n")) - below - above
    return sides.select("feature", "bin", "threshold", "left", "right", gain.alias("gain"))

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan_of, rows
from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tablecraft.ml import features as ft
from tablecraft.ml import jobs, models
from tablecraft.ml import recommend as rec
from tablecraft.ml import retrieval, sums

# ---- features -------------------------------------------------------------------------


def test_ties_are_indexed_alphabetically(spark):
    frame = spark.createDataFrame([(c,) for c in "bbaacccd"], "category string")
    _, indexed = ft.index_labels(frame, ["category"])
    assert dict(rows(indexed.distinct())) == {"c": 0.0, "a": 1.0, "b": 2.0, "d": 3.0}
    assert dict((v, k) for k, v in rows(ft.labels_in_use(indexed, "category"))) == dict(rows(indexed.distinct()))
    encoded = ft.one_hot_encoder(["category"]).fit(indexed).transform(indexed)
    slots = dict(rows(encoded.select("category", vector_to_array("category_vector")).distinct()))
    assert slots == {"c": [1.0, 0.0, 0.0], "a": [0.0, 1.0, 0.0], "b": [0.0, 0.0, 1.0], "d": [0.0, 0.0, 0.0]}


def test_several_columns_and_unseen_labels(spark):
    train = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "q")], "a string, b string")
    test = spark.createDataFrame([("z", "q")], "a string, b string")
    strict, _ = ft.index_labels(train, ["a", "b"])
    with pytest.raises(Exception, match="Unseen label"):
        strict.transform(test).collect()
    lenient, _ = ft.index_labels(train, ["a", "b"], on_unseen="keep")
    assert rows(lenient.transform(test).select("a_index", "b_index")) == [(2.0, 0.0)]
    skipping, _ = ft.index_labels(train, ["a", "b"], on_unseen="skip")
    assert skipping.transform(test).count() == 0


def test_label_table_gives_the_indexers_numbers_for_many_labels(spark):
    frame = spark.range(200_000).selectExpr("cast(id % 150000 AS string) AS a").union(spark.createDataFrame([(None,)], "a string"))
    numbers = {r["label"]: r["index"] for r in ft.label_table(frame, "a").collect()}
    assert len(numbers) == 150_000 and sorted(numbers.values()) == [float(i) for i in range(150_000)]
    labels = ft.string_indexer(["a"]).setHandleInvalid("skip").fit(frame).labelsArray[0]
    assert [numbers[label] for label in labels] == [float(i) for i in range(150_000)]


def test_null_policies(spark):
    frame = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        ft.assembler(["a", "b"]).transform(frame).collect()
    assert ft.assembler(["a", "b"], nulls="skip").transform(frame).count() == 1
    filled, policy = ft.fill_or_keep(frame, ["a", "b"], "zero")
    assert policy == "error" and rows(filled) == [(0.0, 3.0), (1.0, 2.0)]
    with pytest.raises(ValueError):
        ft.fill_or_keep(frame, ["a"], "mean")


def test_stable_split_is_whole_disjoint_and_stays_put(spark):
    frame = spark.range(5000).withColumn("v", F.col("id") * 2)
    first, second = ft.stable_split(frame, 0.8, ["id"], seed=3)
    again, _ = ft.stable_split(frame.repartition(7).orderBy(F.desc("id")), 0.8, ["id"], seed=3)
    assert first.count() + second.count() == 5000
    assert first.join(second, "id").count() == 0
    assert rows(first) == rows(again)
    assert abs(first.count() - 4000) < 120
    other, _ = ft.stable_split(frame, 0.8, ["id"], seed=4)
    assert rows(other) != rows(first)
    with pytest.raises(ValueError):
        ft.stable_split(frame, 1.0, ["id"])


def test_random_split_repeats_with_its_seed(spark):
    frame = spark.range(1000)
    assert rows(ft.random_split(frame, 0.8, 5)[0]) == rows(ft.random_split(frame, 0.8, 5)[0])
    assert sum(part.count() for part in ft.random_split(frame, 0.8, 5)) == 1000


# ---- regression -----------------------------------------------------------------------


def gym(spark, n=40):
    source = np.random.default_rng(2)
    data = [
        (i, "M" if i % 2 else "F", int(source.integers(18, 26)), int(source.integers(160, 190)), int(source.integers(55, 90)))
        for i in range(n)
    ]
    reps = [30 + 0.4 * d[4] - 0.1 * d[3] + (2 if d[1] == "F" else 0) + source.normal() for d in data]
    columns = "CompetitorID int, Gender string, Age int, Height int, Weight int, NoOfReps double"
    return spark.createDataFrame([(*d, float(r)) for d, r in zip(data, reps)], columns)


def test_plain_regression_is_least_squares(spark):
    frame = gym(spark)
    fitted = jobs.repetitions_regression(frame)
    data = frame.toPandas()
    design = np.column_stack([
        np.ones(len(data)), data.Age, data.Height, data.Weight, (data.Gender == "F").astype(float)
    ])
    expected, *_ = np.linalg.lstsq(design, data.NoOfReps, rcond=None)
    got = fitted.coefficients.collect()
    assert [r["term"] for r in got] == ["intercept", "Age", "Height", "Weight", "Gender_vector_F"]
    assert [r["coefficient"] for r in got] == pytest.approx(list(expected), abs=1e-6)
    predictions = [r[0] for r in fitted.predictions.orderBy("CompetitorID").select("prediction").collect()]
    assert predictions == pytest.approx(list(design @ expected), abs=1e-6)


def test_label_tables_give_the_regression_of_the_indexer(spark):
    frame = gym(spark, 60).withColumn("town", F.concat(F.lit("t"), F.col("CompetitorID") % 7))
    settings = "NoOfReps", ["Age", "Gender", "Weight", "town"], ["Gender", "town"]
    plain, joined = models.linear_regression(frame, *settings), models.linear_regression(frame, *settings, label_tables=True)
    expected = {r[0]: r[1] for r in plain.coefficients.collect()}
    found = {r[0]: r[1] for r in joined.coefficients.collect()}
    assert found == pytest.approx(expected, abs=1e-6)
    assert dict(rows(joined.metrics)) == pytest.approx(dict(rows(plain.metrics)))
    tables, _ = ft.table_indexed(frame, ["town"])
    other = frame.limit(2).withColumn("town", F.lit("nowhere"))
    with pytest.raises(PySparkException, match="Unseen label in town"):
        ft.table_indexed(other, ["town"], tables=tables)[1].collect()
    assert ft.table_indexed(other, ["town"], "skip", tables)[1].count() == 0
    with pytest.raises(ValueError):
        ft.table_indexed(other, ["town"], "keep")


def test_regression_with_very_many_labels(spark):
    """More slots than the driver's solver takes: labels only in tables."""
    frame = spark.range(30_000).selectExpr("concat('label-', id % 10000) AS c", "id % 13 AS x", "(id % 10000) % 50 + 2.0 * (id % 13) AS y")
    fitted = models.linear_regression(frame, "y", ["x", "c"], ["c"], label_tables=True)
    assert dict(rows(fitted.metrics))["train_r2"] > 0.999
    assert fitted.coefficients.count() == 1 + 1 + 9_999


def houses(spark, n=300):
    source = np.random.default_rng(5)
    data = []
    for i in range(n):
        living = int(source.integers(500, 4000))
        above = int(living * source.uniform(0.5, 1))
        bedrooms, floors = int(source.integers(1, 6)), int(source.integers(1, 4))
        grade = int(source.integers(4, 8))
        price = 100.0 * living + 20000.0 * grade + 5000.0 * bedrooms + source.normal() * 3000
        data.append((i, float(price), bedrooms, 1.5, living, above, floors, i % 3, grade, 98000 + i % 4, i % 2, "x"))
    columns = (
        "id int, price double, bedrooms int, bathrooms double, sqft_living int, sqft_above int, floors int, "
        "condition int, grade int, zipcode int, waterfront int, date string"
    )
    return spark.createDataFrame(data, columns)


def test_house_prices(spark):
    frame = jobs.with_share_above(houses(spark))
    fitted = jobs.house_price_model(frame)
    figures = dict(rows(fitted.metrics))
    assert figures["holdout_r2"] > 0.99 and figures["train_r2"] > 0.99
    grid = fitted.grid.collect()
    assert len(grid) == 9
    best = max(grid, key=lambda r: r["validation_metric"])
    assert (best["reg_param"], best["elastic_net"]) == (figures["reg_param"], figures["elastic_net"])
    by_hand = fitted.predictions.agg(
        F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)))
    ).first()[0]
    assert figures["holdout_rmse"] == pytest.approx(by_hand, rel=1e-9)
    assert fitted.coefficients.count() == 1 + 6 + 2 + 3 + 3
    correlations = {(r[0], r[1]): r[2] for r in jobs.house_correlations(houses(spark)).collect()}
    names = {a for a, _ in correlations}
    assert names == {"price", "bedrooms", "bathrooms", "sqft_living", "sqft_above", "floors"}
    assert correlations["bathrooms", "price"] is None  # never varies
    assert correlations["price", "price"] == 1.0 and correlations["sqft_living", "price"] > 0.9


@pytest.mark.parametrize(("reg_param", "mixed"), [(0.0, 0.0), (0.5, 0.0), (0.5, 1.0), (3.0, 0.5)])
def test_sums_give_the_fits_of_spark(spark, reg_param, mixed):
    rows_ = ft.assembler(["Age", "Height", "Weight", "constant"]).transform(gym(spark, 200).withColumn("constant", F.lit(3.0)))
    found = sums.sums_by_part(rows_, F.when(F.col("CompetitorID") % 2 == 0, "even").otherwise("odd"), label="NoOfReps")
    whole = found["even"] + found["odd"]
    intercept, coefficients = sums.elastic_net(whole, reg_param, mixed)
    theirs = LinearRegression(labelCol="NoOfReps", regParam=reg_param, elasticNetParam=mixed, solver="normal", tol=1e-12, maxIter=1000).fit(rows_)
    assert list(coefficients) == pytest.approx(list(theirs.coefficients), abs=1e-5)
    assert intercept == pytest.approx(theirs.intercept, abs=1e-3)
    assert whole.r2(intercept, coefficients) == pytest.approx(theirs.summary.r2, abs=1e-6)
    assert whole.rmse(intercept, coefficients) == pytest.approx(theirs.summary.rootMeanSquaredError, abs=1e-6)


def test_wide_features_are_fitted_point_by_point(spark):
    frame = jobs.with_share_above(houses(spark))
    narrow, wide = jobs.house_price_model(frame), jobs.house_price_model(frame, most_terms=3)
    assert wide.grid.count() == narrow.grid.count() == 9
    assert dict(rows(wide.metrics))["holdout_r2"] == pytest.approx(dict(rows(narrow.metrics))["holdout_r2"], abs=1e-3)


def test_the_split_of_the_grid_does_not_follow_partitions(spark):
    frame = jobs.with_share_above(houses(spark))
    first = rows(jobs.house_price_model(frame).grid)
    again = rows(jobs.house_price_model(frame.repartition(5).orderBy(F.desc("id"))).grid)
    assert [r[:2] for r in first] == [r[:2] for r in again]
    assert [r[2] for r in first] == pytest.approx([r[2] for r in again], rel=1e-9)


def test_histograms_give_rates_and_area(spark):
    source = random.Random(3)
    data = [(int(source.random() < 0.4), round(source.random() * 64) / 64) for _ in range(500)]
    scored = spark.createDataFrame(data, "label int, score double")
    first, second = scored.randomSplit([0.5, 0.5], 1)
    merged = sums.score_histogram(first, bins=64).unionByName(sums.score_histogram(second, bins=64))
    rated = {r["threshold"]: r for r in sums.rates(merged, bins=64).collect()}
    for threshold in (0.25, 0.5, 0.75):
        said = [(label, score >= threshold) for label, score in data]
        r = rated[threshold]
        assert (r["tp"], r["fp"], r["tn"], r["fn"]) == tuple(said.count(x) for x in [(1, True), (0, True), (0, False), (1, False)])
        assert r["recall"] == pytest.approx(r["tp"] / (r["tp"] + r["fn"]))
    ones, zeros = ([s if s < 1 else 63 / 64 for label, s in data if label == x] for x in (1, 0))
    wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    assert sums.area_under_curve(sums.rates(merged, bins=64)) == pytest.approx(wins / len(ones) / len(zeros))


def test_share_of_no_living_area_is_null(spark):
    frame = spark.createDataFrame([(0, 0), (100, 50)], "sqft_living int, sqft_above int")
    assert rows(jobs.with_share_above(frame).select("sqft_above_percentage")) == [(0.5,), (None,)]


# ---- classification -------------------------------------------------------------------


def subscriptions(spark, n=400):
    source = random.Random(7)
    data = []
    for i in range(n):
        last = source.choice([None, 0, 1, 5, 20])
        next_views = None if (last or 0) < 1 and source.random() < 0.9 else 3
        data.append((
            i, source.choice(["card", "paypal"]), source.choice(["GB", "US", "FR"]), source.choice([1, 6, 12]),
            source.choice([None, 1]), source.randrange(20, 60), source.randrange(100), last, next_views,
            source.choice([False, False, False, True, None]),
        ))
    columns = (
        "id int, payment_method_type string, country string, rebill_period_in_months int, firstSub int, age int, "
        "all_time_views int, last_month_views int, next_month_views int, is_cancelled boolean"
    )
    return spark.createDataFrame(data, columns)


def test_churn_rows(spark):
    frame = spark.createDataFrame(
        [(1, None, None, None, None, False), (2, 1, 2, 3, 1, False), (3, 1, 1, 1, 0, False), (4, 1, 1, 1, 1, None), (5, 1, 1, 1, 1, True)],
        "id int, firstSub int, all_time_views int, last_month_views int, next_month_views int, is_cancelled boolean",
    )
    assert rows(jobs.churn_rows(frame).drop("is_cancelled")) == [(1, 0, 0, 0, 1), (2, 1, 2, 3, 0), (3, 1, 1, 1, 1)]


@pytest.mark.parametrize("metric", ["auc", "r2"])
def test_churn_model(spark, metric):
    fitted = jobs.churn_model(
        subscriptions(spark).coalesce(1), keys=["id"], metric=metric, reg_params=(0.01, 0.5), elastic_nets=(0.0, 1.0)
    )
    figures = dict(rows(fitted.metrics))
    assert fitted.grid.count() == 4
    table = {(r["label"], r["prediction"]): r["n"] for r in models.confusion_table(fitted.predictions).collect()}
    total = sum(table.values())
    right = table.get((0, 0.0), 0) + table.get((1, 1.0), 0)
    true_ones = table.get((1, 1.0), 0) + table.get((1, 0.0), 0)
    said_ones = table.get((1, 1.0), 0) + table.get((0, 1.0), 0)
    assert figures["holdout_accuracy"] == pytest.approx(right / total)
    assert figures["recall_1"] == pytest.approx(table.get((1, 1.0), 0) / true_ones)
    assert figures["likelihood_1"] == pytest.approx(figures["recall_1"])
    if said_ones:
        assert figures["precision_1"] == pytest.approx(table.get((1, 1.0), 0) / said_ones)
    assert figures["holdout_accuracy"] > 0.7
    with pytest.raises(ValueError):
        jobs.churn_model(subscriptions(spark), metric="f1")


def test_null_age_fails_unless_a_policy_is_named(spark):
    frame = subscriptions(spark, 80).coalesce(1).withColumn("age", F.when(F.col("id") > 5, F.col("age")))
    settings = dict(keys=["id"], reg_params=(0.1,), elastic_nets=(0.0,), on_unseen="keep")
    with pytest.raises(Exception, match="null"):
        jobs.churn_model(frame, **settings)
    assert jobs.churn_model(frame, nulls="zero", **settings).metrics.count() >= 6


def test_tree_and_forest(spark):
    source = random.Random(9)
    data = [(source.choice(["GB", "FR", "BR"]), source.choice([1, 6]), source.randrange(20), source.randrange(1000)) for _ in range(400)]
    frame = spark.createDataFrame(
        [(i, c, p, a, s, 2 if a > 9 and c != "BR" else 0) for i, (c, p, a, s) in enumerate(data)],
        "id int, country string, rebill_period int, chapter_access_count int, seconds_watched int, payments_made int",
    )
    parts = jobs.trial_parts(jobs.trial_rows(frame), keys=["id"])
    tree, forest = jobs.trial_models(parts)
    accuracy = rows(tree.metrics)[0][1]
    by_hand = tree.predictions.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert accuracy == pytest.approx(by_hand) and accuracy > 0.95
    assert {v for _, v in rows(parts.countries)} == {"GB", "EUROPE", "OTHER"}
    assert any(" in {" in r["rule"] for r in models.rule_lines(tree).collect())
    assert tree.model.depth <= 3 and forest.model.getNumTrees == 20
    assert "uid" not in tree.rules
    assert forest.rules == models.random_forest(parts.training, parts.holdout).rules


# ---- clusters -------------------------------------------------------------------------


def test_clusters(spark):
    found = jobs.competitor_clusters(gym(spark), counts=(2, 3))
    figures = {r["k"]: r for r in found.figures.collect()}
    assert figures[3]["sse"] < figures[2]["sse"]
    assert all(-1 <= r["silhouette"] <= 1 for r in figures.values())
    sizes = rows(found.sizes)
    assert sum(n for k, _, n in sizes if k == 2) == 40 and len(sizes) == 5
    centres = {(r["k"], r["cluster"]): np.array(r["centre"]) for r in found.centres.collect()}
    frame = gym(spark).toPandas()
    points = np.column_stack([(frame.Gender == "F").astype(float), frame.Age, frame.Height, frame.Weight, frame.NoOfReps])
    distances = np.array([[((p - centres[2, c]) ** 2).sum() for c in range(2)] for p in points])
    assert figures[2]["sse"] == pytest.approx(distances.min(axis=1).sum(), rel=1e-9)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


# ---- recommendations ------------------------------------------------------------------


def watched(spark):
    source = random.Random(11)
    data = [(u, i, source.random()) for u in range(30) for i in source.sample(range(12), source.randrange(1, 10))]
    data += [(0, 0, 0.25), (0, 0, 0.25)]
    return spark.createDataFrame(data, "userId int, courseId int, proportionWatched double")


def ratings_of(spark):
    return rec.watch_ratings(watched(spark), "userId", "courseId", "proportionWatched")


def test_ratings_add_up(spark):
    views = spark.createDataFrame([(1, 2, 0.25), (1, 2, 0.5), (1, 3, 1.0)], "userId bigint, courseId bigint, proportionWatched double")
    assert rows(rec.watch_ratings(views, "userId", "courseId", "proportionWatched")) == [(1, 2, 75.0), (1, 3, 100.0)]
    huge = spark.createDataFrame([(2**40, 2, 0.25)], "userId bigint, courseId bigint, proportionWatched double")
    with pytest.raises(PySparkException):
        rec.watch_ratings(huge, "userId", "courseId", "proportionWatched").collect()


def test_top_items(spark):
    ratings = ratings_of(spark)
    model = rec.fit_recommender(ratings, seed=1)
    top = rows(rec.top_items(model))
    assert len(top) == 30 * 5 and {r[1] for r in top} == {1, 2, 3, 4, 5}
    assert top == rows(rec.top_items(rec.fit_recommender(ratings, seed=1)))
    few = ratings.select("user_id").distinct().orderBy("user_id").limit(2)
    assert rows(rec.top_items(model, users=few)) == [r for r in top if r[0] < 2]
    full = {(r["user_id"], i): x for r in model.recommendForAllUsers(5).collect() for i, x in enumerate(r["recommendations"], 1)}
    assert [(r[2], pytest.approx(r[3], rel=1e-5)) for r in top] == [(full[r[0], r[1]]["item_id"], full[r[0], r[1]]["rating"]) for r in top]
    assert "CartesianProduct" not in plan_of(rec.top_items(model)) and "NestedLoop" not in plan_of(rec.top_items(model))
    cold = spark.createDataFrame([(999, 1), (0, 1)], "user_id int, item_id int")
    assert model.transform(cold).count() == 1


def test_new_items_against_brute_force(spark):
    ratings = ratings_of(spark)
    model = rec.fit_recommender(ratings, seed=1)
    seen = {(r[0], r[1]) for r in ratings.collect()}
    everything = rows(rec.top_items(model, 100))
    expected = []
    for user in range(30):
        unseen = [r for r in everything if r[0] == user and (user, r[2]) not in seen]
        unseen.sort(key=lambda r: (-r[3], r[2]))
        expected += [(user, place, r[2], r[3]) for place, r in enumerate(unseen[:5], 1)]
    assert rows(rec.new_items(model, ratings)) == sorted(expected, key=repr)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_ids_of_any_type(spark, kind):
    """Large and textual ids give the recommendations of the same views with small numbers."""
    views = watched(spark)
    name = {"bigint": "2e12::bigint + {} * 3", "string": "concat('id-', lpad({}::string, 6, '0'))"}[kind]
    other = views.selectExpr(f"{name.format('userId')} AS userId", f"{name.format('courseId')} AS courseId", "proportionWatched")
    other = other.unionByName(other.limit(1).selectExpr(f"cast(null AS {kind}) AS userId", "courseId", "proportionWatched"))
    plain = rows(jobs.course_recommendations(views, seed=1))
    found = jobs.course_recommendations(other, seed=1)
    assert found.schema["user_id"].dataType.simpleString() == found.schema["item_id"].dataType.simpleString() == kind
    back = {"bigint": lambda x: (x - 2 * 10**12) // 3, "string": lambda x: int(x[3:])}[kind]
    given = sorted(((back(r[0]), r[1], r[2], back(r[3]), *r[4:]) for r in found.collect()), key=repr)
    key = lambda r: (r[0], r[1], r[2] or 0, r[3], r[6])
    assert sorted(map(key, given)) == sorted(map(key, plain))


def test_dense_ids(spark):
    frame = spark.range(5000).selectExpr("concat('u', id % 1234) AS u").union(spark.createDataFrame([(None,)], "u string"))
    numbers = {r["id"]: r["number"] for r in rec.dense_ids(frame, "u").collect()}
    assert [numbers[u] for u in sorted(numbers)] == list(range(1234))


@pytest.mark.parametrize("k", [1, 5, 60])
def test_best_items_equal_full_scoring(spark, k):
    """Blocks of 8 items and 16 users; ties, zero vectors, users that ask for more than there is."""
    source = np.random.default_rng(k)
    items = np.round(4 * source.normal(size=(50, 3)) * np.exp(source.normal(size=(50, 1)))) / 2  # exact products
    items[7] = items[3]
    items[9] = 0
    users = np.round(4 * source.normal(size=(60, 3))) / 2
    users[4] = 0
    wanted = [(u, v.tolist(), k + u % 2) for u, v in enumerate(users)]
    found = retrieval.best_items(
        spark.createDataFrame(wanted, "id long, v array<double>, k int"),
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id long, v array<double>"), 8, 16,
    )
    expected = []
    for u, v, most in wanted:
        scores = items @ np.array(v)
        for rank, i in enumerate(sorted(range(50), key=lambda i: (-scores[i], i))[:most], 1):
            expected.append((u, i, rank))
    assert sorted((r["user"], r["item"], r["rank"]) for r in found.collect()) == sorted(expected)


def test_blocks_out_of_reach_are_not_scored(spark):
    """Of 100 blocks with norms that halve, users need the first few."""
    items = [(i, [2.0 ** -(i // 8), 0.0]) for i in range(800)]
    users = [(u, [1.0, u / 100], 5) for u in range(50)]
    frames = spark.createDataFrame(users, "id long, v array<double>, k int"), spark.createDataFrame(items, "id long, v array<double>")
    found = retrieval.best_items(*frames, 8, 16)
    assert {r["item"] for r in found.collect()} == {0, 1, 2, 3, 4}
    joined = [line for line in plan_of(found).splitlines() if "Join" in line]
    assert len(joined) >= 1 and not any("NestedLoop" in line or "Cartesian" in line for line in joined)
    assert retrieval.best_items(frames[0], frames[1].limit(0)).count() == 0


def test_users_of_one_block_of_items_are_scored_once(spark):
    """No block of items is joined to each user, and no user goes through Python again."""
    users = spark.range(3000).selectExpr("id", "array(cast(id % 7 AS double), 1D) AS v", "3 AS k")
    items = spark.range(25).selectExpr("id", "array(1D, cast(id % 5 AS double)) AS v")
    found = retrieval.best_items(users, items)
    assert not any(word in plan_of(found) for word in ("Join", "MapInArrow"))
    assert {r["item"] for r in found.collect()} == {4, 9, 14} and found.count() == 9000


def test_rows_of_blocks_are_read_in_place():
    """40 rows of 400 kB are scored in less memory than four of them take."""
    items, users = np.arange(64, dtype="<i8"), np.arange(4096, dtype="<i8")
    own = {"ids": items.tobytes(), "vectors": np.ones((64, 10)).tobytes(), "rank": 10, "norm": 4.0, "u_ids": users.tobytes()}
    own |= {"u_vectors": np.ones((4096, 10)).tobytes(), "u_k": np.ones(4096, "<i4").tobytes(), "u_least": np.full(4096, 5.0).tobytes()}
    rows = [own | {"u_least": np.where(users == i, 3.0, 5.0).tobytes()} for i in range(40)]
    batch = pa.RecordBatch.from_pylist(rows)
    del rows
    tracemalloc.start()
    found = [(b.column("user")[0].as_py(), b.column("item")[0].as_py()) for b in retrieval._scored(iter([batch]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(i, 0) for i in range(40)]
    assert most < batch.nbytes / 10


def test_recommendations_beside_history(spark):
    report = jobs.course_recommendations(watched(spark), first_users=3, seed=1)
    seen = {(r[0], r[1]): r[2] for r in ratings_of(spark).collect()}
    offered = report.filter("kind = 'recommended'").collect()
    assert len(offered) == 15
    assert all(r["already_watched"] == ((r["user_id"], r["item_id"]) in seen) for r in offered)
    history = {(r["user_id"], r["item_id"]): r["rating"] for r in report.filter("kind = 'watched'").collect()}
    assert history == {key: value for key, value in seen.items() if key[0] < 3}
    fresh = jobs.course_recommendations(watched(spark), first_users=3, exclude_seen=True, seed=1)
    assert fresh.filter("kind = 'recommended' AND already_watched").count() == 0

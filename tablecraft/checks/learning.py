"""Features and models on the given tables."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.checks.registry import query, table
from tablecraft.functions import null_to_zero, ratio
from tablecraft.ml import features as ft
from tablecraft.ml import jobs, models, sums
from tablecraft.ml import recommend as rec
from tablecraft.shared import settled

# ---- features -------------------------------------------------------------------------

PRIORITY_SQL = """
    WITH ranked AS (
        SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS place
        FROM orders GROUP BY 1)
"""


def indexed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ft.index_labels(orders, ["o_orderpriority"])[1]


@query(f"""
    {PRIORITY_SQL}
    SELECT o_orderkey, o_orderpriority, place::DOUBLE AS priority_index
    FROM orders JOIN ranked USING (o_orderpriority)
""")
def string_index(spark, sf_dir):
    return indexed_orders(spark, sf_dir).select(
        "o_orderkey", "o_orderpriority", F.col("o_orderpriority_index").alias("priority_index")
    )


@query(f"{PRIORITY_SQL} SELECT place::DOUBLE AS o_orderpriority_index, o_orderpriority AS value FROM ranked")
def index_to_label(spark, sf_dir):
    return ft.labels_in_use(indexed_orders(spark, sf_dir), "o_orderpriority")


@query(f"""
    {PRIORITY_SQL}
    SELECT o_orderkey, (place = 0)::INTEGER AS is_0, (place = 1)::INTEGER AS is_1,
        (place = 2)::INTEGER AS is_2, (place = 3)::INTEGER AS is_3, 4 AS width
    FROM orders JOIN ranked USING (o_orderpriority)
""")
def one_hot(spark, sf_dir):
    indexed = indexed_orders(spark, sf_dir)
    encoded = ft.one_hot_encoder(["o_orderpriority"]).fit(indexed).transform(indexed)
    slots = vector_to_array("o_orderpriority_vector")
    return encoded.select("o_orderkey", slots.alias("slots")).select(
        "o_orderkey", *[F.col("slots")[i].cast("int").alias(f"is_{i}") for i in range(4)],
        F.size("slots").alias("width"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity AS first, l_extendedprice AS second, l_discount AS third
    FROM lineitem
""")
def assemble(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    assembled = ft.assembler(["l_quantity", "l_extendedprice", "l_discount"]).transform(lines)
    slots = vector_to_array("features")
    return assembled.select("l_orderkey", "l_linenumber", slots.alias("slots")).select(
        "l_orderkey", "l_linenumber",
        *[F.col("slots")[i].alias(name) for i, name in enumerate(("first", "second", "third"))],
    )


@query("""
    SELECT o_orderkey,
        CASE WHEN substr(md5('7|' || o_orderkey), 1, 8) < 'cccccccd' THEN 'train' ELSE 'holdout' END AS part
    FROM orders
""")
def key_split(spark, sf_dir):
    first, second = ft.stable_split(table(spark, sf_dir, "orders"), 0.8, ["o_orderkey"], seed=7)
    parts = [(first, "train"), (second, "holdout")]
    train, holdout = (rows.select("o_orderkey", F.lit(name).alias("part")) for rows, name in parts)
    return train.unionByName(holdout)


CHURN_SQL = """
    WITH seen AS (
        SELECT o_custkey, count(*) AS all_time,
            nullif(count(*) FILTER (year(o_orderdate) = 2000), 0) AS last_month,
            nullif(count(*) FILTER (year(o_orderdate) = 2001), 0) AS next_month,
            nullif(count(*) FILTER (o_orderstatus = 'P'), 0) AS first_sub,
            min(o_totalprice) AS smallest
        FROM orders GROUP BY 1)
"""


def order_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as subscriptions: orders are views, counts of 0 are unknown (null)."""
    year, status = F.year("o_orderdate"), F.col("o_orderstatus")

    def known(condition):
        return F.nullif(F.count_if(condition), F.lit(0).cast("bigint"))

    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("all_time_views"), known(year == 2000).alias("last_month_views"),
        known(year == 2001).alias("next_month_views"), known(status == "P").alias("firstSub"),
        F.when(F.min("o_totalprice") > 5000, F.min("o_totalprice") < 10000).alias("is_cancelled"),
    )


@query(f"""
    {CHURN_SQL}
    SELECT o_custkey, all_time AS all_time_views, coalesce(last_month, 0) AS last_month_views,
        CASE WHEN next_month > 0 THEN 0 ELSE 1 END AS label, coalesce(first_sub, 0) AS "firstSub"
    FROM seen WHERE smallest >= 10000
""")
def churn_labels(spark, sf_dir):
    return jobs.churn_rows(order_subscriptions(spark, sf_dir)).drop("is_cancelled")


# ---- documents as rows of numbers -----------------------------------------------------

DOCUMENTS_SQL = r"""
    WITH measured AS (
        SELECT doc_id, lang, source, n_chars::DOUBLE AS n_chars,
            len(string_split(text, ' '))::DOUBLE AS n_words,
            len(string_split(text, chr(10)))::DOUBLE AS n_lines,
            coalesce(length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / nullif(length(text), 0)::DOUBLE, 0)
                AS letter_share
        FROM documents)
"""


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by size, number of words and lines, share of letters, and variety of words."""
    text = F.col("text")
    words = F.split(text, " ")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        null_to_zero(ratio(F.length(F.regexp_replace(text, "[^a-zA-Z]+", "")), F.length(text))).alias("letter_share"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("word_variety"),
    )


# ---- regression -----------------------------------------------------------------------


def part_prices(spark: SparkSession, sf_dir: str) -> models.Fitted:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("double"), "p_retailprice")
    return models.linear_regression(parts, "p_retailprice", ["p_partkey"])


@query("""
    SELECT unnest(['intercept', 'p_partkey', 'train_r2']) AS term, round(unnest([
        regr_intercept(p_retailprice, p_partkey), regr_slope(p_retailprice, p_partkey),
        regr_r2(p_retailprice, p_partkey)]), 6) AS value
    FROM part
""")
def linreg_univariate(spark, sf_dir):
    fitted = part_prices(spark, sf_dir)
    terms = fitted.coefficients.select("term", F.col("coefficient").alias("value"))
    r2 = fitted.metrics.filter("metric = 'train_r2'").select(F.col("metric").alias("term"), "value")
    return terms.unionByName(r2).withColumn("value", F.round("value", 6))


@query("""
    SELECT p_partkey::DOUBLE AS p_partkey, p_retailprice AS label,
        round(intercept + slope * p_partkey, 4) AS prediction
    FROM part JOIN (
        SELECT regr_intercept(p_retailprice, p_partkey) AS intercept,
            regr_slope(p_retailprice, p_partkey) AS slope FROM part) ON true
""")
def linreg_predictions(spark, sf_dir):
    predictions = part_prices(spark, sf_dir).predictions
    return predictions.select("p_partkey", "label", F.round("prediction", 4).alias("prediction"))


def least_squares_sql(source: str, label: str, terms: dict[str, str], shown: dict[str, str]) -> str:
    """Coefficients of ``label`` on the named SQL terms, by successive residuals.

    ``shown`` holds the SQL of the name to show where it differs from the term's own.

    Step k leaves in every later term, and in the label, what term k does not explain;
    the slopes taken on the way give the coefficients back from the last to the first.
    """
    names = list(terms)
    later = [*names, "y"]
    steps = [
        "base AS (SELECT " + ", ".join(f"({sql})::DOUBLE AS {name}" for name, sql in terms.items())
        + f", {label} AS y FROM {source})",
        "step0 AS (SELECT " + ", ".join(f"{name} - avg({name}) OVER () AS {name}" for name in later) + " FROM base)",
        "means AS (SELECT " + ", ".join(f"avg({name}) AS {name}" for name in later) + " FROM base)",
    ]
    for k, name in enumerate(names, 1):
        rest = [*names[k:], "y"]
        slopes = ", ".join(f"regr_slope({other}, {name}) AS {other}" for other in rest)
        steps.append(f"slope{k} AS (SELECT {slopes} FROM step{k - 1})")
        left = ", ".join(f"s.{other} - g.{other} * s.{name} AS {other}" for other in rest)
        steps.append(f"step{k} AS (SELECT {left} FROM step{k - 1} s JOIN slope{k} g ON true)")
    for k in range(len(names), 0, -1):
        used = "".join(f" - (SELECT b FROM b{m}) * {names[m - 1]}" for m in range(k + 1, len(names) + 1))
        steps.append(f"b{k} AS (SELECT y{used} AS b FROM slope{k})")
    used = "".join(f" - (SELECT b FROM b{k}) * {name}" for k, name in enumerate(names, 1))
    rows = [f"SELECT 'intercept' AS term, round(y{used}, 5) AS coefficient FROM means"]
    for k, name in enumerate(names, 1):
        label_sql = shown.get(name, f"'{name}'")
        rows.append(f"SELECT {label_sql}, round(b, 5) FROM b{k}")
    return ", " + ", ".join(steps) + " " + " UNION ALL ".join(rows)


LANGUAGES_SQL = """,
    languages AS (
        SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS place
        FROM documents GROUP BY lang)
"""


def _language(place: int) -> str:
    return f"(SELECT lang FROM languages WHERE place = {place})"


@query(DOCUMENTS_SQL + LANGUAGES_SQL + least_squares_sql(
    "measured", "n_chars",
    {
        "n_words": "n_words", "n_lines": "n_lines", "letter_share": "letter_share",
        **{f"lang_{place}": f"lang = {_language(place)}" for place in range(3)},
    },
    {f"lang_{place}": f"'lang_vector_' || {_language(place)}" for place in range(3)},
))
def gym_style_regression(spark, sf_dir):
    """Three numbers and a one-hot category; the rarest language is the one left out."""
    fitted = jobs.repetitions_regression(
        document_rows(spark, sf_dir), "n_chars", ["n_words", "n_lines", "letter_share", "lang"], ["lang"]
    )
    return fitted.coefficients.withColumn("coefficient", F.round("coefficient", 5))


def tuned_sizes(spark: SparkSession, sf_dir: str) -> models.Fitted:
    return jobs.house_price_model(
        document_rows(spark, sf_dir), "n_chars",
        ["n_words", "n_lines", "letter_share", "word_variety", "lang", "source"], ["lang", "source"],
        keys=["doc_id"],
    )


#: Elastic net by coordinate descent on matrices of sums, one coordinate of all points a step.
TUNED_SQL = r"""
    WITH RECURSIVE rows AS (
        SELECT doc_id, lang, source, n_chars::DOUBLE AS y,
            len(string_split(text, ' '))::DOUBLE AS n_words, len(string_split(text, chr(10)))::DOUBLE AS n_lines,
            coalesce(length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / nullif(length(text), 0)::DOUBLE, 0) AS letter_share,
            len(list_distinct(string_split(text, ' '))) / len(string_split(text, ' '))::DOUBLE AS word_variety,
            CASE WHEN substr(md5('0|' || doc_id), 1, 8) >= 'cccccccd' THEN 'holdout'
                 WHEN substr(md5('1|' || doc_id), 1, 8) < 'cccccccd' THEN 'fit' ELSE 'validate' END AS part
        FROM documents),
    langs AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS place FROM rows WHERE part <> 'holdout' GROUP BY lang),
    sources AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS place FROM rows WHERE part <> 'holdout' GROUP BY source),
    filled AS (
        SELECT doc_id, part, y, [n_words, n_lines, letter_share, word_variety]
            || list_transform(range((SELECT max(place) FROM langs)), lambda i: (i = l.place)::INTEGER::DOUBLE)
            || list_transform(range((SELECT max(place) FROM sources)), lambda i: (i = s.place)::INTEGER::DOUBLE) AS x
        FROM rows JOIN langs l USING (lang) JOIN sources s USING (source)),
    halves AS (
        SELECT part AS half, doc_id, y, x FROM filled
        UNION ALL SELECT 'train', doc_id, y, x FROM filled WHERE part <> 'holdout'),
    wide AS (SELECT half, doc_id, list_append(x, y) AS z FROM halves),
    cells AS (SELECT half, doc_id, unnest(z) AS v, generate_subscripts(z, 1) AS i FROM wide),
    moments AS (SELECT half, i, count(*)::DOUBLE AS n, avg(v) AS mean, var_pop(v) AS var FROM cells GROUP BY half, i),
    joint AS (
        SELECT a.half, a.i, b.i AS j, avg((a.v - ma.mean) * (b.v - mb.mean)) AS cov
        FROM cells a JOIN cells b USING (half, doc_id)
        JOIN moments ma ON ma.half = a.half AND ma.i = a.i JOIN moments mb ON mb.half = b.half AND mb.i = b.i
        GROUP BY a.half, a.i, b.i),
    scaled AS (
        SELECT c.half, c.i, list(CASE WHEN a.var > 1e-20 AND b.var > 1e-20 THEN cov / sqrt(a.var * b.var) ELSE 0 END ORDER BY c.j) AS line
        FROM joint c JOIN moments a ON a.half = c.half AND a.i = c.i JOIN moments b ON b.half = c.half AND b.i = c.j
        GROUP BY c.half, c.i),
    matrices AS (SELECT half, list(line ORDER BY i) AS c, count(*) - 1 AS d FROM scaled GROUP BY half),
    points AS (
        SELECT half, r AS reg_param, e AS elastic_net, c, d,
            r / sqrt(var) * e AS lasso, r / sqrt(var) * (1 - e) AS ridge
        FROM matrices JOIN moments USING (half), unnest([0.01, 0.1, 0.5]) t(r), unnest([0.0, 0.5, 1.0]) u(e)
        WHERE half IN ('fit', 'train') AND i = d + 1),
    steps AS (
        SELECT half, reg_param, elastic_net, 0 AS step, list_transform(range(d), lambda i: 0::DOUBLE) AS b FROM points
        UNION ALL
        SELECT half, reg_param, elastic_net, step + 1, list_transform(b, lambda x, i: CASE WHEN i <> j OR c[j][j] = 0 THEN x
            ELSE sign(rest) * greatest(abs(rest) - lasso, 0) / (c[j][j] + ridge) END)
        FROM (
            SELECT s.*, p.c, p.lasso, p.ridge, step % d + 1 AS j,
                p.c[step % d + 1][d + 1] - list_dot_product(p.c[step % d + 1][1:d], s.b)
                    + p.c[step % d + 1][step % d + 1] * s.b[step % d + 1] AS rest
            FROM steps s JOIN points p USING (half, reg_param, elastic_net) WHERE step < d * {sweeps})),
    scales AS (SELECT half, list(sqrt(var) ORDER BY i) AS sd, list(mean ORDER BY i) AS mean FROM moments GROUP BY half),
    lines AS (
        SELECT s.half, reg_param, elastic_net,
            list_transform(b, lambda x, i: CASE WHEN sd[i] > 1e-10 THEN x * sd[d + 1] / sd[i] ELSE 0 END) AS w, mean, d
        FROM steps s JOIN points p USING (half, reg_param, elastic_net) JOIN scales c ON c.half = s.half
        WHERE step = d * {sweeps}),
    models AS (SELECT *, mean[d + 1] - list_dot_product(w, mean[1:d]) AS intercept FROM lines),
    grid AS (
        SELECT reg_param, elastic_net, 1 - sum((y - intercept - list_dot_product(w, x)) ** 2) / (count(*) * var_pop(y)) AS r2
        FROM models m JOIN filled f ON m.half = 'fit' AND f.part = 'validate' GROUP BY reg_param, elastic_net),
    chosen AS (
        SELECT m.* FROM models m JOIN (SELECT reg_param, elastic_net FROM grid ORDER BY r2 DESC LIMIT 1) USING (reg_param, elastic_net)
        WHERE m.half = 'train'),
    predicted AS (SELECT b.half, b.doc_id, b.y AS label, intercept + list_dot_product(w, x) AS prediction FROM halves b, chosen)
""".replace("{sweeps}", "600")


@query(TUNED_SQL + """
    SELECT unnest(['train_r2', 'train_rmse', 'holdout_r2', 'holdout_rmse', 'reg_param', 'elastic_net']) AS metric,
        round(unnest([
            (SELECT 1 - sum((label - prediction) ** 2) / (count(*) * var_pop(label)) FROM predicted WHERE half = 'train'),
            (SELECT sqrt(avg((label - prediction) ** 2)) FROM predicted WHERE half = 'train'),
            (SELECT 1 - sum((label - prediction) ** 2) / (count(*) * var_pop(label)) FROM predicted WHERE half = 'holdout'),
            (SELECT sqrt(avg((label - prediction) ** 2)) FROM predicted WHERE half = 'holdout'),
            reg_param::DOUBLE, elastic_net::DOUBLE]), 4) AS value
    FROM chosen
""")
def linreg_tuned(spark, sf_dir):
    return tuned_sizes(spark, sf_dir).metrics.withColumn("value", F.round("value", 4))


@query(TUNED_SQL + "SELECT doc_id, label, round(prediction, 2) AS prediction FROM predicted WHERE half = 'holdout'")
def linreg_holdout(spark, sf_dir):
    predictions = tuned_sizes(spark, sf_dir).predictions
    return predictions.select("doc_id", "label", F.round("prediction", 2).alias("prediction"))


@query(TUNED_SQL + "SELECT reg_param::DOUBLE AS reg_param, elastic_net::DOUBLE AS elastic_net, round(r2, 6) AS validation_metric FROM grid")
def grid_metrics(spark, sf_dir):
    return tuned_sizes(spark, sf_dir).grid.withColumn("validation_metric", F.round("validation_metric", 6))


# ---- classification -------------------------------------------------------------------


def document_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as subscriptions: those of low quality have no next view."""
    return document_rows(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", F.col("lang").alias("payment_method_type"), F.col("source").alias("country"),
        F.col("toxic").cast("string").alias("rebill_period_in_months"), F.col("letter_share").alias("firstSub"),
        F.col("word_variety").alias("age"), F.col("n_words").alias("all_time_views"),
        F.col("n_lines").alias("last_month_views"), F.col("quality").alias("next_month_views"),
        F.lit(False).alias("is_cancelled"),
    )


def churn(spark: SparkSession, sf_dir: str, **settings) -> models.Fitted:
    return jobs.churn_model(
        document_subscriptions(spark, sf_dir), keys=["doc_id"], on_unseen="keep", **settings
    )


DOCUMENT_LABELS_SQL = """
    WITH labelled AS (
        SELECT doc_id, CASE WHEN quality > 0 THEN 0 ELSE 1 END AS label, substr(md5('0|' || doc_id), 1, 8) < 'e6666666' AS train
        FROM documents JOIN labels USING (doc_id))
"""


@query(DOCUMENT_LABELS_SQL + """
    SELECT unnest(['train_n', 'train_ones', 'train_mean_score', 'holdout_n', 'holdout_ones']) AS metric,
        unnest([
            (count(*) FILTER (train))::DOUBLE, (sum(label) FILTER (train))::DOUBLE, round(avg(label) FILTER (train), 3),
            (count(*) FILTER (NOT train))::DOUBLE, coalesce(sum(label) FILTER (NOT train), 0)::DOUBLE]) AS value
    FROM labelled
""")
def churn_model(spark, sf_dir):
    """Figures of the tuned classifier that its rows decide: an intercept without a penalty makes
    the mean score of the training rows their share of label 1."""
    tied = ["train_n", "train_ones", "train_mean_score", "holdout_n", "holdout_ones"]
    metrics = churn(spark, sf_dir).metrics.where(F.col("metric").isin(tied))
    return metrics.withColumn("value", F.round("value", 3))


@query(DOCUMENT_LABELS_SQL + "SELECT label, count(*) AS n FROM labelled WHERE NOT train GROUP BY label")
def churn_confusion(spark, sf_dir):
    """Rows of the confusion table by label."""
    table = models.confusion_table(churn(spark, sf_dir).predictions)
    return table.groupBy(F.col("label").cast("int").alias("label")).agg(F.sum("n").alias("n"))


@query()
def churn_grid_r2(spark, sf_dir):
    return churn(spark, sf_dir, metric="r2").grid


def document_trials(spark: SparkSession, sf_dir: str) -> jobs.TrialParts:
    """Labelled documents as trials: quality is a payment, the language is the country."""
    rows = document_rows(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", F.upper("lang").alias("country"), F.col("quality").alias("payments_made"),
        F.col("n_lines").alias("rebill_period"), F.col("letter_share").alias("chapter_access_count"),
        F.col("word_variety").alias("seconds_watched"),
    )
    return jobs.trial_parts(jobs.trial_rows(rows), keys=["doc_id"])


def fitted_on_trials(spark: SparkSession, sf_dir: str, fit) -> models.Fitted:
    parts = document_trials(spark, sf_dir)
    with models.kept(parts.training, parts.holdout) as (training, holdout):
        return fit(training, holdout)


TRIALS_SQL = DOCUMENTS_SQL + """,
    trials AS (
        SELECT doc_id, CASE WHEN quality >= 1 THEN 1 ELSE 0 END AS label,
            CASE WHEN lang IN ('de', 'es', 'fr') THEN 'EUROPE' ELSE 'OTHER' END AS country, n_lines, letter_share,
            len(list_distinct(string_split(text, ' '))) / len(string_split(text, ' '))::DOUBLE AS word_variety,
            substr(md5('0|' || doc_id), 1, 8) < 'cccccccd' AS train
        FROM measured JOIN documents USING (doc_id) JOIN labels USING (doc_id)),
    countries AS (SELECT country, row_number() OVER (ORDER BY count(*) DESC, country) - 1 AS place FROM trials GROUP BY country)
""".replace("FROM measured JOIN documents USING (doc_id)", "FROM (SELECT m.*, text FROM measured m JOIN documents USING (doc_id))")


@query(TRIALS_SQL + """,
    cells AS (
        SELECT label, unnest([place::DOUBLE, n_lines, letter_share, word_variety]) AS x, unnest([0, 1, 2, 3]) AS feature
        FROM trials JOIN countries USING (country) WHERE train),
    spans AS (SELECT feature, min(x) AS low, max(x) AS high FROM cells GROUP BY feature HAVING min(x) < max(x)),
    binned AS (
        SELECT feature, least(floor((x - low) / (high - low) * 64), 63)::INTEGER AS bin, count(*) AS n, sum(label) AS ones
        FROM cells JOIN spans USING (feature) GROUP BY 1, 2),
    sides AS (
        SELECT feature, sum(n) OVER up AS l, sum(ones) OVER up AS lo, sum(n) OVER whole AS t, sum(ones) OVER whole AS o
        FROM binned WINDOW up AS (PARTITION BY feature ORDER BY bin), whole AS (PARTITION BY feature))
    SELECT feature, max(t)::BIGINT AS n, round(max(2 * (o / t) * (1 - o / t) - l / t * 2 * (lo / l) * (1 - lo / l)
        - (t - l) / t * 2 * ((o - lo) / (t - l)) * (1 - (o - lo) / (t - l))), 6) AS gain
    FROM sides WHERE l < t GROUP BY feature
""")
def tree_accuracy(spark, sf_dir):
    """The best first split by each feature, from counts by feature and bin."""
    training = document_trials(spark, sf_dir).training
    splits = sums.split_gains(training)
    return splits.groupBy("feature").agg(
        F.max(F.col("left") + F.col("right")).alias("n"), F.round(F.max("gain"), 6).alias("gain")
    )


@query()
def tree_rules(spark, sf_dir):
    return models.rule_lines(fitted_on_trials(spark, sf_dir, models.decision_tree))


@query()
def forest_accuracy(spark, sf_dir):
    return fitted_on_trials(spark, sf_dir, models.random_forest).metrics


@query(TRIALS_SQL + """
    SELECT model, label, count(*) AS n FROM trials, unnest(['tree', 'forest']) t(model) WHERE NOT train GROUP BY ALL
""")
def trial_accuracies(spark, sf_dir):
    """Tree and forest side by side: the rows that each of them judges, by label."""
    tree, forest = jobs.trial_models(document_trials(spark, sf_dir))
    judged = tree.predictions.select("label", F.lit("tree").alias("model")).unionByName(
        forest.predictions.select("label", F.lit("forest").alias("model"))
    )
    return judged.groupBy("model", F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT (row_number() OVER (ORDER BY count(*) DESC, country) - 1)::DOUBLE AS country_index, country AS value
    FROM (SELECT CASE WHEN lang IN ('de', 'es', 'fr') THEN 'EUROPE' ELSE 'OTHER' END AS country
          FROM documents JOIN labels USING (doc_id))
    GROUP BY country
""")
def trial_countries(spark, sf_dir):
    return document_trials(spark, sf_dir).countries


# ---- clusters -------------------------------------------------------------------------


def embedding_clusters(spark: SparkSession, sf_dir: str) -> models.Clusters:
    vectors = table(spark, sf_dir, "embeddings").select(array_to_vector("embedding").alias("features"))
    return models.cluster_sweep(vectors)


EMBEDDED_SQL = """
    WITH cells AS (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS place FROM embeddings),
    places AS (SELECT place, count(*) AS n, sum(x) AS total, sum(x * x) AS squares FROM cells GROUP BY place)
"""


@query(EMBEDDED_SQL + """
    SELECT k::INTEGER AS k, max(n) AS n, round(sum(squares - total * total / n), 4) AS spread
    FROM places, range(2, 9) t(k) GROUP BY k
""")
def kmeans_sweep(spark, sf_dir):
    """For every number of clusters: its rows, and the squared errors around its centres and of these
    around the mean, which add up to the spread of the rows."""
    found = embedding_clusters(spark, sf_dir).sums
    by_cluster = found.groupBy("k", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("squares") - F.col("total") ** 2 / F.col("n")).alias("within"),
        (F.sum(F.col("total") ** 2 / F.col("n")) - F.sum("total") ** 2 / F.sum("n")).alias("between"),
    )
    return by_cluster.groupBy("k").agg(F.max("n").alias("n"), F.round(F.sum(F.col("within") + F.col("between")), 4).alias("spread"))


@query(EMBEDDED_SQL + """
    SELECT k::INTEGER AS k, place::INTEGER AS place, n, round(total / n, 9) AS mean FROM places, range(2, 9) t(k)
""")
def kmeans_sizes(spark, sf_dir):
    """Centres weighted by the sizes of their clusters: the mean of the rows."""
    found = embedding_clusters(spark, sf_dir).sums
    centres = found.withColumn("centre", F.col("total") / F.col("n"))
    weighted = F.sum(F.col("centre") * F.col("n")) / F.sum("n")
    return centres.groupBy("k", "place").agg(F.sum("n").alias("n"), F.round(weighted, 9).alias("mean"))


@query("""
    WITH types AS (SELECT p_type, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS place FROM part GROUP BY p_type),
    places AS (
        SELECT place, n::DOUBLE AS total FROM types WHERE place < (SELECT max(place) FROM types)
        UNION ALL SELECT (SELECT max(place) FROM types), sum(p_size) FROM part
        UNION ALL SELECT (SELECT max(place) FROM types) + 1, sum(p_retailprice) FROM part)
    SELECT k::INTEGER AS k, place::INTEGER AS place, (SELECT count(*) FROM part) AS n, round(total, 4) AS total
    FROM places, range(2, 9) t(k)
""")
def competitor_clusters(spark, sf_dir):
    """What the clusters of every number hold of each feature."""
    parts = table(spark, sf_dir, "part")
    found = jobs.competitor_clusters(parts, ["p_type", "p_size", "p_retailprice"], ["p_type"]).sums
    return found.groupBy("k", "place").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))


# ---- recommendations ------------------------------------------------------------------


def order_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered quantities of a customer from a nation as watched shares of a course."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(orders, lines.l_orderkey == orders.o_orderkey)
        .select(
            F.col("o_custkey").alias("userId"), F.col("s_nationkey").alias("courseId"),
            (F.col("l_quantity") / 50).alias("proportionWatched"),
        )
    )


RATINGS_SQL = """
    SELECT o_custkey::INTEGER AS user_id, s_nationkey AS item_id, (sum(l_quantity / 50) * 100)::FLOAT AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY 1, 2
"""


def order_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.watch_ratings(order_shares(spark, sf_dir), "userId", "courseId", "proportionWatched")


@query(f"SELECT user_id, item_id, round(rating::DOUBLE, 2) AS rating FROM ({RATINGS_SQL})")
def recommend_ratings(spark, sf_dir):
    ratings = order_ratings(spark, sf_dir)
    return ratings.withColumn("rating", F.round(F.col("rating").cast("double"), 2))


@query()
def recommend_top5(spark, sf_dir):
    return rec.top_items(rec.fit_recommender(order_ratings(spark, sf_dir)))


@query()
def recommend_new_items(spark, sf_dir):
    ratings = settled(order_ratings(spark, sf_dir))
    return rec.new_items(rec.fit_recommender(ratings), ratings)


HISTORY_SQL = f"""
    SELECT user_id::BIGINT AS user_id, item_id, round(rating::DOUBLE, 2) AS rating FROM ({RATINGS_SQL})
"""


@query(HISTORY_SQL)
def recommend_with_history(spark, sf_dir):
    """What stands beside the recommendations of all users: their whole history.

    The recommended rows of the same report are those of ``recommend_top5``.
    """
    report = jobs.course_recommendations(order_shares(spark, sf_dir))
    watched = report.where("kind = 'watched'")
    return watched.select("user_id", "item_id", F.round(F.col("rating").cast("double"), 2).alias("rating"))

"""Projections, filters, aggregates, pivots, correlation, logs and words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablecraft import fixed_values as fixed
from tablecraft import functions as fn
from tablecraft import operators as ops
from tablecraft.checks.registry import query, table
from tablecraft.plans import exam_report, log_report
from tablecraft.plans import words as word_report
from tablecraft.sources import inline_lookup, register_view

# ---- plain projections and aggregates -------------------------------------------------


@query("SELECT sum(l_linenumber)::BIGINT AS total FROM lineitem")
def global_sum(spark, sf_dir):
    return ops.global_sum(table(spark, sf_dir, "lineitem"), "l_linenumber")


@query("SELECT count(*) AS n FROM lineitem")
def global_count(spark, sf_dir):
    return ops.global_count(table(spark, sf_dir, "lineitem"))


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice AS value, sqrt(l_extendedprice) AS root
    FROM lineitem
""")
def sqrt_projection(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("value"),
        F.sqrt("l_extendedprice").alias("root"),
    )


@query("""
    SELECT l_orderkey, l_linenumber,
        CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS ratio
    FROM lineitem
""")
def ratio_feature(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", fn.ratio("l_tax", "l_discount").alias("ratio"))


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(spark, sf_dir):
    return ops.distinct_rows(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query("""
    SELECT c_custkey, coalesce(n_events, 0) AS n_events, coalesce(best, 0) AS best
    FROM customer LEFT JOIN (
        SELECT user_id, count(*) AS n_events, max(value) AS best FROM events GROUP BY 1)
    ON c_custkey = user_id
""")
def null_substitution(spark, sf_dir):
    per_user = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("best")
    )
    joined = table(spark, sf_dir, "customer").select("c_custkey").join(per_user, "c_custkey", "left")
    return joined.withColumns({name: fn.null_to_zero(name) for name in ("n_events", "best")})


@query("""
    SELECT c_custkey, CASE
        WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment
        WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'HOME'
        ELSE 'OTHER' END AS segment
    FROM customer
""")
def group_categories(spark, sf_dir):
    segment = fn.category_group(
        "c_mktsegment", kept=("BUILDING", "MACHINERY"), members=("FURNITURE", "HOUSEHOLD"), group="HOME"
    )
    return table(spark, sf_dir, "customer").select("c_custkey", segment.alias("segment"))


@query("""
    SELECT CASE WHEN upper(lang) IN ('DE', 'ES', 'FR') THEN 'EUROPE' ELSE 'OTHER' END AS country,
        count(*) AS n
    FROM documents GROUP BY 1
""")
def udf_country_group(spark, sf_dir):
    fn.register_sql_functions(spark)
    code = F.upper("lang")
    return ops.count_per(
        table(spark, sf_dir, "documents"), F.call_function("country_group", code).alias("country")
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END AS label FROM orders
""")
def trial_labels(spark, sf_dir):
    label = fn.flag_above("o_totalprice", 250000, inclusive=True)
    return table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"))


# ---- exam report: orders as results ---------------------------------------------------

RESULTS_SQL = """
    WITH results AS (
        SELECT o_orderkey AS result_id, o_orderpriority AS subject,
            year(o_orderdate)::INTEGER AS year, o_totalprice AS score,
            CASE WHEN o_totalprice >= 400000 THEN 'A1' WHEN o_totalprice >= 300000 THEN 'B1'
                 WHEN o_totalprice >= 200000 THEN 'C1' ELSE 'D1' END AS grade
        FROM orders)
"""
STRICT = "1-URGENT"


def order_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    grade = F.when(price >= 400000, "A1").when(price >= 300000, "B1").when(price >= 200000, "C1").otherwise("D1")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("result_id"), F.col("o_orderpriority").alias("subject"),
        F.year("o_orderdate").alias("year"), price.alias("score"), grade.alias("grade"),
    )


@query(f"{RESULTS_SQL} SELECT * FROM results WHERE subject = '2-HIGH' AND year >= 1998")
def filter_expr(spark, sf_dir):
    return exam_report.matching_expression(order_results(spark, sf_dir), "subject = '2-HIGH' and year >= 1998")


@query(f"{RESULTS_SQL} SELECT * FROM results WHERE subject = '2-HIGH' AND year >= 1998")
def filter_column(spark, sf_dir):
    return exam_report.subject_since(order_results(spark, sf_dir), "2-HIGH", 1998)


@query(f"{RESULTS_SQL} SELECT score, year FROM results WHERE subject = '2-HIGH' AND year >= 1998")
def filter_sql(spark, sf_dir):
    return exam_report.subject_since_sql(order_results(spark, sf_dir), "2-HIGH", 1998)


@query(f"{RESULTS_SQL} SELECT subject, max(score) AS max_score, min(score) AS min_score FROM results GROUP BY 1")
def group_min_max(spark, sf_dir):
    return exam_report.score_range(order_results(spark, sf_dir))


@query("""
    SELECT p_type AS subject, max(p_size::VARCHAR) AS max_score, min(p_size::VARCHAR) AS min_score
    FROM part GROUP BY 1
""")
def group_min_max_text(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    sizes = parts.select(F.col("p_type").alias("subject"), F.col("p_size").alias("score"))
    return exam_report.score_range(sizes, as_text=True)


def _pivot_sql(column: str, values) -> str:
    cells = ", ".join(
        f"""round(avg(score) FILTER ({column} = {value!r}), 2) AS "{value}_average_score",
            round(stddev_samp(score) FILTER ({column} = {value!r}), 2) AS "{value}_standard_deviation_score" """
        for value in values
    )
    return f"SELECT subject, {cells} FROM results GROUP BY 1"


@query(f"{RESULTS_SQL} {_pivot_sql('grade', ('A1', 'B1', 'C1', 'D1'))}")
def pivot_stats(spark, sf_dir):
    return ops.stats_pivot(
        order_results(spark, sf_dir), "subject", "grade", "score", values=("A1", "B1", "C1", "D1")
    )


@query(f"{RESULTS_SQL} {_pivot_sql('year', range(1995, 2002))}")
def pivot_stats_discovered(spark, sf_dir):
    return exam_report.yearly_scores(order_results(spark, sf_dir))


PASS_SQL = f"""
    {RESULTS_SQL}
    SELECT *, CASE WHEN subject = '1-URGENT' THEN grade LIKE 'A%'
        ELSE grade LIKE 'A%' OR grade LIKE 'B%' OR grade LIKE 'C%' END AS pass
    FROM results
"""


@query(PASS_SQL)
def pass_rule(spark, sf_dir):
    return exam_report.with_pass_flag(order_results(spark, sf_dir), strict_subject=STRICT)


@query(PASS_SQL)
def udf_pass_rule(spark, sf_dir):
    return exam_report.with_pass_flag_function(order_results(spark, sf_dir), strict_subject=STRICT)


@query("""
    WITH numbers AS (
        SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_linenumber']) AS name),
    long AS (UNPIVOT (
        SELECT row_number() OVER () AS row_id, l_quantity, l_extendedprice, l_discount, l_tax,
            l_linenumber::DOUBLE AS l_linenumber
        FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber
        INTO NAME name VALUE value)
    SELECT a.name AS column_a, b.name AS column_b, round(corr(a.value, b.value), 9) AS correlation
    FROM long a JOIN long b USING (row_id)
    GROUP BY 1, 2
""")
def correlation_matrix(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    columns = ops.numeric_candidates(lines, drop=["l_orderkey", "l_partkey", "l_suppkey", "gradeVector"])
    matrix = ops.correlation_matrix(lines, columns)
    return matrix.withColumn("correlation", F.round("correlation", 9))


# ---- log report: orders as log rows, conversation turns as log lines ------------------


def order_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("level"), F.col("o_orderdate").alias("datetime")
    )


@query("""
    SELECT level, label, count(*) AS n
    FROM orders JOIN (VALUES ('F', 'filled'), ('O', 'open'), ('P', 'part')) AS labels(level, label)
        ON o_orderstatus = level
    GROUP BY 1, 2
""")
def inline_rows(spark, sf_dir):
    """In-memory rows with an explicit schema, as names of the levels."""
    schema = StructType([
        StructField("level", StringType(), nullable=False), StructField("label", StringType(), nullable=False)
    ])
    labels = inline_lookup(spark, [("F", "filled"), ("O", "open"), ("P", "part")], schema)
    counted = ops.count_per(order_logs(spark, sf_dir), "level")
    return ops.lookup(counted, labels, "level")


@query("SELECT role AS level, count(*) AS n FROM conversations GROUP BY 1")
def level_counts(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return log_report.level_counts(turns.select(F.concat("role", F.lit(": "), "text").alias("value")))


PAGES_SQL = """
    WITH placed AS (
        SELECT o_orderstatus AS level, o_orderdate,
            (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate) - 1) // 1000 AS page
        FROM orders)
    SELECT level, page::BIGINT AS page,
        string_agg(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY o_orderdate) AS datetime_list
    FROM placed GROUP BY 1, 2
"""


def _as_text(pages: DataFrame) -> DataFrame:
    texts = F.transform("datetime_list", lambda time: F.date_format(time, "yyyy-MM-dd HH:mm:ss"))
    return pages.withColumn("datetime_list", F.array_join(texts, ","))


@query(PAGES_SQL)
def collect_per_level(spark, sf_dir):
    return _as_text(log_report.times_per_level(order_logs(spark, sf_dir), page_size=1000))


@query(PAGES_SQL)
def collect_per_level_sql(spark, sf_dir):
    return _as_text(log_report.times_per_level_sql(order_logs(spark, sf_dir), page_size=1000))


MONTHS_SQL = """
    SELECT o_orderstatus AS level, monthname(o_orderdate) AS month, count(*) AS total
    FROM orders GROUP BY 1, 2
"""


@query(MONTHS_SQL)
def log_month_df(spark, sf_dir):
    return log_report.month_report(order_logs(spark, sf_dir))


@query(MONTHS_SQL)
def log_month_sql(spark, sf_dir):
    return log_report.month_report_sql(order_logs(spark, sf_dir))


@query("""
    SELECT year(o_orderdate)::INTEGER AS year, o_orderstatus AS level,
        monthname(o_orderdate) AS month, count(*) AS total
    FROM orders GROUP BY 1, 2, 3
""")
def log_month_by_year(spark, sf_dir):
    return log_report.month_report(order_logs(spark, sf_dir), by_year=True)


@query("SELECT count(*) AS total FROM orders")
def grand_total(spark, sf_dir):
    return log_report.total_of(log_report.month_report_sql(order_logs(spark, sf_dir)))


@query(
    "SELECT o_orderstatus AS level, "
    + ", ".join(f"count(*) FILTER (month(o_orderdate) = {i}) AS {name}" for i, name in enumerate(fixed.MONTH_NAMES, 1))
    + " FROM orders GROUP BY 1"
)
def level_month_pivot(spark, sf_dir):
    return log_report.month_pivot(order_logs(spark, sf_dir))


@query("""
    SELECT monthname(o_orderdate) AS month, month(o_orderdate)::INTEGER AS number, count(*) AS total
    FROM orders GROUP BY 1, 2
""")
def month_number(spark, sf_dir):
    months = order_logs(spark, sf_dir).select(fn.month_name("datetime").alias("month"))
    counted = ops.count_per(months, "month", "total")
    return counted.withColumn("number", fn.month_number_of_name("month"))


@query(MONTHS_SQL)
def udf_month_order(spark, sf_dir):
    fn.register_sql_functions(spark)
    register_view(order_logs(spark, sf_dir), "order_log_view")
    return spark.sql("""
        SELECT level, month, total
        FROM (
            SELECT *, month_num(month) AS place
            FROM (
                SELECT level, date_format(datetime, 'MMMM') AS month, count(*) AS total
                FROM order_log_view
                GROUP BY ALL))
        ORDER BY place, level
    """)


# ---- words of the documents -----------------------------------------------------------

STOP_WORDS = ("a", "and", "are", "as", "at", "by", "for", "in", "is", "it", "of", "on", "that", "the", "to", "with")

WORDS_SQL = r"""
    WITH words AS (
        SELECT unnest(string_split_regex(
            regexp_replace(lower(text), '[^a-zA-Z \r\n]', '', 'g'), '[ \r\n]+')) AS word
        FROM documents),
    counted AS (SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1)
"""


@query(f"{WORDS_SQL} SELECT word, n FROM counted")
def word_counts(spark, sf_dir):
    return ops.word_counts(table(spark, sf_dir, "documents"), "text")


@query(WORDS_SQL + r""",
    unwanted AS (
        SELECT unnest(string_split_regex(
            regexp_replace(lower(text), '[^a-zA-Z \r\n]', '', 'g'), '[ \r\n]+')) AS word
        FROM benchmark)
    SELECT word, n FROM counted WHERE word NOT IN (SELECT word FROM unwanted)
""")
def stopword_anti_join(spark, sf_dir):
    unwanted = ops.word_counts(table(spark, sf_dir, "benchmark"), "text")
    return word_report.interesting_words(table(spark, sf_dir, "documents"), unwanted, "text")


@query(f"""
    {WORDS_SQL}
    SELECT word, n FROM counted WHERE word NOT IN {STOP_WORDS!r}
    ORDER BY n DESC, word LIMIT 10
""")
def top_words(spark, sf_dir):
    stop_words = word_report.stop_word_list(spark, STOP_WORDS)
    return word_report.top_words(table(spark, sf_dir, "documents"), stop_words, "text")

"""Course scores on the order tables.

A view is an ordered line: the customer views the nation of the line's supplier. Nations
are chapters, regions are courses. Customer 0 plays the id that means "nobody".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.checks.registry import query, table
from tablecraft.plans import course_scores as scores

NOBODY = 0

VIEWS_SQL = """
    views AS (
        SELECT DISTINCT o_custkey AS user_id, s_nationkey AS chapter_id
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey
        WHERE o_custkey <> 0),
    sizes AS (
        SELECT n_regionkey AS course_id, count(*) AS chapters FROM nation GROUP BY 1),
    progress AS (
        SELECT n_regionkey AS course_id, user_id, count(*) AS viewed
        FROM views JOIN nation ON chapter_id = n_nationkey GROUP BY 1, 2),
    scored AS (
        SELECT course_id, user_id, viewed, chapters,
            CASE WHEN viewed::DOUBLE / chapters > 0.9 THEN 10
                 WHEN viewed::DOUBLE / chapters > 0.5 THEN 4
                 WHEN viewed::DOUBLE / chapters > 0.25 THEN 2
                 ELSE 0 END AS score
        FROM progress JOIN sizes USING (course_id))
"""


def order_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(orders, lines.l_orderkey == orders.o_orderkey)
        .select(F.col("o_custkey").alias("user_id"), F.col("s_nationkey").alias("chapter_id"))
    )


def nation_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return nations.select(F.col("n_nationkey").alias("chapter_id"), F.col("n_regionkey").alias("course_id"))


def region_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region")
    return regions.select(F.col("r_regionkey").alias("course_id"), F.col("r_name").alias("title"))


@query(f"""
    WITH {VIEWS_SQL}
    SELECT sum(score)::BIGINT AS total, r_name AS title
    FROM scored JOIN region ON course_id = r_regionkey
    GROUP BY r_name
""")
def course_scores(spark, sf_dir):
    return scores.course_scores(
        order_views(spark, sf_dir), nation_chapters(spark, sf_dir), region_titles(spark, sf_dir),
        sentinel_user=NOBODY,
    )


@query(f"""
    WITH {VIEWS_SQL}
    SELECT course_id, user_id, viewed, chapters FROM scored
""")
def user_progress(spark, sf_dir):
    return scores.user_progress(
        order_views(spark, sf_dir), nation_chapters(spark, sf_dir), sentinel_user=NOBODY
    )


@query(f"""
    WITH {VIEWS_SQL}
    SELECT course_id, user_id, viewed, chapters, score FROM scored
""")
def completion_bands(spark, sf_dir):
    return scores.scored_progress(user_progress(spark, sf_dir))


@query("SELECT n_regionkey AS course_id, count(*) AS chapters FROM nation GROUP BY 1")
def course_sizes(spark, sf_dir):
    return scores.course_sizes(nation_chapters(spark, sf_dir))


CUSTOMER_VIEWS_SQL = """
    WITH views AS (
        SELECT DISTINCT hour(ts)::INTEGER AS user_id, user_id AS chapter_id FROM events),
    chapters AS (
        SELECT c_custkey AS chapter_id, c_nationkey AS course_id FROM customer)
"""


def customer_chapters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events by hour as views of customers: most customers have no event."""
    events = table(spark, sf_dir, "events")
    views = events.select(F.hour("ts").alias("user_id"), F.col("user_id").alias("chapter_id"))
    customers = table(spark, sf_dir, "customer")
    chapters = customers.select(F.col("c_custkey").alias("chapter_id"), F.col("c_nationkey").alias("course_id"))
    return views, chapters


@query(f"""
    {CUSTOMER_VIEWS_SQL}
    SELECT chapter_id, course_id, user_id FROM chapters FULL OUTER JOIN views USING (chapter_id)
""")
def chapter_views_full(spark, sf_dir):
    return scores.chapter_views(*customer_chapters(spark, sf_dir))


@query(f"""
    {CUSTOMER_VIEWS_SQL}
    SELECT chapter_id, course_id, coalesce(user_id, 0) AS user_id
    FROM chapters FULL OUTER JOIN views USING (chapter_id)
""")
def chapter_views_sentinel(spark, sf_dir):
    return scores.chapter_views(*customer_chapters(spark, sf_dir), sentinel_user=NOBODY)

"""Course scores: how far viewers get through the chapters of each course."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.functions import completion_score
from tablecraft.operators import lookup


def viewed_pairs(views: DataFrame, sentinel_user: int | None = None) -> DataFrame:
    """Each viewer and chapter once. ``sentinel_user`` is an id that means "nobody"."""
    pairs = views.select("user_id", "chapter_id").filter(F.col("user_id").isNotNull())
    if sentinel_user is not None:
        pairs = pairs.filter(F.col("user_id") != sentinel_user)
    return pairs.distinct()


def _placed(pairs: DataFrame, chapters: DataFrame, on_unknown: str, salts: int | None) -> DataFrame:
    """Pairs beside their chapter's columns.

    A chapter that is not listed fails the job or drops its views. The check is a filter, so
    it holds whatever is selected later; a listed chapter may have a null course. The course
    depends on it too: else a later inner join on the course would remove unknown chapters
    before they are seen.
    """
    if on_unknown == "drop":
        return lookup(pairs, chapters, "chapter_id", "inner", salts)
    if on_unknown != "error":
        raise ValueError(f"on_unknown must be 'error' or 'drop', not {on_unknown!r}")
    chapter = F.coalesce(F.col("chapter_id").cast("string"), F.lit("null"))
    message = F.concat(F.lit("view of an unknown chapter: "), chapter)
    placed = lookup(pairs, chapters.withColumn("_known", F.lit(True)), "chapter_id", "left", salts)
    known = F.coalesce("_known", F.raise_error(message).cast("boolean"))
    return placed.filter(known).withColumn("course_id", F.when(known, F.col("course_id"))).drop("_known")


def course_sizes(chapters: DataFrame) -> DataFrame:
    return chapters.groupBy("course_id").agg(F.count(F.lit(1)).alias("chapters"))


def chapter_views(
    views: DataFrame,
    chapters: DataFrame,
    on_unknown: str = "error",
    sentinel_user: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Every chapter with every viewer it has, or with a null viewer if it has none.

    This is the full outer join of chapters and views, written as the two joins it
    consists of, so that a chapter with most of the views can be broadcast or split.
    With ``sentinel_user`` that id stands for the missing viewer.
    """
    pairs = views.select("user_id", "chapter_id").distinct()
    viewed = _placed(pairs, chapters, on_unknown, salts).select("chapter_id", "course_id", "user_id")
    seen = pairs.select("chapter_id").distinct()
    unviewed = chapters.join(seen, "chapter_id", "left_anti").select(
        "chapter_id", "course_id", F.lit(None).cast(views.schema["user_id"].dataType).alias("user_id")
    )
    result = viewed.unionByName(unviewed)
    if sentinel_user is None:
        return result
    return result.withColumn("user_id", F.coalesce("user_id", F.lit(sentinel_user)))


def user_progress(
    views: DataFrame,
    chapters: DataFrame,
    on_unknown: str = "error",
    sentinel_user: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Distinct chapters seen per course and viewer, beside the size of the course.

    The course size is put on the chapter list first, so the views meet one lookup only.
    """
    sizes = course_sizes(chapters).withColumnRenamed("course_id", "_course")
    same = F.col("course_id").eqNullSafe(F.col("_course"))
    sized = chapters.join(sizes, same).drop("_course")
    placed = _placed(viewed_pairs(views, sentinel_user), sized, on_unknown, salts)
    return placed.groupBy("course_id", "user_id").agg(
        F.count(F.lit(1)).alias("viewed"), F.max("chapters").alias("chapters")
    )


def scored_progress(progress: DataFrame) -> DataFrame:
    return progress.withColumn("score", completion_score("viewed", "chapters"))


def course_scores(
    views: DataFrame,
    chapters: DataFrame,
    titles: DataFrame,
    on_unknown: str = "error",
    sentinel_user: int | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Total score per titled course, best first.

    A course nobody viewed, or without a title, does not appear; viewers who score 0
    keep their course in the report.
    """
    progress = user_progress(views, chapters, on_unknown, sentinel_user, salts)
    totals = scored_progress(progress).groupBy("course_id").agg(F.sum("score").alias("total"))
    return totals.join(titles, "course_id").select("total", "title").orderBy(F.desc("total"), "title")

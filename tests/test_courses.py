from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows
from pyspark.errors import PySparkException

from tablecraft.plans import course_scores as cs

VIEWS = "user_id int, chapter_id int"
CHAPTERS = "chapter_id int, course_id int"
TITLES = "course_id int, title string"


def frames(spark, views, chapters, titles):
    return (
        spark.createDataFrame(views, VIEWS), spark.createDataFrame(chapters, CHAPTERS),
        spark.createDataFrame(titles, TITLES),
    )


def small(spark):
    # course 1 has 20 chapters, course 2 nobody views, course 3 has no title, course 4 is barely seen
    chapters = [(c, 1) for c in range(20)] + [(20, 2), (21, 3)] + [(30 + i, 4) for i in range(4)]
    views = [(u, c) for u, n in ((1, 5), (2, 10), (3, 18), (4, 20)) for c in range(n)]
    views += [(4, 0), (4, 0), (0, 1), (5, 21), (5, 30), (None, 2)]
    return frames(spark, views, chapters, [(1, "One "), (2, "Two"), (4, "Four")])


def test_scores_on_band_bounds(spark):
    views, chapters, titles = small(spark)
    got = [tuple(r) for r in cs.course_scores(views, chapters, titles, sentinel_user=0).collect()]
    assert got == [(0 + 2 + 4 + 10, "One "), (0, "Four")]


def test_user_zero_counts_unless_it_means_nobody(spark):
    views, chapters, _ = small(spark)
    with_zero = {r[1] for r in rows(cs.user_progress(views, chapters))}
    without = {r[1] for r in rows(cs.user_progress(views, chapters, sentinel_user=0))}
    assert with_zero - without == {0} and None not in with_zero


@pytest.mark.parametrize("on_unknown", ["error", "drop"])
def test_unknown_chapter(spark, on_unknown):
    views, chapters, titles = frames(spark, [(1, 0), (1, 99)], [(0, 1)], [(1, "One")])
    result = cs.course_scores(views, chapters, titles, on_unknown=on_unknown)
    if on_unknown == "error":
        with pytest.raises(PySparkException, match="unknown chapter: 99"):
            result.collect()
    else:
        assert [tuple(r) for r in result.collect()] == [(10, "One")]
    with pytest.raises(ValueError):
        cs.course_scores(views, chapters, titles, on_unknown="ignore")


def test_chapter_views_is_the_full_join(spark):
    views, chapters, _ = frames(spark, [(1, 0), (1, 0), (2, 0), (1, 1)], [(0, 1), (1, 1), (2, 2)], [])
    assert rows(cs.chapter_views(views, chapters)) == [(0, 1, 1), (0, 1, 2), (1, 1, 1), (2, 2, None)]
    assert rows(cs.chapter_views(views, chapters, sentinel_user=0))[-1] == (2, 2, 0)


def _scores_by_hand(views, chapters, titles):
    course = dict(chapters)
    totals = {}
    for c in set(course.values()):
        size = sum(1 for _, k in chapters if k == c)
        for u in {u for u, _ in views}:
            seen = len({ch for v, ch in views if v == u and course[ch] == c})
            if seen:
                share = seen / size
                band = 10 if share > 0.9 else 4 if share > 0.5 else 2 if share > 0.25 else 0
                totals[c] = totals.get(c, 0) + band
    return sorted((total, title) for c, title in titles for total in [totals.get(c)] if total is not None)


@pytest.mark.parametrize("salts", [None, 5])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_hot_chapter_against_brute_force(spark, set_conf, salts, threshold):
    """A third of all views fall on one chapter; results do not depend on how the join runs."""
    set_conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    source = random.Random(1)
    chapters = [(c, c % 7) for c in range(60)]
    views = [(source.randrange(200), 3 if source.random() < 0.34 else source.randrange(60)) for _ in range(6000)]
    titles = [(c, f"course {c}") for c in range(7)]
    got = cs.course_scores(*frames(spark, views, chapters, titles), salts=salts)
    assert sorted(tuple(r) for r in got.collect()) == _scores_by_hand(views, chapters, titles)
    if threshold == "-1":
        assert "BroadcastHashJoin" not in plan_of(got)


def test_oversized_partition_is_split(spark, set_conf):
    """Without a broadcast, adaptive execution divides the partition of a hot chapter."""
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    views = spark.range(60000).selectExpr("int(id) AS user_id", "int(if(id % 3 = 0, 7, id % 400)) AS chapter_id")
    chapters = spark.range(400).selectExpr("int(id) AS chapter_id", "int(id % 9) AS course_id")
    result = cs.user_progress(views, chapters)
    result.collect()
    assert "skew=true" in plan_of(result)


def test_salts_put_a_hot_key_in_many_tasks(spark, set_conf):
    from tablecraft.operators import exclude, lookup
    from tablecraft.operators.joins import SALT

    facts = spark.createDataFrame([(i, 7) for i in range(1000)] + [(1, None)], VIEWS)
    dimension = spark.createDataFrame([(7, 1)], CHAPTERS)
    assert lookup(facts, dimension, "chapter_id", "left", salts=8).count() == 1001
    assert SALT not in lookup(facts, dimension, "chapter_id", "left", salts=8).columns
    assert rows(exclude(facts, dimension, "chapter_id", salts=8)) == [(None, 1)]
    with pytest.raises(ValueError):
        lookup(facts, dimension, "chapter_id", "full")


def test_unknown_chapter_fails_under_any_action(spark):
    views = spark.createDataFrame([(1, 10), (1, 99)], "user_id int, chapter_id int")
    chapters = spark.createDataFrame([(10, 1), (11, None)], "chapter_id int, course_id int")
    seen = cs.chapter_views(views, chapters)
    for act in (seen.count, seen.select("user_id").collect):
        with pytest.raises(PySparkException, match="unknown chapter: 99"):
            act()


def test_listed_chapter_without_course_is_not_unknown(spark):
    views = spark.createDataFrame([(1, 11)], "user_id int, chapter_id int")
    chapters = spark.createDataFrame([(10, 1), (11, None)], "chapter_id int, course_id int")
    assert rows(cs.chapter_views(views, chapters)) == rows(
        spark.createDataFrame([(10, 1, None), (11, None, 1)], "chapter_id int, course_id int, user_id int")
    )

"""Log report, exam report, word report, pages, correlation, ranking."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from conftest import plan_of, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablecraft import operators as ops
from tablecraft.operators import pages as pages_module
from tablecraft.plans import exam_report, log_report
from tablecraft.plans import words as word_report

LOGS = "level string, datetime string"


@pytest.fixture
def logs(spark):
    return spark.createDataFrame(
        [
            ("NOTICE", "2031-05-03 08:15:00"), ("NOTICE", "2029-05-28 23:59:59"), ("NOTICE", "2031-11-09 01:30:00"),
            ("ALERT", "2031-05-04 04:45:00"), ("TRACE", None), (None, "2030-02-11 10:10:10"),
        ],
        LOGS,
    )


# ---- logs -----------------------------------------------------------------------------


def test_month_report_merges_years_and_follows_the_calendar(logs):
    expected = [
        ("TRACE", None, 1), (None, "February", 1), ("ALERT", "May", 1), ("NOTICE", "May", 2), ("NOTICE", "November", 1),
    ]
    assert [tuple(r) for r in log_report.month_report(logs).collect()] == expected
    assert [tuple(r) for r in log_report.month_report_sql(logs).collect()] == expected
    per_year = [tuple(r) for r in log_report.month_report(logs, by_year=True).collect()]
    assert (2029, "NOTICE", "May", 1) in per_year and (2031, "NOTICE", "May", 1) in per_year
    assert rows(log_report.total_of(log_report.month_report(logs))) == [(6,)]
    assert rows(ops.grand_total(log_report.month_report(logs))) == [(6,)]


def test_month_pivot_has_all_months(logs):
    pivot = {r["level"]: r for r in log_report.month_pivot(logs).collect()}
    assert pivot["NOTICE"]["May"] == 2 and pivot["NOTICE"]["June"] == 0
    assert sum(pivot["TRACE"][1:]) == 0 and pivot[None]["February"] == 1
    assert len(pivot["NOTICE"]) == 13


def test_level_counts(spark):
    lines = spark.createDataFrame([("WARN: a",), ("ERROR: b: c",), ("WARN: d",)], "value string")
    assert rows(log_report.level_counts(lines)) == [("ERROR", 1), ("WARN", 2)]


def test_times_per_level(logs):
    got = [tuple(r) for r in log_report.times_per_level(logs).collect()]
    assert got == [
        (None, 0, ["2030-02-11 10:10:10"]), ("ALERT", 0, ["2031-05-04 04:45:00"]),
        ("NOTICE", 0, ["2029-05-28 23:59:59", "2031-05-03 08:15:00", "2031-11-09 01:30:00"]),
    ]
    assert got == [tuple(r) for r in log_report.times_per_level_sql(logs).collect()]


@pytest.mark.parametrize("page_size", [1, 7, 64, 10_000])
def test_pages_end_to_end_are_the_sorted_group(spark, page_size):
    """A third of the rows are one value of one group."""
    source = random.Random(page_size)
    data = [("hot", 5) if source.random() < 0.34 else (source.choice(["hot", "b", None]), source.randrange(100)) for _ in range(900)]
    frame = spark.createDataFrame(data, "k string, v int")
    pages = ops.collect_pages(frame, ["k"], "v", F.floor(F.col("v") / 10), page_size).collect()
    assert all(0 < len(p["values"]) <= page_size for p in pages)
    for key in ("hot", "b", None):
        mine = sorted((p for p in pages if p["k"] == key), key=lambda p: p["page"])
        assert [p["page"] for p in mine] == list(range(len(mine)))
        assert all(len(p["values"]) == page_size for p in mine[:-1])
        assert [v for p in mine for v in p["values"]] == sorted(v for k, v in data if k == key)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double", "string"])
def test_one_hot_bucket_is_divided(spark, kind):
    """One level and one day, times of parts of seconds; no part orders more than its share."""
    source = random.Random(1)
    moments = [source.randrange(10**9) for _ in range(20_000)]
    cast = {"timestamp": "timestamp_micros(m)", "timestamp_ntz": "timestamp_micros(m)::timestamp_ntz", "date": "date_from_unix_date(m::int % 9000)", "double": "m / 7.0", "string": "lpad(m::string, 12, '0')"}[kind]
    frame = spark.createDataFrame([(m,) for m in moments], "m long").selectExpr("'only' AS k", f"{cast} AS v")
    pages = ops.collect_pages(frame, ["k"], "v", F.lit(1), 700).orderBy("page").collect()
    assert [v for p in pages for v in p["values"]] == sorted(r["v"] for r in frame.select("v").collect())
    assert [len(p["values"]) for p in pages] == [700] * 28 + [400]
    runs = frame.groupBy("k", F.lit(1).alias("_bucket"), "v").agg(F.count(F.lit(1)).alias("_n"))
    parts = [r["count"] for r in pages_module._divided(runs, ["k"], "v").groupBy("_part").count().collect()]
    if kind != "string":
        assert len(parts) == 64 and max(parts) <= 2 * sum(parts) / 64


def test_pages_count_the_table_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    pages = ops.collect_pages(orders, ["o_orderstatus"], "o_orderdate", F.to_date("o_orderdate"))
    pages.collect()
    assert "ReusedExchange" in plan_of(pages)


# ---- exams ----------------------------------------------------------------------------

RESULTS = [
    ("Geology", "2031", "9", "A1"), ("Geology", "2033", "10", "B"), ("Geology", "2036", "70", None),
    ("Biology", "2033", "55", "B"), (None, "2033", "1", "A"), ("Dance", None, "3", "D"),
]


@pytest.fixture
def results(spark):
    return spark.createDataFrame(RESULTS, "subject string, year string, score string, grade string")


def test_four_filters_agree(results):
    typed = exam_report.typed_results(results)
    expected = [("Geology", 2033, 10.0, "B"), ("Geology", 2036, 70.0, None)]
    condition = "year > 2032 AND startswith(subject, 'Geo')"
    assert rows(exam_report.matching_expression(typed, condition)) == expected
    assert rows(exam_report.matching_expression(results, condition)) == [
        ("Geology", "2033", "10", "B"), ("Geology", "2036", "70", None)
    ]
    assert rows(exam_report.subject_since(typed, "Geology", 2033)) == expected
    assert rows(exam_report.subject_since_sql(typed, "Geology", 2033)) == [(10.0, 2033), (70.0, 2036)]


def test_text_scores_compare_by_character(results):
    typed = exam_report.typed_results(results)
    assert ("Geology", 70.0, 9.0) in rows(exam_report.score_range(typed))
    assert ("Geology", "9", "10") in rows(exam_report.score_range(results, as_text=True))


def test_junk_year(spark):
    frame = spark.createDataFrame([("Dance", "20x7", "1", "A")], "subject string, year string, score string, grade string")
    with pytest.raises(PySparkException):
        exam_report.typed_results(frame).collect()
    assert rows(exam_report.typed_results(frame, junk="null")) == [("Dance", None, 1.0, "A")]
    with pytest.raises(ValueError):
        exam_report.typed_results(frame, junk="skip")


def test_yearly_scores_discovered_and_listed(results):
    listed = exam_report.yearly_scores(results, ["2031", "2033"])
    assert listed.columns == [
        "subject", "2031_average_score", "2031_standard_deviation_score",
        "2033_average_score", "2033_standard_deviation_score",
    ]
    row = {r["subject"]: r for r in listed.collect()}["Geology"]
    assert tuple(row)[1:] == (9.0, None, 10.0, None)
    found = exam_report.yearly_scores(results)
    assert "2036_average_score" in found.columns


def test_pass_flag_twins(results):
    assert rows(exam_report.with_pass_flag(results)) == rows(exam_report.with_pass_flag_function(results))
    flags = {(r["subject"], r["grade"]): r["pass"] for r in exam_report.with_pass_flag(results).collect()}
    assert flags[("Biology", "B")] is False and flags[("Geology", "B")] is True
    assert flags[("Geology", None)] is None and flags[(None, "A")] is None


# ---- words ----------------------------------------------------------------------------


def test_top_words_breaks_ties_by_word(spark):
    texts = spark.createDataFrame([("b a the c",), ("The a b!\nthe zoo",), (None,)], "value string")
    stop = word_report.stop_word_list(spark, ["the", "zoo"])
    assert [tuple(r) for r in word_report.top_words(texts, stop, n=2).collect()] == [("a", 2), ("b", 2)]
    assert rows(word_report.interesting_words(texts, stop)) == [("a", 2), ("b", 2), ("c", 1)]


def test_stop_words_are_matched_as_they_are(spark):
    texts = spark.createDataFrame([("the",)], "value string")
    assert rows(word_report.interesting_words(texts, word_report.stop_word_list(spark, ["The"]))) == [("the", 1)]


def test_long_stop_list_is_joined_by_word(spark, set_conf, monkeypatch):
    """Without a broadcast the counted words meet the stop words on the exchange they have."""
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr("tablecraft.sources.inline.BROADCAST_ROWS", 1)
    texts = spark.createDataFrame([("a b c",), ("a",)], "value string")
    result = word_report.interesting_words(texts, word_report.stop_word_list(spark, ["b", "x"]))
    plan = plan_of(result)
    assert "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert rows(result) == [("a", 2), ("c", 1)]


# ---- correlation and ranking ----------------------------------------------------------


def test_correlations_match_numpy(spark):
    source = np.random.default_rng(0)
    data = source.normal(size=(200, 3))
    data[:, 2] += data[:, 0]
    frame = spark.createDataFrame([(i, "t", *map(float, r)) for i, r in enumerate(data)], "id int, s string, a double, b double, c double")
    columns = ops.numeric_candidates(frame, drop=["id", "missing"])
    assert columns == ["a", "b", "c"]
    got = {(r[0], r[1]): r[2] for r in ops.correlation_matrix(frame, columns).collect()}
    expected = np.corrcoef(data.T)
    assert len(got) == 9
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            assert got[a, b] == pytest.approx(expected[i, j], abs=1e-12)


@pytest.mark.parametrize("width", [1, 2, 7, 50])
def test_any_number_of_columns_is_read_once(spark, tmp_path, width):
    source = np.random.default_rng(width)
    data = source.normal(size=(120, width)) + source.normal(size=(120, 1))
    names = [f"c.{i}" if i == 1 else f"c{i}" for i in range(width)]
    spark.createDataFrame([tuple(map(float, r)) for r in data], ", ".join(f"`{n}` double" for n in names)).write.parquet(str(tmp_path / "t"))
    matrix = ops.correlation_matrix(spark.read.parquet(str(tmp_path / "t")))
    got = {(r[0], r[1]): r[2] for r in matrix.collect()}
    plan = plan_of(matrix)
    assert plan.split("Initial Plan")[0].count("FileScan") == 1
    expected = np.corrcoef(data.T).reshape(width, width)
    assert len(got) == width**2
    assert all(got[a, b] == pytest.approx(expected[i, j], abs=1e-12) for i, a in enumerate(names) for j, b in enumerate(names))
    assert ops.correlation_matrix(spark.createDataFrame([("x",)], "s string")).collect() == []


def test_correlation_of_constants_and_nulls(spark):
    data = [(1.0, 5.0, 1.0, 2.0), (2.0, 5.0, 3.0, None), (4.0, 5.0, None, 1.0), (3.0, 5.0, 2.0, 0.0)]
    frame = spark.createDataFrame(data, "a double, k double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in ops.correlation_matrix(frame).collect()}
    assert got["a", "k"] is got["k", "a"] is got["k", "k"] is None
    assert got["a", "b"] == pytest.approx(np.corrcoef([1, 2, 3], [1, 3, 2])[0, 1])
    assert got["c", "a"] == pytest.approx(np.corrcoef([1, 4, 3], [2, 1, 0])[0, 1])
    assert got["b", "c"] == pytest.approx(-1)


def test_top_rows_per_group(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", 2)], "k string, v int")
    assert rows(ops.top_rows_per(frame, ["k"], [F.desc("v")], 2)) == [("a", 3, 1), ("a", 3, 2), ("b", 2, 1)]


def test_aggregates(spark):
    frame = spark.createDataFrame([(11,), (12,), (12,)], "value bigint")
    assert rows(ops.global_sum(frame, "value")) == [(35,)]
    assert rows(ops.global_count(frame)) == [(3,)]
    assert rows(ops.distinct_rows(frame, ["value"])) == [(11,), (12,)]
    assert Counter(dict(rows(ops.count_per(frame, "value")))) == {11: 1, 12: 2}

from __future__ import annotations

import datetime

import pandas as pd
import pytest
from conftest import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablecraft import fixed_values as fixed
from tablecraft import functions as fn


def one(spark, value, type_name, expression):
    return spark.createDataFrame([(value,)], f"v {type_name}").select(expression).first()[0]


@pytest.mark.parametrize("viewed, score", [(5, 0), (6, 2), (10, 2), (11, 4), (18, 4), (19, 10), (20, 10), (0, 0)])
def test_band_bounds_are_exclusive(spark, viewed, score):
    assert one(spark, viewed, "int", fn.completion_score("v", F.lit(20))) == score


def test_ratio_of_zero_is_null(spark):
    frame = spark.createDataFrame([(1, 2), (1, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in frame.select(fn.ratio("a", "b")).collect()] == [0.5, None, None]


def test_flag_above(spark):
    frame = spark.createDataFrame([(None,), (0,), (1,), (2,)], "v int")
    assert [r[0] for r in frame.select(fn.flag_above("v", 1)).collect()] == [0, 0, 0, 1]
    assert [r[0] for r in frame.select(fn.flag_above("v", 1, inclusive=True)).collect()] == [0, 0, 1, 1]


@pytest.mark.parametrize("line, level", [("WARN: a: b", "WARN"), ("no mark", "no mark"), (":x", ""), (None, None)])
def test_prefix(spark, line, level):
    assert one(spark, line, "string", fn.prefix_before("v", ":")) == level


@pytest.mark.parametrize("text, words", [
    ("Don't  stop\tnow\r\nété 123", ["dont", "stopnow", "t"]),
    ("A\rb\nC", ["a", "b", "c"]),
    ("", []), (" \n ", []),
])
def test_words(spark, text, words):
    assert [w for w in one(spark, text, "string", fn.words_of("v")) if w] == words


def _words_by_definition(text: str) -> list[str]:
    """Word by word, as the rule says: split, lower, strip what is not a letter, drop blanks."""
    pieces = text.replace("\r\n", " ").replace("\r", " ").replace("\n", " ").split(" ")
    letters = ["".join(c for c in piece.lower() if "a" <= c <= "z" or "A" <= c <= "Z") for piece in pieces]
    return [word for word in letters if word]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aZé9 \t\r\n'ß-.", max_size=30), min_size=1, max_size=20))
def test_words_of_any_text(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = {r[0]: [w for w in r[1] if w] for r in frame.select("i", fn.words_of("v")).collect()}
    assert got == {i: _words_by_definition(text) for i, text in enumerate(texts)}


def test_months(spark):
    frame = spark.createDataFrame([(datetime.datetime(2022, m, 1),) for m in range(1, 13)], "v timestamp")
    got = frame.select(fn.month_name("v"), fn.month_number("v"), fn.month_number_of_name(fn.month_name("v"))).collect()
    assert [tuple(r) for r in got] == [(name, i, i) for i, name in enumerate(fixed.MONTH_NAMES, 1)]
    assert one(spark, "Nonember", "string", fn.month_number_of_name("v")) is None
    assert one(spark, None, "string", fn.month_number_of_name("v")) is None


GRADES = [
    ("A1", "Biology", True), ("B1", "Biology", False), ("A", "Art", True), ("B2", "Art", True), ("C", "Art", True),
    ("D", "Art", False), ("", "Art", False), (None, "Art", None), ("A", None, None),
]


def test_pass_rule_as_column_and_as_sql_function(spark):
    fn.register_sql_functions(spark)
    frame = spark.createDataFrame(GRADES, "grade string, subject string, expected boolean")
    result = frame.select(
        "expected", fn.has_passed("grade", "subject"), F.expr("has_passed(grade, subject)"),
        F.call_function("has_passed", "grade", "subject"),
    )
    assert all(a == b == c == d for a, b, c, d in (tuple(r) for r in result.collect()))
    assert "Python" not in plan_of(result)


@pytest.mark.parametrize("country, group", [
    ("GB", "GB"), ("UNKNOWN", "UNKNOWN"), ("FR", "EUROPE"), ("EU", "EUROPE"), ("BR", "OTHER"), (None, "OTHER"),
])
def test_country_groups_as_column_and_as_sql_function(spark, country, group):
    fn.register_sql_functions(spark)
    assert one(spark, country, "string", fn.category_group("v")) == group
    assert one(spark, country, "string", F.expr("country_group(v)")) == group


def test_pandas_function_agrees_with_the_column_form(spark):
    kept, europe = set(fixed.KEPT_COUNTRIES), set(fixed.EUROPEAN_COUNTRIES)

    @F.pandas_udf("string")
    def grouped(values: pd.Series) -> pd.Series:
        return values.map(lambda c: c if c in kept else "EUROPE" if c in europe else "OTHER")

    frame = spark.createDataFrame([(c,) for c in ("GB", "FR", "BR", "UNKNOWN", "EL")], "v string")
    assert all(a == b for a, b in frame.select(fn.category_group("v"), grouped("v")).collect())


def test_month_function_orders_by_calendar(spark):
    fn.register_sql_functions(spark)
    frame = spark.createDataFrame([("March",), ("January",), ("December",)], "month string")
    ordered = frame.withColumn("n", F.expr("month_num(month)")).orderBy("n")
    assert [tuple(r) for r in ordered.collect()] == [("January", 1), ("March", 3), ("December", 12)]


def test_null_to_zero(spark):
    frame = spark.createDataFrame([(None,), (3,)], "v int")
    assert rows(frame.select(fn.null_to_zero("v"))) == [(0,), (3,)]

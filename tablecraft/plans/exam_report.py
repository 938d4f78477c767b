"""Exam report: filters, extremes, pivot and the pass flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.functions import has_passed, register_sql_functions
from tablecraft.operators import extremes_per, stats_pivot


def typed_results(df: DataFrame, junk: str = "error") -> DataFrame:
    """Text columns ``year`` and ``score`` as numbers; ``junk='null'`` tolerates bad text."""
    if junk not in ("error", "null"):
        raise ValueError(f"junk must be 'error' or 'null', not {junk!r}")

    def typed(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if junk == "error" else F.col(name).try_cast(kind)

    return df.withColumns({"year": typed("year", "int"), "score": typed("score", "double")})


def matching_expression(df: DataFrame, condition: str) -> DataFrame:
    """Rows that satisfy an SQL condition; a null condition drops the row."""
    return df.filter(condition)


def subject_since(df: DataFrame, subject: str, year: int) -> DataFrame:
    """Rows of one subject from a year on, as Column expressions."""
    return df.filter((F.col("subject") == subject) & (F.col("year") >= year))


def subject_since_sql(df: DataFrame, subject: str, year: int) -> DataFrame:
    """The same through SQL: columns ``score`` and ``year``."""
    return df.sparkSession.sql(
        "SELECT score, year FROM {results} WHERE subject = :subject AND year >= :year",
        args={"subject": subject, "year": year},
        results=df,
    )


def score_range(df: DataFrame, as_text: bool = False) -> DataFrame:
    return extremes_per(df, "subject", "score", as_text=as_text)


def yearly_scores(df: DataFrame, years: Sequence | None = None) -> DataFrame:
    return stats_pivot(df, "subject", "year", "score", years)


def with_pass_flag(df: DataFrame, **rule) -> DataFrame:
    return df.withColumn("pass", has_passed("grade", "subject", **rule))


def with_pass_flag_function(df: DataFrame, **rule) -> DataFrame:
    """The same flag through the named SQL function."""
    register_sql_functions(df.sparkSession, **rule)
    return df.withColumn("pass", F.call_function("has_passed", F.col("grade"), F.col("subject")))

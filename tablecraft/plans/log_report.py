"""Log report by level and calendar month, in SQL and in DataFrame form.

Months of different years add up unless ``by_year`` is set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft import fixed_values as fixed
from tablecraft.functions import month_name, month_number, prefix_before
from tablecraft.operators import collect_pages, count_per, count_pivot
from tablecraft.operators.pages import PAGE_SIZE


def level_counts(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines per level, the level being the text before the first colon."""
    return count_per(lines, prefix_before(line, ":").alias("level"))


def times_per_level(logs: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """All times of each level in ascending order, in pages of bounded length."""
    pages = collect_pages(
        logs, ["level"], "datetime", F.to_date("datetime"), page_size, "datetime_list"
    )
    return pages.orderBy("level", "page")


def times_per_level_sql(logs: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """The pages of :func:`times_per_level`, put in order through SQL."""
    pages = collect_pages(
        logs, ["level"], "datetime", F.to_date("datetime"), page_size, "datetime_list"
    )
    return logs.sparkSession.sql(
        "SELECT level, page, datetime_list FROM {pages} ORDER BY level, page", pages=pages
    )


def month_report(logs: DataFrame, by_year: bool = False) -> DataFrame:
    """Rows per level and month name, in calendar order."""
    year = [F.year("datetime").alias("year")] if by_year else []
    counted = logs.groupBy(
        *year, "level", month_name("datetime").alias("month"), month_number("datetime").alias("monthnum")
    ).agg(F.count(F.lit(1)).alias("total"))
    ordering = (["year"] if by_year else []) + ["monthnum", "level"]
    return counted.orderBy(*ordering).drop("monthnum")


def month_report_sql(logs: DataFrame) -> DataFrame:
    """The same through SQL, grouping by a select alias."""
    return logs.sparkSession.sql(
        """
        SELECT level, date_format(datetime, 'MMMM') AS month, count(*) AS total
        FROM {logs}
        GROUP BY level, month
        ORDER BY min(month(datetime)), level
        """,
        logs=logs,
    )


def month_pivot(logs: DataFrame) -> DataFrame:
    """One row per level, one column per month, 0 where nothing was logged."""
    months = logs.select("level", month_name("datetime").alias("month"))
    return count_pivot(months, "level", "month", fixed.MONTH_NAMES)


def total_of(report: DataFrame) -> DataFrame:
    return report.sparkSession.sql("SELECT sum(total) AS total FROM {report}", report=report)

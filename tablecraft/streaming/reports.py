"""The live viewing reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablecraft import fixed_values as fixed
from tablecraft.operators import top_rows_per
from tablecraft.streaming.sinks import batch_table, start_stream
from tablecraft.streaming.windows import sliding_views, tumbling_views


def view_records(messages: DataFrame) -> DataFrame:
    """Broker messages (binary ``value``, ``timestamp``) as course views."""
    return messages.select("timestamp", F.col("value").cast("string").alias("course_name"))


def tumbling_report(messages: DataFrame, **settings) -> DataFrame:
    """Seconds watched per course and two-minute window."""
    return tumbling_views(view_records(messages), **settings)


def sliding_report(messages: DataFrame, **settings) -> DataFrame:
    """Seconds watched per course in the last hour, every minute of event time."""
    return sliding_views(view_records(messages), **settings)


def ranked_views(windows: DataFrame, name: str = "course_name", n: int = fixed.RANKED_ROWS) -> DataFrame:
    """The ``n`` most watched courses of each window, to run on each micro-batch."""
    return top_rows_per(windows, ["window"], [F.desc("seconds_watched"), F.asc(name)], n)


def ranked_report(
    messages: DataFrame,
    folder: str,
    n: int = fixed.RANKED_ROWS,
    interval: str | None = fixed.BATCH_INTERVAL,
    available_now: bool = False,
    **settings,
) -> StreamingQuery:
    """Start the ranking of the last hour: the ``n`` most watched courses of each window.

    Append mode gives each window once, when it is closed and all its courses are there;
    in update mode a batch would rank only the courses that changed. Rows go to a table in
    ``folder``, beside the checkpoint that a restart goes on from.
    """
    write = batch_table(folder, lambda batch: ranked_views(batch, n=n))
    return start_stream(
        sliding_report(messages, **settings), write, "append", f"{folder}/_checkpoint",
        interval, available_now, per_batch=True,
    )

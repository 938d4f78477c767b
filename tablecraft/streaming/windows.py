"""Event-time windows over view records, for batch and streaming frames alike.

A record has a time and a course name. Windows are aligned to the epoch. The time column
goes into ``window`` as it is: an alias inside the call would lose the watermark, and
state would grow forever.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tablecraft import fixed_values as fixed


def event_time(records: DataFrame, time: str = "timestamp", lateness: str | None = None) -> DataFrame:
    """Make ``time`` usable as event time; ``lateness`` adds a watermark to a stream.

    Watermarks need a timestamp with time zone. A time without one is read at the fixed offset
    of UTC, whatever the session's zone, so that no hour is missing or doubled where clocks change.
    """
    if lateness is None or not records.isStreaming:
        return records
    if _without_zone(records, time):
        records = records.withColumn(time, F.concat(F.col(time).cast("string"), F.lit("Z")).cast("timestamp"))
    return records.withWatermark(time, lateness)


def _without_zone(records: DataFrame, time: str) -> bool:
    return isinstance(records.schema[time].dataType, TimestampNTZType)


def _as_given(counted: DataFrame, records: DataFrame, time: str) -> DataFrame:
    """Windows of times without a zone have none either, in a stream as in a batch."""
    if not (records.isStreaming and _without_zone(records, time)):
        return counted

    def plain(side: str):
        return F.expr(f"timestampadd(MICROSECOND, unix_micros(window.{side}), TIMESTAMP_NTZ'1970-01-01 00:00:00')").alias(side)

    return counted.withColumn("window", F.struct(plain("start"), plain("end")))


def tumbling_views(
    records: DataFrame,
    time: str = "timestamp",
    name: str = "course_name",
    width: str = fixed.TUMBLING_WINDOW,
    lateness: str | None = fixed.LATENESS,
    seconds: int = fixed.SECONDS_PER_VIEW,
) -> DataFrame:
    """Seconds watched per window and course; a record without a course adds nothing."""
    timed = event_time(records, time, lateness)
    counted = timed.groupBy(F.window(time, width), name).agg(F.count(name).alias("_n"))
    return _as_given(counted.select("window", name, (F.col("_n") * seconds).alias("seconds_watched")), records, time)


def tumbling_views_sql(
    records: DataFrame,
    time: str = "timestamp",
    name: str = "course_name",
    width: str = fixed.TUMBLING_WINDOW,
    lateness: str | None = fixed.LATENESS,
    seconds: int = fixed.SECONDS_PER_VIEW,
) -> DataFrame:
    """The same through SQL; records without a course count too."""
    timed = event_time(records, time, lateness)
    counted = records.sparkSession.sql(
        f"""
        SELECT window, `{name}`, sum({seconds}) AS seconds_watched
        FROM {{records}}
        GROUP BY window(`{time}`, '{width}'), `{name}`
        """,
        records=timed,
    )
    return _as_given(counted, records, time)


def _micros_of(interval: str) -> int:
    """Length of a plain interval such as "10 minutes"."""
    units = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6}
    units |= {"day": 24 * units["hour"], "week": 7 * 24 * units["hour"]}
    number, unit = interval.split()
    return round(float(number) * units[unit.lower().removesuffix("s")])


def sliding_views(
    records: DataFrame,
    time: str = "timestamp",
    name: str = "course_name",
    width: str = fixed.SLIDING_WINDOW,
    slide: str = fixed.SLIDE,
    lateness: str | None = fixed.LATENESS,
    seconds: int = fixed.SECONDS_PER_VIEW,
) -> DataFrame:
    """Seconds watched per course in windows of ``width`` that start every ``slide``.

    Each record is counted once in its pane, whose length is the greatest common divisor of
    ``width`` and ``slide``; windows start and end where panes do, so only the counted panes
    are spread over the windows that contain them.
    """
    pane = f"{gcd(_micros_of(width), _micros_of(slide))} microseconds"
    timed = event_time(records, time, lateness)
    pieces = timed.groupBy(F.window(time, pane).alias("piece"), name).agg(F.count(F.lit(1)).alias("_n"))
    spread = pieces.groupBy(F.window("piece", width, slide), name).agg(F.sum("_n").alias("_n"))
    return _as_given(spread.select("window", name, (F.col("_n") * seconds).alias("seconds_watched")), records, time)


def flat_window(frame: DataFrame) -> DataFrame:
    """``window`` as two columns without time zone, ``window_start`` and ``window_end``."""
    rest = [column for column in frame.columns if column != "window"]
    return frame.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *rest,
    )

"""Raw view records to timed, named views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft import fixed_values as fixed
from tablecraft.operators import lookup
from tablecraft.sources import inline_lookup


def course_names(spark: SparkSession) -> DataFrame:
    """The fixed course keys and names."""
    return inline_lookup(spark, list(fixed.COURSE_NAMES.items()), "course_key int, course_name string")


def timed_views(records: DataFrame, base: str, offset: str = "offset_ms", speedup: int = 1) -> DataFrame:
    """Add ``event_time``: ``base`` plus the millisecond offset, replayed ``speedup`` times faster."""
    micros = (F.col(offset).cast("bigint") * 1000 / speedup).cast("bigint")
    start = F.lit(base).cast("timestamp_ntz")
    return records.withColumn("event_time", F.timestamp_add("MICROSECOND", micros, start))


def name_views(records: DataFrame, names: DataFrame, key: str = "course_key") -> DataFrame:
    """Add the course name; a key that is not listed gets a null name.

    Works for a stream of records with a static frame of names.
    """
    return lookup(records, names, key, "left")

"""Windows, streams and enrichment on the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tablecraft import fixed_values as fixed
from tablecraft import streaming as live
from tablecraft.checks.registry import query, table
from tablecraft.shared import new_folder
from tablecraft.sources import file_stream, register_view
from tablecraft.streaming import flat_window

KEYS = ["window_start", "window_end", "course_name"]


def event_records(events: DataFrame) -> DataFrame:
    """Events as view records: the event type is the course."""
    return events.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("course_name"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_stream(spark, f"{sf_dir}/events*.parquet", table(spark, sf_dir, "events").schema)


TUMBLING_SQL = """
    SELECT time_bucket(INTERVAL 2 MINUTE, ts) AS window_start,
        time_bucket(INTERVAL 2 MINUTE, ts) + INTERVAL 2 MINUTE AS window_end,
        event_type AS course_name, count(*) * 5 AS seconds_watched
    FROM events GROUP BY 1, 2, 3
"""

SLIDING_SQL = """
    SELECT minute - to_minutes(back) AS window_start, minute - to_minutes(back) + INTERVAL 1 HOUR AS window_end,
        event_type AS course_name, sum(n * 5)::BIGINT AS seconds_watched
    FROM (SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS n FROM events GROUP BY 1, 2)
    CROSS JOIN (SELECT unnest(range(60)) AS back)
    GROUP BY 1, 2, 3
"""

CLOSED_SQL = "window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)"


@query(TUMBLING_SQL)
def tumbling_views(spark, sf_dir):
    return flat_window(live.tumbling_views(event_records(table(spark, sf_dir, "events"))))


@query(TUMBLING_SQL)
def tumbling_sql(spark, sf_dir):
    return flat_window(live.tumbling_views_sql(event_records(table(spark, sf_dir, "events"))))


@query(SLIDING_SQL)
def sliding_views(spark, sf_dir):
    return flat_window(live.sliding_views(event_records(table(spark, sf_dir, "events"))))


@query(TUMBLING_SQL)
def stream_tumbling(spark, sf_dir):
    """Update mode: every window, in its last version."""
    windows = flat_window(live.tumbling_views(event_records(event_stream(spark, sf_dir))))
    return live.latest_rows(live.run_to_table(windows, "update"), KEYS)


@query(f"SELECT * FROM ({TUMBLING_SQL}) WHERE {CLOSED_SQL}")
def stream_tumbling_closed(spark, sf_dir):
    """Append mode: only windows that the watermark has passed, each once."""
    windows = live.tumbling_views(event_records(event_stream(spark, sf_dir)))
    return flat_window(live.run_to_table(windows, "append")).drop("batch_id")


@query(TUMBLING_SQL)
def stream_tumbling_sql(spark, sf_dir):
    """The SQL form on a streaming view, in update mode."""
    register_view(event_records(event_stream(spark, sf_dir)), "viewing_records")
    windows = flat_window(live.tumbling_views_sql(spark.table("viewing_records")))
    return live.latest_rows(live.run_to_table(windows, "update"), KEYS)


@query(f"SELECT * FROM ({SLIDING_SQL}) WHERE {CLOSED_SQL}")
def stream_sliding(spark, sf_dir):
    windows = live.sliding_views(event_records(event_stream(spark, sf_dir)))
    return flat_window(live.run_to_table(windows, "append")).drop("batch_id")


@query(f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY window_start ORDER BY seconds_watched DESC, course_name)::INTEGER AS rank
        FROM ({SLIDING_SQL}) WHERE {CLOSED_SQL})
    WHERE rank <= 3
""")
def stream_ranked_batches(spark, sf_dir):
    """The three most watched courses of every closed window, ranked batch by batch."""
    windows = live.sliding_views(event_records(event_stream(spark, sf_dir)))

    def ranked(batch: DataFrame) -> DataFrame:
        return live.ranked_views(batch, n=3)

    schema = StructType([*windows.schema.fields, StructField("rank", IntegerType())])
    return flat_window(live.run_to_table(windows, "append", ranked, schema)).drop("batch_id")


@query(f"""
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY window_start ORDER BY seconds_watched DESC, course_name)::INTEGER AS rank
        FROM ({SLIDING_SQL}) WHERE {CLOSED_SQL})
    WHERE rank <= 2
""")
def ranked_last_hour(spark, sf_dir):
    """The started report of the last hour, as messages of a broker feed it."""
    records = event_records(event_stream(spark, sf_dir))
    messages = records.select("timestamp", F.col("course_name").cast("binary").alias("value"))
    folder = new_folder(spark, "last-hour")
    live.ranked_report(messages, folder, n=2, interval=None, available_now=True).awaitTermination()
    schema = StructType([*live.sliding_report(messages).schema.fields, StructField("rank", IntegerType())])
    return flat_window(live.read_batches(spark, folder, schema)).drop("batch_id")


# ---- raw records: event number as offset, user as course key --------------------------

KEY_COUNT = 50  # keys 43 to 49 have no name
REPLAY_START = "2024-01-01 00:00:00"

NAMES_SQL = "(VALUES " + ", ".join(f"({key}, '{name}')" for key, name in fixed.COURSE_NAMES.items()) + (
    ") AS names(course_key, course_name)"
)


def raw_records(events: DataFrame) -> DataFrame:
    key = F.pmod("user_id", F.lit(KEY_COUNT)).cast("int")
    return events.select("event_id", (F.col("event_id") * 977).alias("offset_ms"), key.alias("course_key"))


RAW_SQL = f"SELECT event_id, event_id * 977 AS offset_ms, (user_id % {KEY_COUNT})::INTEGER AS course_key FROM events"

ENRICH_SQL = f"""
    SELECT event_id, offset_ms, course_key, course_name
    FROM ({RAW_SQL}) LEFT JOIN {NAMES_SQL} USING (course_key)
"""


@query(ENRICH_SQL)
def enrich_events(spark, sf_dir):
    return live.name_views(raw_records(table(spark, sf_dir, "events")), live.course_names(spark))


@query(ENRICH_SQL)
def stream_enrich(spark, sf_dir):
    named = live.name_views(raw_records(event_stream(spark, sf_dir)), live.course_names(spark))
    return live.run_to_table(named, "append").drop("batch_id")


@query(f"""
    SELECT event_id, offset_ms, course_key,
        TIMESTAMP '{REPLAY_START}' + to_microseconds(offset_ms * 1000 // 24) AS event_time
    FROM ({RAW_SQL})
""")
def replay_event_time(spark, sf_dir):
    return live.timed_views(raw_records(table(spark, sf_dir, "events")), REPLAY_START, speedup=24)

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tablecraft import streaming as live
from tablecraft.shared import settled, shared_folder
from tablecraft.sources import file_stream

SCHEMA = "timestamp timestamp, course_name string"
DAY = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(minutes, seconds=0):
    return DAY + dt.timedelta(minutes=minutes, seconds=seconds)


def put(folder, number, records):
    table = pa.table({
        "timestamp": pa.array([r[0] for r in records], pa.timestamp("us", tz="UTC")),
        "course_name": pa.array([r[1] for r in records], pa.string()),
    })
    folder.mkdir(exist_ok=True)
    path = folder / f"part-{number:03d}.parquet"
    pq.write_table(table, path)
    import os

    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def stream(spark, folder):
    return file_stream(spark, str(folder), SCHEMA, max_files_per_trigger=1)


def flat(frame):
    return rows(live.flat_window(frame).select("window_start", "course_name", "seconds_watched"))


def minute(value):
    return at(value).replace(tzinfo=None)


RECORDS = [(at(0), "a"), (at(1, 59), "a"), (at(2), "a"), (at(3), "b"), (at(3), None)]


def test_batch_windows_and_null_courses(spark):
    frame = spark.createDataFrame(RECORDS, SCHEMA)
    assert flat(live.tumbling_views(frame)) == sorted(
        [(minute(0), "a", 10), (minute(2), "a", 5), (minute(2), "b", 5), (minute(2), None, 0)], key=repr
    )
    assert (minute(2), None, 5) in flat(live.tumbling_views_sql(frame))


def test_broker_messages(spark):
    messages = spark.createDataFrame([(at(0), bytearray(b"a"))], "timestamp timestamp, value binary")
    assert flat(live.tumbling_report(messages)) == [(minute(0), "a", 5)]
    assert live.sliding_report(messages).count() == 60


def test_sliding_windows_against_brute_force(spark):
    records = [(at(0, 30), "a"), (at(0, 40), "a"), (at(5), "a"), (at(61), "b")]
    got = flat(live.sliding_views(spark.createDataFrame(records, SCHEMA)))
    expected = {}
    for time, course in records:
        for start in range(-59, 62):
            if at(start) <= time < at(start + 60):
                expected[(minute(start), course)] = expected.get((minute(start), course), 0) + 5
    assert got == sorted(((*key, value) for key, value in expected.items()), key=repr)


def test_complete_stream_equals_batch(spark, tmp_path):
    put(tmp_path / "in", 0, RECORDS[:3])
    put(tmp_path / "in", 1, RECORDS[3:])
    for windows in (live.tumbling_views, live.tumbling_views_sql):
        query = live.start_stream(
            windows(stream(spark, tmp_path / "in")), "memory", "complete", available_now=True, throwaway=True, name="complete_views"
        )
        query.awaitTermination()
        assert flat(spark.table("complete_views")) == flat(windows(spark.createDataFrame(RECORDS, SCHEMA)))


@pytest.mark.parametrize(("width", "slide"), [("10 minutes", "3 minutes"), ("7 seconds", "2 seconds"), ("1 hour", "25 minutes"), ("90 seconds", "1 minute")])
def test_any_width_and_slide_equal_the_plain_window(spark, width, slide):
    frame = spark.range(400).selectExpr("timestamp_micros(1704067200000000 + id * 7654321) AS timestamp", "concat('c', id % 3) AS course_name")
    plain = frame.groupBy(F.window("timestamp", width, slide), "course_name").agg((F.count(F.lit(1)) * 5).alias("seconds_watched"))
    assert flat(live.sliding_views(frame, width=width, slide=slide)) == flat(plain)


def test_times_without_zone_keep_their_hours_where_clocks_change(spark, tmp_path, set_conf):
    """A stream gives the windows of its batch twin on the days on which clocks change."""
    set_conf(spark__sql__session__timeZone="America/New_York")
    schema = "timestamp timestamp_ntz, course_name string"
    days = [dt.datetime(2024, 3, 10), dt.datetime(2024, 11, 3)]
    records = [(day + dt.timedelta(minutes=10 * i), "a") for day in days for i in range(30)]
    table = pa.table({"timestamp": pa.array([r[0] for r in records], pa.timestamp("us")), "course_name": [r[1] for r in records]})
    (tmp_path / "in").mkdir()
    pq.write_table(table, tmp_path / "in" / "part.parquet")
    batch = spark.createDataFrame(records, schema)
    source = file_stream(spark, str(tmp_path / "in"), schema, max_files_per_trigger=1)
    sliding = lambda f: live.sliding_views(f, width="10 minutes", slide="3 minutes")
    for place, (windows, mode) in enumerate(((live.tumbling_views, "complete"), (live.tumbling_views_sql, "complete"), (sliding, "append"))):
        query = live.start_stream(windows(source), "memory", mode, available_now=True, throwaway=True, name=f"unzoned{place}")
        query.awaitTermination()
        found, expected = spark.table(f"unzoned{place}"), windows(batch)
        assert found.schema["window"].dataType.simpleString() == expected.schema["window"].dataType.simpleString()
        if mode == "complete":
            assert flat(found) == flat(expected) and len(flat(found)) == 60
        else:  # only closed windows leave a chain of two aggregates
            closed = [r for r in flat(expected) if r[0] < dt.datetime(2024, 11, 3, 4, 30)]
            assert [r for r in flat(found) if r[0] < dt.datetime(2024, 11, 3, 4, 30)] == closed and len(closed) > 150


def late_input(folder):
    put(folder, 0, [(at(0), "a"), (at(30), "a")])  # watermark becomes minute 20
    put(folder, 1, [(at(25), "a")])  # in time; from the next batch on rows before minute 20 are late
    put(folder, 2, [(at(5), "late"), (at(31), "a")])
    put(folder, 3, [(at(90), "a")])


def test_watermark_drops_late_rows_and_closed_state(spark, tmp_path):
    late_input(tmp_path / "in")
    windows = live.tumbling_views(stream(spark, tmp_path / "in"))
    query = live.start_stream(windows, "memory", "append", available_now=True, throwaway=True, name="closed_views")
    query.awaitTermination()
    assert flat(spark.table("closed_views")) == [
        (minute(0), "a", 5), (minute(24), "a", 5), (minute(30), "a", 10)
    ]
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in states) == 1
    assert states[-1]["numRowsTotal"] == 1


def test_update_mode_sends_changed_windows_only(spark, tmp_path):
    late_input(tmp_path / "in")
    sent = []
    query = live.start_stream(
        live.flat_window(live.tumbling_views(stream(spark, tmp_path / "in"))),
        lambda batch, batch_id: sent.append((batch_id, rows(batch.select("window_start", "seconds_watched")))),
        "update", available_now=True, per_batch=True, throwaway=True,
    )
    query.awaitTermination()
    changed = [batch for _, batch in sorted(sent) if batch]
    assert changed == [
        [(minute(0), 5), (minute(30), 5)], [(minute(24), 5)], [(minute(30), 10)], [(minute(90), 5)]
    ]


def test_window_keeps_the_watermark(spark, tmp_path):
    put(tmp_path / "in", 0, RECORDS)
    records = live.event_time(stream(spark, tmp_path / "in"), lateness="10 minutes")
    assert "spark.watermarkDelayMs" in records.schema["timestamp"].metadata
    kept = records.groupBy(F.window("timestamp", "2 minutes")).count()
    assert "spark.watermarkDelayMs" in kept.schema["window"].metadata
    # the trap: an alias inside the call loses it, and append mode is refused
    lost = records.groupBy(F.window(F.col("timestamp").alias("other"), "2 minutes")).count()
    assert "spark.watermarkDelayMs" not in lost.schema["window"].metadata
    with pytest.raises(AnalysisException):
        live.start_stream(lost, "memory", "append", available_now=True, throwaway=True, name="lost")


def test_sorting_an_update_stream_is_refused(spark, tmp_path):
    put(tmp_path / "in", 0, RECORDS)
    ordered = live.tumbling_views(stream(spark, tmp_path / "in")).orderBy("seconds_watched")
    with pytest.raises(AnalysisException):
        live.start_stream(ordered, "memory", "update", available_now=True, throwaway=True, name="ordered")


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    source, checkpoint, folder = tmp_path / "in", str(tmp_path / "checkpoint"), str(tmp_path / "out")
    put(source, 0, RECORDS[:2])
    windows = live.flat_window(live.tumbling_views(stream(spark, source)))
    keys = ["window_start", "window_end", "course_name"]
    live.run_to_table(windows, "update", checkpoint=checkpoint, folder=folder)
    put(source, 1, RECORDS[2:])
    windows = live.flat_window(live.tumbling_views(stream(spark, source)))
    table = live.run_to_table(windows, "update", checkpoint=checkpoint, folder=folder)
    expected = live.flat_window(live.tumbling_views(spark.createDataFrame(RECORDS, SCHEMA)))
    assert rows(live.latest_rows(table, keys)) == rows(expected)
    assert rows(live.latest_rows(live.run_to_table(windows, "update", checkpoint=checkpoint, folder=folder), keys)) == rows(expected)


def test_a_stream_needs_a_checkpoint(spark, tmp_path):
    put(tmp_path / "in", 0, RECORDS)
    with pytest.raises(ValueError, match="checkpoint"):
        live.start_stream(live.tumbling_views(stream(spark, tmp_path / "in")))


def test_a_second_run_into_a_folder_keeps_the_first(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "out")
    put(source, 0, [(at(0), "a")])
    assert live.run_to_table(stream(spark, source), "append", folder=folder).count() == 1
    put(source, 1, [(at(1), "b")])
    table = live.run_to_table(stream(spark, source), "append", folder=folder)
    assert sorted(r.course_name for r in table.collect()) == ["a", "b"]


def test_ranked_report_ranks_whole_windows_over_batches(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "out")
    put(source, 0, [(at(0), "a"), (at(0), "a"), (at(0), "b")])
    put(source, 1, [(at(0), "b"), (at(0), "b")])
    put(source, 2, [(at(300), "z")])
    messages = stream(spark, source).select(F.col("course_name").cast("binary").alias("value"), "timestamp")
    live.ranked_report(messages, folder, available_now=True).awaitTermination()
    ranked = spark.read.parquet(folder).select("course_name", "seconds_watched", "rank").distinct()
    assert rows(ranked) == [("a", 10, 2), ("b", 15, 1)]


def test_batch_written_twice_counts_once(spark, tmp_path):
    write = live.batch_table(str(tmp_path / "out"))
    frame = spark.createDataFrame([(1, "a")], "k int, v string")
    write(frame, 0)
    write(frame, 0)
    write(spark.createDataFrame([(1, "b")], "k int, v string"), 1)
    table = live.read_batches(spark, str(tmp_path / "out"), frame.schema)
    assert rows(table) == [(1, "a", 0), (1, "b", 1)]
    assert rows(live.latest_rows(table, ["k"])) == [(1, "b")]


def test_no_batch_at_all_is_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    windows = live.tumbling_views(stream(spark, tmp_path / "in"))
    table = live.run_to_table(windows, "append")
    assert table.count() == 0 and table.columns == ["window", "course_name", "seconds_watched", "batch_id"]


def test_ranked_batches(spark, tmp_path):
    put(tmp_path / "in", 0, [(at(0), "a"), (at(0), "b"), (at(0), "b"), (at(0), "c"), (at(200), "z")])
    windows = live.tumbling_views(stream(spark, tmp_path / "in"))
    schema = StructType([*windows.schema.fields, StructField("rank", IntegerType())])
    table = live.run_to_table(windows, "append", lambda batch: live.ranked_views(batch, n=2), schema)
    assert rows(table.select("course_name", "seconds_watched", "rank")) == [("a", 5, 2), ("b", 10, 1)]


def test_console_and_interval(spark, tmp_path):
    put(tmp_path / "in", 0, RECORDS)
    query = live.start_stream(live.tumbling_views(stream(spark, tmp_path / "in")), throwaway=True)
    query.processAllAvailable()
    assert query.lastProgress is not None
    query.stop()
    assert not query.awaitTermination(1) or not query.isActive


def test_enrich_stream_and_batch(spark, tmp_path):
    raw = spark.createDataFrame([(0, 0), (86_400_000, 42), (5, 43)], "offset_ms int, course_key int")
    named = live.name_views(live.timed_views(raw, "2024-01-01 00:00:00", speedup=24), live.course_names(spark))
    assert rows(named.select("course_key", "event_time", "course_name")) == [
        (0, minute(0), "Spring Boot Microservices"), (42, minute(60), "Spark Module 3 Machine Learning SparkML"),
        (43, minute(0).replace(microsecond=208), None),
    ]
    assert live.course_names(spark).count() == 43


def test_shared_folder(spark):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value or default

    class Cluster:
        def __init__(self, master, folder, set_on_context=None):
            self.conf = Conf(folder)
            context = {"master": master, "applicationId": "app", "getCheckpointDir": lambda _: set_on_context}
            self.sparkContext = type("Context", (), context)()

    assert shared_folder(Cluster("yarn", "hdfs://shared/work/")) == "hdfs://shared/work"
    with pytest.raises(RuntimeError):
        shared_folder(Cluster("yarn", None))
    with pytest.raises(RuntimeError):
        shared_folder(Cluster("local-cluster[2,1,1024]", None))
    assert shared_folder(Cluster("yarn", None, "hdfs://set/before")) == "hdfs://set/before"
    assert shared_folder(spark) == shared_folder(spark)


def test_settled_rows_keep_no_lineage(spark):
    before = spark.sparkContext.getCheckpointDir()
    frame = settled(spark.range(10).repartition(3))
    assert frame.count() == 10
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "Range" not in plan
    assert all(shared_folder(spark) in path for path in frame.inputFiles())
    assert spark.sparkContext.getCheckpointDir() == before

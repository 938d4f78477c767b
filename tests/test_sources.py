from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import types as T

from tablecraft import sources


def write(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_inline_values_and_rows(spark):
    assert rows(sources.inline_values(spark, [11, 12], "bigint")) == [(11,), (12,)]
    logs = sources.inline_rows(spark, [("NOTE", "2031-02-03 04:05:06")])
    assert logs.schema == sources.LOG_SCHEMA
    assert not logs.schema["level"].nullable
    assert rows(logs) == [("NOTE", "2031-02-03 04:05:06")]


def test_inline_lookup_broadcasts_only_short_lists(spark, monkeypatch):
    def hinted(frame):
        return "ResolvedHint" in frame._jdf.queryExecution().analyzed().toString()

    short = sources.inline_lookup(spark, [(1, "a")], "k int, v string")
    assert hinted(short)
    monkeypatch.setattr("tablecraft.sources.inline.BROADCAST_ROWS", 1)
    assert not hinted(sources.inline_lookup(spark, [(1, "a"), (2, "b")], "k int, v string"))


def test_text_lines(spark, tmp_path):
    path = write(tmp_path, "a.txt", "one\ntwo three\r\n\n")
    assert rows(sources.text_lines(spark, path)) == [("",), ("one",), ("two three",)]


def test_positional_files_by_glob_keep_spaces_and_quotes(spark, tmp_path):
    write(tmp_path, "views-1.csv", "1,10,2020-01-01\n2,11,x\n")
    write(tmp_path, "views-2.csv", "1,10,2020-01-02\n")
    assert rows(sources.read_views(spark, f"{tmp_path}/views-*.csv")) == [(1, 10), (1, 10), (2, 11)]
    titles = write(tmp_path, "titles.csv", '1,"Quoted"\n16,Trailing \n')
    assert rows(sources.read_titles(spark, titles)) == [(1, '"Quoted"'), (16, "Trailing ")]
    chapters = write(tmp_path, "chapters.csv", "7,1\n")
    assert rows(sources.read_chapters(spark, chapters)) == [(7, 1)]


@pytest.mark.parametrize("text", ["x,1\n", "1,2,3\n"])
def test_positional_junk_fails(spark, tmp_path, text):
    path = write(tmp_path, "chapters.csv", text)
    with pytest.raises(Exception, match="MALFORMED"):
        sources.read_chapters(spark, path).collect()


@pytest.mark.parametrize("text", [",10,x\n", "1,,x\n", "1\n"])
def test_blank_and_absent_ids_fail_under_any_action(spark, tmp_path, text):
    views = sources.read_views(spark, write(tmp_path, "views.csv", "1,2,x\n" + text))
    for read in (views.count, views.collect, views.select("user_id").collect):
        with pytest.raises(Exception, match="blank value|MALFORMED"):
            read()


def test_extra_and_missing_fields_fail_and_a_blank_date_passes(spark, tmp_path):
    for text in ("1,2,x,y\n", "1,2\n"):
        with pytest.raises(Exception, match="MALFORMED"):
            sources.read_views(spark, write(tmp_path, "junk.csv", text)).count()
    assert rows(sources.read_views(spark, write(tmp_path, "blank.csv", "1,2,\n"))) == [(1, 2)]


def test_headered_strings_inference_and_schema(spark, tmp_path):
    first = write(tmp_path, "p0.csv", "country,n\nGB,1\n")
    second = write(tmp_path, "p1.csv", "country,n\nUS,2\n")
    both = sources.headered_csv(spark, [first, second])
    assert rows(both) == [("GB", "1"), ("US", "2")]
    inferred = sources.headered_csv(spark, [first, second], infer=True)
    assert [f.dataType for f in inferred.schema] == [T.StringType(), T.IntegerType()]
    typed = sources.headered_csv(spark, first, "country string, n bigint")
    assert rows(typed) == [("GB", 1)] and typed.schema["n"].dataType == T.LongType()


def test_kafka_options():
    assert sources.kafka_options("broker:9092", ["views", "more"], group_id="g", max_offsets_per_trigger=5) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "views,more",
        "startingOffsets": "latest", "kafka.group.id": "g", "maxOffsetsPerTrigger": "5",
    }
    assert sources.kafka_options("b", "views", starting_offsets="earliest")["startingOffsets"] == "earliest"


def test_file_stream_and_view(spark, sf_dir):
    stream = sources.file_stream(spark, f"{sf_dir}/events*.parquet", max_files_per_trigger=1)
    assert stream.isStreaming and "event_id" in stream.columns
    sources.register_view(stream, "streamed_events")
    assert spark.table("streamed_events").isStreaming

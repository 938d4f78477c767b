"""Readers: typed and headered CSV, text lines, in-memory rows, streams, SQL views."""

from tablecraft.sources.files import (
    CHAPTER_COLUMNS, TITLE_COLUMNS, VIEW_COLUMNS, headered_csv, positional_csv,
    read_chapters, read_titles, read_views, text_lines,
)
from tablecraft.sources.inline import LOG_SCHEMA, inline_lookup, inline_rows, inline_values
from tablecraft.sources.streams import file_stream, kafka_options, kafka_stream
from tablecraft.sources.views import register_view

__all__ = [
    "CHAPTER_COLUMNS", "TITLE_COLUMNS", "VIEW_COLUMNS", "headered_csv", "positional_csv",
    "read_chapters", "read_titles", "read_views", "text_lines",
    "LOG_SCHEMA", "inline_lookup", "inline_rows", "inline_values",
    "file_stream", "kafka_options", "kafka_stream", "register_view",
]

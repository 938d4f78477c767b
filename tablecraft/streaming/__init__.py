"""Live reports: event-time windows, enrichment, sinks and the start of a query."""

from tablecraft.streaming.enrich import course_names, name_views, timed_views
from tablecraft.streaming.reports import ranked_report, ranked_views, sliding_report, tumbling_report, view_records
from tablecraft.streaming.sinks import (
    batch_table, console, latest_rows, read_batches, run_to_table, start_stream,
)
from tablecraft.streaming.windows import (
    event_time, flat_window, sliding_views, tumbling_views, tumbling_views_sql,
)

__all__ = [
    "course_names", "name_views", "timed_views",
    "ranked_report", "ranked_views", "sliding_report", "tumbling_report", "view_records",
    "batch_table", "console", "latest_rows", "read_batches", "run_to_table", "start_stream",
    "event_time", "flat_window", "sliding_views", "tumbling_views", "tumbling_views_sql",
]

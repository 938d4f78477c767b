"""Building blocks on whole tables: DataFrame in, DataFrame out."""

from tablecraft.operators.aggregates import (
    count_per, distinct_rows, extremes_per, global_count, global_sum, grand_total,
)
from tablecraft.operators.correlation import correlation_matrix, numeric_candidates
from tablecraft.operators.joins import exclude, lookup
from tablecraft.operators.pages import collect_pages
from tablecraft.operators.pivots import count_pivot, stats_pivot
from tablecraft.operators.ranking import top_rows, top_rows_per
from tablecraft.operators.words import word_counts

__all__ = [
    "count_per", "distinct_rows", "extremes_per", "global_count", "global_sum", "grand_total",
    "correlation_matrix", "numeric_candidates", "exclude", "lookup", "collect_pages",
    "count_pivot", "stats_pivot", "top_rows", "top_rows_per", "word_counts",
]

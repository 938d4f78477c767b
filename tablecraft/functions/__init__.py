"""Column expressions. All of them stay inside the JVM."""

from tablecraft.functions.columns import (
    category_group, completion_score, flag_above, has_passed, month_name, month_number,
    month_number_of_name, null_to_zero, prefix_before, ratio, words_of,
)
from tablecraft.functions.sql import register_sql_functions

__all__ = [
    "category_group", "completion_score", "flag_above", "has_passed", "month_name",
    "month_number", "month_number_of_name", "null_to_zero", "prefix_before", "ratio",
    "words_of", "register_sql_functions",
]

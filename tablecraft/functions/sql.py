"""The same rules as named SQL functions.

They are SQL-bodied, so Spark inlines them: calling one costs no Python worker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tablecraft import fixed_values as fixed


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _list(values: Sequence[str]) -> str:
    return ", ".join(map(_quoted, values))


def _starts(name: str, prefixes: Sequence[str]) -> str:
    return " OR ".join(f"startswith({name}, {_quoted(prefix)})" for prefix in prefixes)


def register_sql_functions(
    spark: SparkSession,
    strict_subject: str = fixed.STRICT_SUBJECT,
    strict_grades: Sequence[str] = fixed.STRICT_GRADES,
    grades: Sequence[str] = fixed.PASSING_GRADES,
) -> list[str]:
    """Create ``has_passed``, ``month_num`` and ``country_group`` for this session."""
    bodies = {
        "has_passed(grade STRING, subject STRING) RETURNS BOOLEAN": f"""
            CASE WHEN grade IS NULL OR subject IS NULL THEN NULL
                 WHEN subject = {_quoted(strict_subject)} THEN {_starts("grade", strict_grades)}
                 ELSE {_starts("grade", grades)} END""",
        "month_num(name STRING) RETURNS INT": f"""
            cast(nullif(array_position(array({_list(fixed.MONTH_NAMES)}), name), 0) AS INT)""",
        "country_group(country STRING) RETURNS STRING": f"""
            CASE WHEN country IN ({_list(fixed.KEPT_COUNTRIES)}) THEN country
                 WHEN country IN ({_list(fixed.EUROPEAN_COUNTRIES)}) THEN 'EUROPE'
                 ELSE 'OTHER' END""",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in bodies]

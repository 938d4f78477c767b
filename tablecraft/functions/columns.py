"""Reusable column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablecraft import fixed_values as fixed


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def null_to_zero(value: Column | str) -> Column:
    return F.coalesce(_column(value), F.lit(0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """True division; null where the denominator is 0."""
    return F.try_divide(_column(numerator).cast("double"), _column(denominator).cast("double"))


def flag_above(value: Column | str, bound: int | float, inclusive: bool = False) -> Column:
    """1 above ``bound``, else 0; a null counts as not above."""
    value = _column(value)
    return F.when(value >= bound if inclusive else value > bound, 1).otherwise(0)


def prefix_before(value: Column | str, mark: str) -> Column:
    """Text before the first ``mark``, or all of it if there is none."""
    return F.substring_index(_column(value), mark, 1)


def words_of(text: Column | str) -> Column:
    """Array of lower-case letter-only words of a whole text.

    Words end at a space or a line end. Other characters, tabs included, vanish from
    the word that holds them, so a blank entry can remain where nothing is left.
    """
    letters = F.regexp_replace(F.lower(_column(text)), r"[^a-z \r\n]+", "")
    return F.split(letters, r"[ \r\n]+")


def month_name(time: Column | str) -> Column:
    return F.date_format(_column(time), "MMMM")


def month_number(time: Column | str) -> Column:
    return F.month(_column(time))


def month_number_of_name(name: Column | str) -> Column:
    """1 to 12 for an English month name; null for anything else."""
    names = F.array(*[F.lit(month) for month in fixed.MONTH_NAMES])
    position = F.array_position(names, _column(name))
    return F.nullif(position, F.lit(0).cast("bigint")).cast("int")


def completion_score(
    done: Column | str,
    total: Column | str,
    bands: Sequence[tuple[float, int]] = fixed.COMPLETION_BANDS,
    floor: int = fixed.COMPLETION_FLOOR,
) -> Column:
    """Score of the highest band whose bound the share ``done / total`` exceeds."""
    share = ratio(done, total)
    ascending = sorted(bands)
    return reduce(
        lambda lower, band: F.when(share > band[0], F.lit(band[1])).otherwise(lower),
        ascending,
        F.lit(floor),
    )


def has_passed(
    grade: Column | str,
    subject: Column | str,
    strict_subject: str = fixed.STRICT_SUBJECT,
    strict_grades: Sequence[str] = fixed.STRICT_GRADES,
    grades: Sequence[str] = fixed.PASSING_GRADES,
) -> Column:
    """Whether a grade passes; null if the grade or the subject is null."""
    grade, subject = _column(grade), _column(subject)

    def starts_with_any(prefixes: Sequence[str]) -> Column:
        return reduce(or_, [grade.startswith(prefix) for prefix in prefixes])

    passed = F.when(subject == strict_subject, starts_with_any(strict_grades)).otherwise(
        starts_with_any(grades)
    )
    return F.when(grade.isNotNull() & subject.isNotNull(), passed)


def category_group(
    value: Column | str,
    kept: Sequence[str] = fixed.KEPT_COUNTRIES,
    members: Sequence[str] = fixed.EUROPEAN_COUNTRIES,
    group: str = "EUROPE",
    rest: str = "OTHER",
) -> Column:
    """``kept`` values stay, ``members`` become ``group``, all else (null too) is ``rest``."""
    value = _column(value)
    return F.when(value.isin(*kept), value).when(value.isin(*members), group).otherwise(rest)

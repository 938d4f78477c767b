"""Columns of the caller beside those that an operator makes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def beside_others(docs: DataFrame, needed: tuple[str, ...], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``step`` keeps of ``docs``, with all columns as they were.

    The step sees the columns it needs under their names, and the others under names that no
    operator uses, so that its own columns never meet the caller's, whatever these are called.
    """
    names = docs.columns
    own = [name if name in needed and names.index(name) == i else f"_other{i}" for i, name in enumerate(names)]
    return step(docs.toDF(*own)).select(*own).toDF(*names)

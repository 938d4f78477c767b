"""SQL views over frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_view(frame: DataFrame, name: str) -> DataFrame:
    """Make a batch or streaming frame visible to ``spark.sql`` under ``name``."""
    frame.createOrReplaceTempView(name)
    return frame

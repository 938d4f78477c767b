"""Joins of a large frame with a lookup frame.

Neither side carries a broadcast hint. Spark broadcasts the lookup when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides
on the key, where adaptive execution splits oversized partitions of the large side.
``salts`` spreads a hot key over that many tasks without relying on either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def lookup(facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner", salts: int | None = None) -> DataFrame:
    """Join on ``key``; ``how`` keeps the facts side: inner, left, left_semi or left_anti.

    With ``salts`` each lookup row is repeated once per salt and each fact goes to the
    salt its other columns hash to. The hash makes a retried task agree with its first
    run, which a random salt would not.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported lookup join: {how}")
    rest = [name for name in facts.columns if name != key]
    if not salts or salts < 2 or not rest:
        return facts.join(dimension, key, how)
    salted_facts = facts.withColumn(SALT, F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int"))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return salted_facts.join(dimension.withColumn(SALT, every_salt), [key, SALT], how).drop(SALT)


def exclude(rows: DataFrame, unwanted: DataFrame, key: str, salts: int | None = None) -> DataFrame:
    """Rows whose key does not occur in ``unwanted``."""
    return lookup(rows, unwanted.select(key), key, "left_anti", salts)

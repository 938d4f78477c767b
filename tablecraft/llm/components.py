"""Connected components of an edge table, by hooking to the least neighbour and halving.

Every round is a handful of grouped joins; its result is written to the shared folder, so
neither the plan nor a lost executor makes a round run twice. Rounds follow the logarithm
of the longest chain. No edge or label reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.shared import settled


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (the least node of its component) for every node of an edge."""
    pairs = edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).where("low < high")
    pairs = settled(pairs.distinct(), "edges")
    while True:
        # Large star, then small star: neighbours meet at the least node around each node.
        both = pairs.selectExpr("low AS u", "high AS v").union(pairs.selectExpr("high", "low"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").selectExpr("m AS low", "v AS high").where("low < high")
        large = settled(large.distinct(), "large")
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = (
            large.join(least, "high")
            .select(F.explode(F.array(F.struct(F.col("m").alias("low"), F.col("high")), F.struct(F.col("m").alias("low"), F.col("low").alias("high")))).alias("e"))
            .select("e.*")
            .where("low < high")
        )
        small = settled(small.distinct(), "small")
        same = F.struct(F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)")))
        before, after = pairs.agg(same).first()[0], small.agg(same).first()[0]
        pairs = small
        if tuple(before) == tuple(after):
            break
    nodes = pairs.selectExpr("high AS node", "low AS root")
    return nodes.union(pairs.selectExpr("low", "low")).groupBy("node").agg(F.min("root").alias("root"))

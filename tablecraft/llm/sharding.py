"""Consistent hashing with bounded loads, as DataFrame operations.

A ring of 64-bit positions is cut into ``cells`` equal cells. Each shard owns
``virtual_nodes`` points on it; a cell belongs to the shard of the next point clockwise. A
row falls in the cell of its key's hash. Shards take their cells in ring order until they
hold their capacity; what is left of a cell (a range of ranks in it) continues clockwise to
the next point whose shard has room. Each round fills at least one shard, so there are at
most as many rounds as shards.

Only counts per cell, at most ``cells`` rows, take part in the rounds; rows meet the
decision once, by cell and rank. A cell holds rows / ``cells`` rows, so no window is ever
over a shard.

Defined results: a null text has size 1 and CRC 0. A null key is hashed by the row's text.
Rows that repeat get different slots. An empty table gives an empty table. Other columns of
the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.shared import settled

CELLS = 1 << 14
VIRTUAL_NODES = 64


def _cell(value: Column, cells: int) -> Column:
    return F.pmod(value, F.lit(cells)).cast("int")


def ring(spark, shards: int, virtual_nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> DataFrame:
    """cell, walk: the shards in the order in which the points after the cell name them.

    A cell that several points hit belongs to the lowest of them by hash.
    """
    points = (
        spark.range(shards)
        .select(F.col("id").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(virtual_nodes - 1))).alias("v"))
        .withColumn("hash", F.xxhash64(F.lit("point"), "shard", "v"))
        .select(F.struct(_cell(F.col("hash"), cells).alias("cell"), "hash", "shard").alias("p"))
        .agg(F.array_sort(F.collect_list("p")).alias("points"))
    )
    laid = points.select(F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), "points")
    at = F.size(F.filter("points", lambda p: p["cell"] < F.col("cell")))
    turned = F.concat(F.slice("points", at + 1, F.size("points")), F.slice("points", F.lit(1), at))
    return laid.select("cell", F.array_distinct(F.transform(turned, lambda p: p["shard"])).alias("walk"))


def assign_segments(counts: DataFrame, shards: int, virtual_nodes: int, cells: int) -> DataFrame:
    """cell, low, high (ranks, end excluded), shard, base (slot of rank ``low``)."""
    spark = counts.sparkSession
    total = counts.agg(F.sum("n")).first()[0] or 0
    room = [total // shards + (s < total % shards) for s in range(shards)]
    waiting = settled(
        counts.join(ring(spark, shards, virtual_nodes, cells), "cell")
        .select("cell", F.lit(0).cast("long").alias("low"), F.col("n").alias("high"), "walk"),
        "cells",
    )
    load, placed = [0] * shards, []
    order = Window.partitionBy("shard").orderBy("cell", "low").rowsBetween(Window.unboundedPreceding, -1)
    for _ in range(shards):
        open_shards = [s for s in range(shards) if load[s] < room[s]]
        if not open_shards:
            break
        capacity = F.element_at(F.array(*[F.lit(r).cast("long") for r in room]), F.col("shard") + 1)
        held = F.element_at(F.array(*[F.lit(x).cast("long") for x in load]), F.col("shard") + 1)
        offered = (
            waiting.withColumn("shard", F.array_intersect("walk", F.array(*[F.lit(s) for s in open_shards]))[0])
            .withColumn("base", held + F.coalesce(F.sum(F.col("high") - F.col("low")).over(order), F.lit(0)))
            .withColumn("cut", F.least("high", F.col("low") + F.greatest(F.lit(0), capacity - F.col("base"))))
        )
        offered = settled(offered, "round")
        placed.append(offered.where("cut > low").select("cell", "low", F.col("cut").alias("high"), "shard", "base"))
        for shard, taken in placed[-1].groupBy("shard").agg(F.sum(F.col("high") - F.col("low"))).collect():
            load[shard] += taken
        waiting = offered.where("cut < high").select("cell", F.col("cut").alias("low"), "high", "walk")
    result = placed[0] if placed else waiting.selectExpr("cell", "low", "high", "walk[0] AS shard", "low AS base").limit(0)
    for more in placed[1:]:
        result = result.unionByName(more)
    return result


def consistent_shards(
    docs: DataFrame,
    shards: int = 8,
    key: str = "doc_id",
    text: str = "text",
    virtual_nodes: int = VIRTUAL_NODES,
    cells: int = CELLS,
) -> DataFrame:
    """key, size, text_crc32, shard, slot: shards hold counts at most one apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("_body"),
    )
    place = F.when(F.col("key").isNull(), F.xxhash64(F.lit("key"), "_body")).otherwise(F.xxhash64(F.lit("key"), "key"))
    rows = rows.withColumn("cell", _cell(place, cells))
    rows = settled(rows, "keys")
    counts = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    segments = assign_segments(counts, shards, virtual_nodes, cells)
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("key", "_body", "size")) - 1
    # At most cells + shards * shards segments of 32 bytes each: a proven bound.
    return (
        rows.withColumn("rank", rank.cast("long"))
        .join(F.broadcast(segments), "cell")
        .where((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .select("key", "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - F.col("low")).alias("slot"))
    )


def op3_consistent_sharding(docs: DataFrame, shards: int = 8) -> DataFrame:
    return consistent_shards(docs, shards).select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

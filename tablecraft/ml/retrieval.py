"""Exact best items by inner product, without scoring all pairs.

Items are sorted by falling norm and cut into blocks. A user's product with any item of a block
is at most |user| times the block's largest norm (Cauchy-Schwarz). The first block, scored for
every user, gives its best items and a kth score; only blocks whose bound reaches that score can
hold better items, and since norms fall these are the first so many blocks. Users with like bounds
are put into blocks together, and a block of users meets just the item blocks that one of its users
needs.

Scoring is a matrix product of two blocks inside a task. Users and items meet by equal block
numbers, so no plan holds a cross join. A task reads the rows of a batch in place, one after the
other, so it holds no more than Spark's batch and one slice of scores. Numbers of blocks by class of
norm, at most 64 rows, tell how many blocks a user needs; they and the first block of items are all
that every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.shared import settled

ITEM_BLOCK, USER_BLOCK = 4096, 4096
#: Users scored at once.
SLICE = 256
#: Classes of norm: steps of the square root of 2, from the largest norm down.
CLASSES = 64

_ITEMS = "part int, place int, n int, ids binary, vectors binary, rank int, norm double"
_FOUND = "user long, item long, score double, k int"


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long vectors as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def item_blocks(items: DataFrame, size: int = ITEM_BLOCK) -> DataFrame:
    """block, ids, vectors, rank, norm (the largest): items by falling norm, ``size`` to a block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, n = 0, [], 0

        def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
            vectors = _vectors(table.column("v"))
            row = {"part": table.column("part")[0].as_py(), "place": place, "n": len(table), "rank": vectors.shape[1]}
            row |= {"ids": table.column("id").to_numpy().astype("<i8").tobytes(), "vectors": vectors.astype("<f8").tobytes()}
            yield pa.RecordBatch.from_pylist([row | {"norm": table.column("norm")[0].as_py()}], schema=_arrow_schema(_ITEMS))

        for batch in batches:
            i = 0
            while i < len(batch):
                part = batch.slice(i, size - n)
                held.append(part)
                n, i = n + len(part), i + len(part)
                if n == size:
                    yield from packed(pa.Table.from_batches(held))
                    place, held, n = place + 1, [], 0
        if n:
            yield from packed(pa.Table.from_batches(held))

    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    order = [F.desc("norm"), F.asc("id")]
    laid = items.withColumn("norm", F.sqrt(squares)).repartitionByRange(*order).sortWithinPartitions(*order)
    cut_up = settled(laid.withColumn("part", F.spark_partition_id()).select("id", "v", "norm", "part").mapInArrow(cut, _ITEMS), "items")
    sizes = cut_up.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    numbered = cut_up.join(before, "part").withColumn("block", (F.col("_before") + F.col("place")).cast("long"))
    return settled(numbered.select("block", "ids", "vectors", "rank", "norm"), "item-blocks")


def _arrow_schema(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))])


def _class_of(norm, largest: float):
    """Class of a norm as a column: 0 for the largest, more for smaller ones."""
    share = F.greatest(F.lit(0.0), norm) / F.lit(largest)
    steps = F.floor(-2 * F.log2(F.greatest(share, F.lit(1e-12))))
    return F.least(F.lit(CLASSES - 1), F.greatest(F.lit(0), steps)).cast("int")


def _best(scores: np.ndarray, ids: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the first ``k`` of each row by score, then by id."""
    order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)
    keep = np.arange(scores.shape[1]) < k[:, None]
    row, column = np.nonzero(keep)
    return row, order[row, column]


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best items of each user of a row, row by row: numbers are read where the batch holds them."""

    def numbers(batch: pa.RecordBatch, column: str, i: int, kind: str) -> np.ndarray:
        return np.frombuffer(batch.column(column)[i].as_buffer(), kind)

    for batch in batches:
        for i in range(len(batch)):
            own = numbers(batch, "vectors", i, "<f8").reshape(-1, batch.column("rank")[i].as_py())
            ids, users = numbers(batch, "ids", i, "<i8"), numbers(batch, "u_ids", i, "<i8")
            k, least = numbers(batch, "u_k", i, "<i4"), numbers(batch, "u_least", i, "<f8")
            vectors = numbers(batch, "u_vectors", i, "<f8").reshape(len(users), -1)
            asking = np.flatnonzero(least <= batch.column("norm")[i].as_py())
            for j in range(0, len(asking), SLICE):
                some = asking[j : j + SLICE]
                scores = vectors[some] @ own.T
                user, place = _best(scores, ids, k[some])
                yield pa.RecordBatch.from_pydict(
                    {"user": users[some][user], "item": ids[place], "score": scores[user, place], "k": k[some][user]}
                )


def _of_later_blocks(spread: DataFrame, blocks: DataFrame, user_block: int) -> DataFrame:
    """user, item, score, k: the best of each block after the first, for users that need it."""

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of up to ``user_block`` users that need as many blocks as any of them."""
        for batch in batches:
            for i in range(0, len(batch), user_block):
                part = batch.slice(i, user_block)
                row = {"ids": part.column("id").to_numpy().astype("<i8").tobytes(), "vectors": _vectors(part.column("v")).astype("<f8").tobytes()}
                row |= {"k": part.column("k").to_numpy().astype("<i4").tobytes(), "least": part.column("least").to_numpy().astype("<f8").tobytes()}
                yield pa.RecordBatch.from_pylist([row | {"blocks": max(part.column("_blocks").to_pylist())}])

    columns = "ids binary, vectors binary, k binary, least binary, blocks long"
    teams = spread.select("id", "v", "k", "least", "_blocks").mapInArrow(grouped, columns).select(
        *[F.col(c).alias(f"u_{c}") for c in ("ids", "vectors", "k", "least")],
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)).alias("block"),
    )
    met = teams.join(blocks, "block").select("ids", "vectors", "rank", "norm", "u_ids", "u_vectors", "u_k", "u_least")
    return met.mapInArrow(_scored, _FOUND)


def best_items(
    users: DataFrame, items: DataFrame, item_block: int = ITEM_BLOCK, user_block: int = USER_BLOCK
) -> DataFrame:
    """user, item, score, rank: the first ``k`` items of each user by score, then by id.

    ``users`` has id (long), v (vector of doubles) and k (int), ``items`` id and v.
    """
    blocks = item_blocks(items, item_block)
    # One row of at most ``item_block`` items: tasks get it with the function, not beside each user.
    first = blocks.where("block = 0").first()
    if first is None:
        return users.sparkSession.createDataFrame([], "user long, item long, score double, rank int")
    largest = first["norm"] or 1.0
    packed, rank = (bytes(first["ids"]), bytes(first["vectors"])), first["rank"]

    def floored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Users with their best items of the first block, and the least norm of an item that can
        still be among their first k."""
        ids, own = np.frombuffer(packed[0], "<i8"), np.frombuffer(packed[1], "<f8").reshape(-1, rank)
        for batch in batches:
            for i in range(0, len(batch), SLICE):
                part = batch.slice(i, SLICE)
                vectors = _vectors(part.column("v"))
                k = part.column("k").to_numpy().astype(np.int64)
                scores = vectors @ own.T
                user, place = _best(scores, ids, k)
                best = scores[user, place]
                ends = np.cumsum(np.bincount(user, minlength=len(k)))
                kth = np.where((k <= len(ids)) & (k > 0), best[np.maximum(ends, 1) - 1] if len(best) else 0.0, -np.inf)
                norm = np.sqrt((vectors**2).sum(1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    least = np.where(norm > 0, kth / norm, 0.0)
                # room for the rounding of products and norms
                least = np.maximum(0.0, least - 1e-9 * largest)
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id"), "v": part.column("v"), "k": part.column("k"), "least": least,
                    "items": pa.ListArray.from_arrays(offsets, ids[place]), "scores": pa.ListArray.from_arrays(offsets, best),
                })

    narrow = users.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"), F.col("k").cast("int").alias("k"))
    begun = "id long, v array<double>, k int, least double, items array<long>, scores array<double>"
    bounded = narrow.mapInArrow(floored, begun)

    # How many blocks have a norm of a class or a larger one: at most CLASSES rows.
    classes = blocks.groupBy(_class_of(F.col("norm"), largest).alias("_class")).agg(F.count(F.lit(1)).alias("n"))
    found = {row["_class"]: row["n"] for row in classes.collect()}
    up_to = np.cumsum([found.get(c, 0) for c in range(CLASSES)]).tolist()
    needed = F.get(F.array(*[F.lit(n) for n in up_to]), _class_of(F.col("least"), largest))
    spread = settled(
        bounded.withColumn("_blocks", needed).repartitionByRange("_blocks", "least", "id").sortWithinPartitions("_blocks", "least", "id"),
        "bounded-users",
    )

    pairs = spread.select(F.col("id").alias("user"), "k", F.explode(F.arrays_zip("items", "scores")).alias("_pair"))
    scores = pairs.select("user", F.col("_pair.items").alias("item"), F.col("_pair.scores").alias("score"), "k")
    if up_to[-1] > 1:
        scores = scores.unionByName(_of_later_blocks(spread.where("_blocks > 1"), blocks, user_block))
    order = Window.partitionBy("user").orderBy(F.desc("score"), F.asc("item"))
    ranked = scores.withColumn("rank", F.row_number().over(order)).where("rank <= k")
    return ranked.select("user", "item", "score", "rank")

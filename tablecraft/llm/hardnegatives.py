"""Hard negatives of vectors by inner product, from a packed R-tree.

1. Rows are laid over range partitions by label, first coordinate and id, and cut into tiles of
   consecutive rows. Inside a tile the sort goes on by the next coordinates (sort-tile-recursive),
   down to leaves of ``LEAF`` rows (more where vectors are wide), and the leaves are packed ``FAN`` to a node. Nodes and tiles
   keep minimum bounding boxes of their vectors and of their labels.
2. A box and an anchor give an interval that holds all their inner products: for each coordinate
   the lower and the upper face, added up. A search takes the nodes of a tile from a queue, best
   upper bound first, for some anchors at once, and prunes for each anchor what has no label it
   asks for, what lies outside its window of scores, and what is strictly below its kth found.
3. Positives are searched first in the anchor's own tile; what the kth found there leaves is
   searched in all other tiles. Windows of negatives follow from the scores of the positives.
   An anchor with all its windows is one row, and is scored once for them. Finds of different
   shelves are merged by rank.

Consecutive tiles make a shelf of bounded size. Shelves and anchors meet by a shuffle on the
shelf: a task holds the tiles of a shelf, as numbers of the least width that holds them, and reads
the anchors past them in blocks of bounded size. An anchor goes only to shelves that its bounds
leave, once to each. Boxes of tiles meet the anchors in the same way, in blocks that each task
reads once. Tiles travel in small pieces, so that no batch of rows is large. Anchors are the stated
one in ``every`` rows. No box, anchor or find reaches the driver.

Scores are exact: components are whole numbers, and sums that a double might round are made with
whole numbers of any size; beyond 64 bits a score is the last number of that range.

Defined results: rows with a null id take no part, as those with a null label or vector or
component, or a component that is not finite (or not once it is scaled). Vectors of different lengths are compared as if
the shorter one ended in zeros; an empty vector has score 0 with all. Equal rows (id, label,
vector) count once; different rows of one id are rows of their own, but no partners of each
other. An anchor without positives, or a positive without negatives, has no rows. An empty table
gives no rows. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.packing import arrow_table, runs
from tablecraft.shared import settled

LEAF, FAN = 64, 16
#: Coordinates for each further LEAF of rows in a leaf, and so many LEAF at most: wide boxes leave nearly all rows anyway.
WIDE, LARGE = 8, 8
#: Rows of a tile: as many as make TILES tiles, within these bounds; and bytes of its vectors as doubles.
TILES, LEAST_ROWS, MOST_ROWS, TILE_BYTES = 1024, 1 << 12, 1 << 16, 8 << 20
#: Bytes of the vectors of a shelf, in two bytes each; where the tiles allow it, as many shelves at least.
SHELF_BYTES, SHELVES = 64 << 20, 24
#: Bytes of the vectors of a piece of a tile, before they are compressed.
PIECE = 4 << 10
#: Bytes of the vectors of a range partition, as doubles; one or more make a shelf.
PART_BYTES = 32 << 20
#: Anchors that meet a tile at once.
ANCHORS = 1 << 10
#: Boxes of tiles that an anchor block meets at once, and anchors for each task that has a block of boxes.
ROOTS, ROUTED = 1 << 10, 1 << 13
#: Scores inside the windows that are looked at together.
HITS = 1 << 16
#: Rows taken for each ask, on average, before they are merged with the best.
WAITING = 4
POSITIVES, NEGATIVES = 5, 10
#: Whole numbers below are exact in their type.
_EXACT = {np.float32: 1 << 24, np.float64: 1 << 53}


# ---- rows -----------------------------------------------------------------------------


def whole_vectors(rows: DataFrame, key: str, label: str, vector: str, scale: int = 256) -> DataFrame:
    """id, label, v: the rows that take part, components as whole numbers floor(scale * x)."""
    out = rows.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    # as doubles: floor() would make a long, which holds less; adding 0 leaves no negative zeros
    floor = F.transform("v", lambda x: x * scale - F.pmod(x * scale, F.lit(1.0)) + 0.0)
    return out.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(finite).select("id", whole.alias("label"), floor.alias("v"))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows of one matrix, short ones filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return _filled(vectors.flatten().to_numpy(zero_copy_only=False), n)


def _filled(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros((len(n), int(n.max(initial=0))), values.dtype)
    out[np.arange(out.shape[1]) < n[:, None]] = values
    return out


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the narrowest type that holds them."""
    least, most = values.min(initial=0), values.max(initial=0)
    for kind in (np.int16, np.int32):
        if -np.iinfo(kind).max <= least and most <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def _coded(vector: np.ndarray) -> bytes:
    """The narrow numbers, after one byte for their type."""
    vector = _narrow(vector)
    return vector.dtype.char.encode() + vector.tobytes()


def _decoded(data: list[bytes]) -> np.ndarray:
    """Vectors as rows of one matrix of doubles, short ones filled with zeros."""
    n = np.array([(len(x) - 1) // np.dtype(x[:1].decode()).itemsize for x in data], np.int64)
    if len({x[:1] for x in data}) == 1:
        values = np.frombuffer(b"".join(x[1:] for x in data), data[0][:1].decode())
    else:
        values = np.concatenate([np.zeros(0), *(np.frombuffer(x[1:], x[:1].decode()) for x in data)])
    return _filled(values.astype(float), n)


def _padded(matrix: np.ndarray, width: int) -> np.ndarray:
    return matrix if matrix.shape[1] == width else np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``, which hold whole numbers;
    in any type that holds them."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = [max(float(x.max()), -float(x.min())) for x in (a, b)]
    bound = max(most[0] * most[1] * a.shape[1], *most)
    for kind, exact in _EXACT.items():
        if bound < exact:
            return a.astype(kind, copy=False) @ b.astype(kind, copy=False).T
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(a) @ exact(b).T, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _within(bounds: np.ndarray, kind: np.dtype) -> np.ndarray:
    """Bounds of scores in the scores' type, with the same scores above and below."""
    most = _EXACT.get(kind.type)
    return bounds[:, None] if most is None else np.clip(bounds, -most, most).astype(kind)[:, None]


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with any vector of each box."""
    above, below = np.maximum(anchors, 0), np.minimum(anchors, 0)
    least, most = above @ low.T + below @ high.T, above @ high.T + below @ low.T
    # room for the rounding of sums beyond 53 bits
    room = (np.abs(least) + np.abs(most) + np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T) * 2.0**-40
    return least - room, most + room


# ---- 1: tiles -------------------------------------------------------------------------

#: Of three kinds: pieces of a tile's rows, anchors with the least score of a positive, and the tile's box.
_PIECE, _ANCHOR, _BOX = 0, 1, 2
_TILE = (
    "kind int, shelf long, tile long, piece int, ids binary, labels binary, vectors binary, width int, "
    "anchor long, id long, label long, v binary, low long, low_box binary, high_box binary, label_low long, label_high long"
)
_press, _unpress = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _pressed(values: np.ndarray) -> bytes:
    """Whole numbers by byte planes, compressed, after one byte for their type."""
    values = np.ascontiguousarray(_narrow(values))
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return values.dtype.char.encode() + _press.compress(planes.tobytes())


def _unpressed(data: bytes) -> np.ndarray:
    kind = np.dtype(data[:1].decode())
    planes = np.frombuffer(_unpress.decompress(data[1:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _leaf_order(vectors: np.ndarray, rows: np.ndarray, axis: int, leaf: int) -> Iterator[np.ndarray]:
    """Rows in runs of ``leaf``, near ones together: slabs by one coordinate, cut by the next."""
    pages = -(-len(rows) // leaf)
    left = vectors.shape[1] - axis
    if pages <= 1 or left <= 0:
        yield rows
        return
    slabs = min(pages, max(2, int(np.ceil(pages ** (1 / min(left, 3))))))
    size = -(-pages // slabs) * leaf
    rows = rows[np.argsort(vectors[rows, axis], kind="stable")]
    for i in range(0, len(rows), size):
        yield from _leaf_order(vectors, rows[i : i + size], axis + 1, leaf)


class Tree:
    """Rows in leaf order, and boxes of leaves and of the nodes over them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        by_label = np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[by_label])) + 1
        order = [part for group in np.split(by_label, cuts) for part in _leaf_order(vectors, group, 1, leaf)]
        rows = np.concatenate(order) if len(ids) else by_label
        self.ids, self.labels, self.vectors = ids[rows], labels[rows], vectors[rows]
        starts = np.arange(0, len(rows), leaf)
        self.leaf = leaf
        low, high, *of_labels = self._boxes(starts, self.vectors, self.vectors, self.labels, self.labels)
        self.levels = [(low.astype(float), high.astype(float), *of_labels)]
        self.fan = fan
        while len(self.levels[-1][0]) > 1:
            under = self.levels[-1]
            self.levels.append(self._boxes(np.arange(0, len(under[0]), fan), *under))

    @staticmethod
    def _boxes(starts, low, high, label_low, label_high):
        return (
            np.minimum.reduceat(low, starts),
            np.maximum.reduceat(high, starts),
            np.minimum.reduceat(label_low, starts),
            np.maximum.reduceat(label_high, starts),
        )

    def below(self, level: int, node: int) -> range:
        """Children of a node, or rows of a leaf."""
        size = self.leaf if level == 0 else self.fan
        n = len(self.ids) if level == 0 else len(self.levels[level - 1][0])
        return range(node * size, min(n, (node + 1) * size))


class Search:
    """The best rows of trees for each of some asks.

    An ask is an anchor's, for its own label or for all others, for scores in its window, and for
    rows that are not its own id; of these it keeps the first ``k`` by score, then by id. Asks of
    one anchor that follow each other are scored once.
    """

    def __init__(self, ids, labels, vectors, same: bool, low, high, floor, k: int):
        first = np.ones(len(ids), bool)
        first[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (vectors[1:] != vectors[:-1]).any(1)
        self._start(ids[first], labels[first], vectors[first], same, np.flatnonzero(first), low, high, floor, k)

    @classmethod
    def of_anchors(cls, ids, labels, vectors, same: bool, n: np.ndarray, low, high, k: int) -> Search:
        """``n`` asks of each anchor, one or more."""
        search = cls.__new__(cls)
        search._start(ids, labels, vectors, same, np.cumsum(n) - n, low, high, low, k)
        return search

    def _start(self, ids, labels, vectors, same, starts, low, high, floor, k):
        self.ids, self.labels, self.vectors, self.same, self.k = ids, labels, vectors, same, k
        #: first ask of each anchor, and number of its asks
        self.starts, self.asks = starts, np.diff(starts, append=len(low))
        self.high = high
        #: scores strictly below are of no use, nor are larger ids that have this score
        self.kth, self.kth_id = np.maximum(low, floor), np.full(len(low), np.iinfo(np.int64).max)
        #: what is found for each ask, best first: so many, with these scores and ids
        self.n = np.zeros(len(low), np.int64)
        self.taken: list[tuple[np.ndarray, ...]] = []
        self.scores, self.partners = (np.zeros((len(low), k), np.int64) for _ in range(2))
        self.highest = np.maximum.reduceat(high, starts) if len(starts) else high
        self._bound()

    def _bound(self) -> None:
        self.least = np.minimum.reduceat(self.kth, self.starts) if len(self.starts) else self.kth

    @property
    def found(self) -> list[list[tuple[int, int]]]:
        """Score and id of the rows found for each ask, best first."""
        return [list(zip(s[:n].tolist(), p[:n].tolist())) for n, s, p in zip(self.n, self.scores, self.partners)]

    def run(self, tree: Tree) -> None:
        width = max(self.vectors.shape[1], tree.vectors.shape[1])
        anchors, rows = _padded(self.vectors, width), _padded(tree.vectors, width)
        levels = [(_padded(low, width), _padded(high, width), a, b) for low, high, a, b in tree.levels]
        # once for all leaves, in the type in which they are scored
        most = [np.abs(anchors).max(initial=0), max(np.abs(x).max(initial=0) for x in levels[-1][:2])]
        scored = anchors.astype(np.float32) if max(most[0] * most[1] * width, *most) < _EXACT[np.float32] else anchors
        top = len(levels) - 1
        queue: list[tuple] = []

        def push(level: int, nodes: range, asking: np.ndarray) -> None:
            low, high, label_low, label_high = levels[level]
            part = slice(nodes.start, nodes.stop)
            least, most = intervals(anchors[asking], low[part], high[part])
            for i, node in enumerate(nodes):
                heapq.heappush(queue, (-float(most[:, i].max(initial=-np.inf)), level, node, asking, least[:, i], most[:, i]))

        push(top, range(len(levels[top][0])), np.arange(len(anchors)))
        while queue:
            _, level, node, asking, least, most = heapq.heappop(queue)
            box = levels[level][2][node], levels[level][3][node]
            # only now, with what has been found since the node was queued
            labels = self.labels[asking]
            fits = (box[0] <= labels) & (labels <= box[1]) if self.same else (box[0] != labels) | (box[1] != labels)
            asking = asking[fits & (least <= self.highest[asking]) & (most >= self.least[asking])]
            if not len(asking):
                continue
            if level:
                push(level - 1, tree.below(level, node), asking)
                continue
            inside = slice(tree.below(0, node).start, tree.below(0, node).stop)
            score = products(scored if len(asking) == len(scored) else scored[asking], rows[inside])
            hit = score >= _within(self.least[asking], score.dtype)
            hits = _places(hit)
            if len(hits) > score.size >> 6:
                hits = _places(hit & (score <= _within(self.highest[asking], score.dtype)))
            for i in range(0, len(hits), HITS):
                self._take(asking, score, hits[i : i + HITS], tree.ids[inside], tree.labels[inside])
        self._merge()

    def _take(self, asking: np.ndarray, score: np.ndarray, hits: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Rows of a leaf into the finds of all asks whose windows they are in."""
        i, j = np.divmod(hits, score.shape[1])
        anchor = asking[i]
        fits = ((labels[j] == self.labels[anchor]) == self.same) & (ids[j] != self.ids[anchor])
        anchor, score, ids = anchor[fits], score[i[fits], j[fits]].astype(np.int64), ids[j[fits]]
        n = self.asks[anchor]
        which = np.repeat(np.arange(len(anchor)), n)
        ask = np.repeat(self.starts[anchor] - (np.cumsum(n) - n), n) + np.arange(len(which))
        score, ids = score[which], ids[which]
        kth = self.kth[ask]
        fits = (score <= self.high[ask]) & ((score > kth) | ((score == kth) & (ids <= self.kth_id[ask])))
        self.taken.append((ask[fits], score[fits], ids[fits]))
        if sum(len(x[0]) for x in self.taken) > WAITING * len(self.n):
            self._merge()

    def _merge(self) -> None:
        """What was taken, into the best of each ask."""
        ask, score, ids = (np.concatenate(x) for x in zip(*self.taken)) if self.taken else [np.zeros(0, np.int64)] * 3
        self.taken = []
        if not len(ask):
            return
        seen = np.zeros(len(self.n), bool)
        seen[ask] = True
        held = np.flatnonzero(seen)
        of, place = np.nonzero(np.arange(self.k) < self.n[held][:, None])
        ask = np.concatenate([ask, held[of]])
        score, ids = np.concatenate([score, self.scores[held[of], place]]), np.concatenate([ids, self.partners[held[of], place]])
        order, rank = _ranked(ids, score, ask)
        order, rank = order[rank < self.k], rank[rank < self.k]
        ask = ask[order]
        self.scores[ask, rank], self.partners[ask, rank] = score[order], ids[order]
        self.n[held] = 0
        np.maximum.at(self.n, ask, rank + 1)
        full = held[self.n[held] == self.k]
        self.kth[full], self.kth_id[full] = self.scores[full, -1], self.partners[full, -1]
        self._bound()


def _places(hit: np.ndarray) -> np.ndarray:
    """``np.flatnonzero`` of a matrix, quicker where few are set."""
    hit = hit.ravel()
    if hit.size % 8:
        return np.flatnonzero(hit)
    eights = np.flatnonzero(hit.view(np.uint64))
    which, place = np.nonzero(hit.reshape(-1, 8)[eights])
    return eights[which] * 8 + place


def _ranked(ids: np.ndarray, score: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of the keys (the last one first), then best first; and the rank within equal keys."""
    most = int(score.max(initial=0))
    if len(keys) == 1 and len(score) and most - int(score.min()) < 1 << 40 and 0 <= keys[0].min() and keys[0].max() < 1 << 22:
        # one number to sort by; then only equal ones by their ids
        number = (keys[0] << 40) + (most - score)
        order = np.argsort(number)
        number = number[order]
        equal = np.zeros(len(order) + 1, bool)
        equal[1:-1] = number[1:] == number[:-1]
        tied = np.flatnonzero(equal[1:] | equal[:-1])
        order[tied] = order[tied][np.lexsort((ids[order[tied]], number[tied]))]
    else:
        order = np.lexsort((ids, ~score, *keys))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([key[order][1:] != key[order][:-1] for key in keys])
    starts = np.flatnonzero(new)
    return order, np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))


def _leaf(width: int) -> int:
    return LEAF * min(LARGE, max(1, width // WIDE))


def _own_floors(tree: Tree, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """The score of the kth row of each anchor's label in its own tile, the least number if there are fewer."""
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    out = np.full(len(ids), least)
    for i in range(0, len(ids), ANCHORS):
        part = slice(i, i + ANCHORS)
        n = np.ones(len(ids[part]), np.int64)
        search = Search.of_anchors(ids[part], labels[part], vectors[part], True, n, least * n, np.full(len(n), most), k)
        search.run(tree)
        out[part] = np.where(search.n == k, search.scores[:, -1], least)
    return out


def _tiles(rows: DataFrame, size: int, shelves: int, parts: int, every: int, k: int) -> DataFrame:
    """Tiles in pieces, their boxes, and the anchors with the score of the kth row of their label
    in their own tile. ``parts`` range partitions make a shelf, or more shelves if they are large."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        n = width = tiles = anchors = filled = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal held, n, width, tiles, anchors, filled
            of = pa.Table.from_batches(held)
            held, n, width = [], 0, 0
            vectors, ids, labels = _matrix(of.column("v")), of.column("id").to_numpy(), of.column("label").to_numpy()
            at = np.flatnonzero(ids % every == 0)
            low = _own_floors(Tree(ids, labels, vectors, _leaf(vectors.shape[1])), ids[at], labels[at], vectors[at], k) if len(at) else []
            out = []
            for a, floor in zip(at, low):
                row = {"kind": _ANCHOR, "anchor": (part << 40) + anchors, "id": int(ids[a]), "label": int(labels[a]), "low": int(floor)}
                out.append(row | {"v": _coded(vectors[a])})
                anchors += 1
            tile = {"tile": (part << 32) + tiles, "shelf": (part // parts << 24) + filled * parts // (2 * SHELF_BYTES), "width": vectors.shape[1]}
            box = {"low_box": vectors.min(0).astype("<f8").tobytes(), "high_box": vectors.max(0).astype("<f8").tobytes()}
            out.append(tile | box | {"kind": _BOX, "label_low": int(labels.min()), "label_high": int(labels.max())})
            vectors = _narrow(vectors)
            step = max(1, PIECE // max(1, vectors.shape[1] * vectors.itemsize))
            for i in range(0, len(ids), step):
                piece = {name: _pressed(x[i : i + step]) for name, x in (("ids", ids), ("labels", labels), ("vectors", vectors))}
                out.append(tile | piece | {"kind": _PIECE, "piece": i})
            tiles, filled = tiles + 1, filled + vectors.nbytes
            return iter(arrow_table(_TILE, out).to_batches())

        for batch in batches:
            widest = int(batch.column("v").value_lengths().to_numpy(zero_copy_only=False).max(initial=0))
            i = 0
            while i < len(batch):
                most = min(size, max(1, TILE_BYTES // (8 * max(1, width, widest))))
                if n and n >= most:
                    yield from packed()
                    continue
                held.append(batch.slice(i, most - n))
                n, i, width = n + len(held[-1]), i + len(held[-1]), max(width, widest)
        if n:
            yield from packed()

    order = [F.col("label"), F.col("_first"), F.col("id")]
    # equal rows have equal keys, and so one range: they are dropped there without a shuffle of their own
    laid = rows.withColumn("_first", F.try_element_at("v", F.lit(1))).repartitionByRange(shelves * parts, *order).dropDuplicates()
    return laid.sortWithinPartitions(*order).select("id", "label", "v").mapInArrow(cut, _TILE)


# ---- 2: anchors meet tiles ------------------------------------------------------------

#: An anchor and the windows of scores that it asks for, each named by ``positive``.
_ASKS = "anchor long, id long, label long, v binary, positive array<long>, low array<long>, high array<long>"
_ASK = [c.split(" ")[0] for c in _ASKS.split(", ")]


class _Asks:
    """Anchors of a batch; ``n`` windows of each follow each other in ``positive``, ``low`` and ``high``."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids, self.labels = (batch.column(name).to_numpy() for name in ("id", "label"))
        self.vectors = _decoded(batch.column("v").to_pylist())
        self.n = batch.column("low").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.positive, self.low, self.high = (batch.column(name).flatten().to_numpy() for name in ("positive", "low", "high"))


def _for_tiles(asks: DataFrame, tiles: DataFrame, same: bool) -> DataFrame:
    """``asks`` with the shelves that their bounds leave.

    Boxes of tiles are put into blocks, those of a shelf into one; each block meets all asks, in
    tasks that have the block once and a part of the asks.
    """
    columns = ["shelf", "width", "low_box", "high_box", "label_low", "label_high"]
    roots = tiles.where(F.col("kind") == _BOX).select(F.lit(0).alias("kind"), *columns)
    blocks, salts = max(1, -(-roots.count() // ROOTS)), max(1, -(-asks.count() // ROUTED))

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    def one_of(n: int, key: str):
        return F.pmod(F.xxhash64(key), F.lit(n).cast("long"))

    boxes = roots.withColumn("_block", one_of(blocks, "shelf")).withColumn("_salt", all_of(salts))
    spread = asks.select(F.lit(1).alias("kind"), *_ASK).withColumn("_salt", one_of(salts, "anchor")).withColumn("_block", all_of(blocks))
    both = boxes.unionByName(spread, allowMissingColumns=True)

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, boxes = None, [], None
        for batch in batches:
            for (*own, kind), part in _runs(batch, ["_block", "_salt", "kind"]):
                if kind == 0:
                    if own != cell:
                        cell, held = own, []
                    held += part.select(columns).to_pylist()
                    boxes = None
                elif own == cell:
                    boxes = boxes or _stacked(held)
                    for i in range(0, len(part), ANCHORS // 4):
                        some = part.slice(i, ANCHORS // 4)
                        which, shelf = _left(_Asks(some), *boxes, same)
                        yield some.select(_ASK).take(pa.array(which)).append_column("shelf", pa.array(shelf, pa.int64()))

    ordered = both.repartition(blocks * salts, "_block", "_salt").sortWithinPartitions("_block", "_salt", "kind", "shelf")
    return ordered.mapInArrow(left, f"{_ASKS}, shelf long")


def _runs(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[list[int], pa.RecordBatch]]:
    """Rows of a batch that follow each other with the same numbers, and these."""
    values = np.stack([batch.column(name).to_numpy() for name in names])
    cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(0)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(batch)]):
        if b > a:
            yield values[:, a].tolist(), batch.slice(a, b - a)


def _stacked(boxes: list[dict]) -> tuple[np.ndarray, ...]:
    """Shelves of boxes, in order, lower and upper corners, and least and greatest labels."""
    n = np.array([box["width"] for box in boxes])
    low, high = (_filled(np.frombuffer(b"".join(box[side] for box in boxes), "<f8"), n) for side in ("low_box", "high_box"))
    return *(np.array([box[name] for box in boxes]) for name in ("shelf", "label_low", "label_high")), low, high


def _left(ask: _Asks, shelf, label_low, label_high, low, high, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of anchors and the shelves that hold a box that their bounds leave."""
    width = max(ask.vectors.shape[1], low.shape[1])
    least, most = intervals(_padded(ask.vectors, width), _padded(low, width), _padded(high, width))
    label, starts = ask.labels[:, None], np.cumsum(ask.n) - ask.n
    fits = (label_low <= label) & (label <= label_high) if same else (label_low != label) | (label_high != label)
    fits &= (least <= np.maximum.reduceat(ask.high, starts)[:, None]) & (most >= np.minimum.reduceat(ask.low, starts)[:, None])
    first = runs(shelf)
    which, at = np.nonzero(np.logical_or.reduceat(fits, first, axis=1))
    return which, shelf[first][at]


_FOUND = "anchor long, bytes int, found binary"


def _searched(asks: DataFrame, tiles: DataFrame, shelves: int, same: bool, k: int) -> DataFrame:
    """The first ``k`` of each shelf for every window of the anchors that go to it: name of the
    window, partner and score, as numbers of so many bytes."""
    columns = ["tile", "ids", "labels", "vectors", "width"]
    pieces = tiles.where(F.col("kind") == _PIECE).select("shelf", F.lit(0).alias("kind"), "piece", *columns)
    both = pieces.unionByName(asks.select("shelf", F.lit(1).alias("kind"), *_ASK), allowMissingColumns=True)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, trees, tile, held = None, [], None, []

        def whole() -> None:
            """The pieces that are held make a tile."""
            if held:
                ids, labels, vectors = (np.concatenate(x) for x in zip(*held))
                trees.append(Tree(ids, labels, vectors, _leaf(vectors.shape[1])))
                held.clear()

        for batch in batches:
            for (shelf, kind), part in _runs(batch, ["shelf", "kind"]):
                if kind == 0:
                    if shelf != own:
                        held.clear()
                        trees.clear()
                        own, tile = shelf, None
                    for row in zip(*(part.column(name) for name in columns)):
                        number, ids, labels, vectors, width = (x.as_py() for x in row)
                        if number != tile:
                            whole()
                            tile = number
                        ids = _unpressed(ids)
                        held.append((ids, _unpressed(labels), _unpressed(vectors).reshape(len(ids), width)))
                    continue
                whole()
                assert shelf == own
                for i in range(0, len(part), ANCHORS):
                    some = part.slice(i, ANCHORS)
                    ask = _Asks(some)
                    search = Search.of_anchors(ask.ids, ask.labels, ask.vectors, same, ask.n, ask.low, ask.high, k)
                    for tree in trees:
                        search.run(tree)
                    yield from _finds(some.column("anchor"), ask, search)

    # a number of its own: shelves are few and heavy, and must not be put together
    ordered = both.repartition(2 * shelves, "shelf").sortWithinPartitions("shelf", "kind", "tile", "piece")
    return ordered.mapInArrow(searched, _FOUND)


def _finds(anchors: pa.Array, ask: _Asks, search: Search) -> Iterator[pa.RecordBatch]:
    of, place = np.nonzero(np.arange(search.k) < search.n[:, None])
    if len(of):
        n = np.add.reduceat(search.n, search.starts)
        rows = _narrow(np.stack([ask.positive[of], search.partners[of, place], search.scores[of, place]], 1))
        ends = np.concatenate([[0], np.cumsum(n[n > 0])]) * (3 * rows.itemsize)
        found = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(rows.tobytes())])
        size = pa.array(np.full(len(found), rows.itemsize, np.int32))
        yield pa.RecordBatch.from_arrays([anchors.filter(pa.array(n > 0)), size, found], ["anchor", "bytes", "found"])


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of all shelves for each anchor and window, with their rank."""

    def numbers(batch: pa.RecordBatch) -> np.ndarray:
        """anchor, positive, partner, score"""
        out = []
        sizes = batch.column("bytes").to_numpy()
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            data = part.column("found").to_pylist()
            rows = np.frombuffer(b"".join(data), f"i{size}").reshape(-1, 3).astype(np.int64)
            anchors = np.repeat(part.column("anchor").to_numpy(), [len(x) // (3 * size) for x in data])
            out.append(np.column_stack([anchors, rows]))
        return np.concatenate(out)

    def ranked(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        anchor, positive, partner, score = rows.T
        order, rank = _ranked(partner, score, positive, anchor)
        order, rank = order[rank < k], rank[rank < k]
        columns = [*rows[order].T, (rank + 1).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], ["anchor", "positive", "partner", "score", "rank"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros((0, 4), np.int64)
        for batch in batches:
            for i in range(0, len(batch), ANCHORS):
                rows = np.concatenate([rest, numbers(batch.slice(i, ANCHORS))])
                # more of the last anchor may follow
                last = rows[:, 0] == rows[:, 0].max()
                rest = rows[last]
                if not last.all():
                    yield from ranked(rows[~last])
        if len(rest):
            yield from ranked(rest)

    ordered = found.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(merged, "anchor long, positive long, partner long, score long, rank int")


# ---- 3: positives, then negatives -----------------------------------------------------


def hard_negatives(
    rows: DataFrame,
    window: Callable,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    tile_rows: int | None = None,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has id, label and v (whole numbers as doubles). ``window`` makes the least and the
    greatest score of a negative from the column of the positive's score.
    """
    rows = settled(rows, "vectors")
    n, cells = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("v")), F.lit(0))).first()
    if tile_rows is None:
        tile_rows = min(MOST_ROWS, max(LEAST_ROWS, -(-n // TILES)))
    shelves = max(1, -(-2 * cells // SHELF_BYTES), min(SHELVES, -(-n // tile_rows)))
    tiles = settled(_tiles(rows, tile_rows, shelves, max(1, 8 * cells // (shelves * PART_BYTES)), every, positives), "tiles")

    def searched(asks: DataFrame, same: bool, k: int) -> DataFrame:
        return _first(_searched(_for_tiles(asks, tiles, same), tiles, shelves, same, k), k)

    anchors = tiles.where(F.col("kind") == _ANCHOR).select("anchor", "id", "label", "v", "low")
    # one window without a name, from the floor up
    any_score = {"positive": F.lit(0).cast("long"), "low": F.col("low"), "high": F.lit((1 << 63) - 1)}
    asks = anchors.withColumns({name: F.array(x) for name, x in any_score.items()})
    best = settled(searched(asks, True, positives), "positives")
    low, high = window(F.col("score"))
    wanted = best.select("anchor", F.struct(F.col("partner").alias("positive"), low.cast("long").alias("low"), high.cast("long").alias("high")).alias("w"))
    windows = wanted.where("w.low <= w.high").groupBy("anchor").agg(F.collect_list("w").alias("w"))
    asks = settled(windows.join(anchors.drop("low"), "anchor").select("anchor", "id", "label", "v", "w.positive", "w.low", "w.high"), "windows")
    scores = best.join(anchors.select("anchor", "id"), "anchor").select("anchor", "id", F.col("partner").alias("positive"), F.col("score").alias("positive_score"))
    return searched(asks, False, negatives).join(scores, ["anchor", "positive"]).select(
        F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("partner").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(
    rows: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding", tile_rows: int | None = None
) -> DataFrame:
    """The first 10 negatives whose score is 30 to 90 % of the positive's, for each anchor and each
    of its first 5 positives."""

    def window(score):
        # whole numbers: ceil(30 p / 100) and floor(90 p / 100)
        p = score.cast("decimal(38,0)")
        return F.ceil(p * 30 / 100), F.floor(p * 90 / 100)

    return hard_negatives(whole_vectors(rows, key, label, vector), window, tile_rows=tile_rows)


OP13_SQL = """
    WITH rows AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
            list_inner_product(a.v, b.v)::BIGINT AS score
        FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
        other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
"""

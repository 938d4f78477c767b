"""N-gram Jaccard join by MinHash banding, with every link verified on the full sets.

1. Each text becomes the set of its word ``WIDTH``-grams (as 64-bit hashes). Texts of equal
   sets form a class; its least id stands for it. Only classes go on, so a group of copies
   of any size is one row.
2. Bands and rows are chosen so that a pair at the threshold shares a band with the target
   recall. Classes meet in buckets of equal band hashes. Buckets of the same members in
   several bands are one bucket. Large buckets are cut into blocks and every pair of blocks
   is a group of its own, so no task holds more than two blocks.
3. Inside a group the intersections of all sets are counted at once by a matrix product over
   shared n-grams. A pair counts only in the first band in which it meets, so a link is
   counted once. What leaves a group is linear in its members: for every class its number
   of linked documents, and one edge to the least class that it is linked with.
4. Components of those edges are the near-duplicate groups.

Defined results: a text of one to four words is one n-gram of all its words; an empty or
null text has no n-grams, is in a group of its own and has no links. A row with a null id
takes part under a negative id made from its text, and comes back with the null. Rows that
repeat count as copies; rows that repeat an id with another text are documents of their own.
An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.columns import beside_others
from tablecraft.llm.components import components
from tablecraft.llm.textblocks import Block, blocks, mix
from tablecraft.shared import settled

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.9995
MOST_HASHES = 128
BLOCK = 512
_ODD = np.random.default_rng(7).integers(0, 1 << 63, MOST_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """The most rows a band for which few enough bands still reach the recall at the threshold."""
    best = (most, 1)
    for rows in range(1, 17):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def ngram_sets(block: Block, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and text numbers of the distinct n-grams, ordered by text and hash."""
    words = block.word_hashes()
    grams, at = block.windows(words, width)
    text = block.word_text[at]
    counts = block.n_words
    first = np.cumsum(counts) - counts
    for n in range(1, width):  # texts shorter than an n-gram
        short = np.flatnonzero(counts == n)
        if len(short):
            value = words[first[short]].copy()
            for k in range(1, n):
                value = mix(value * np.uint64(3) + words[first[short] + k])
            grams, text = np.concatenate([grams, value + np.uint64(n)]), np.concatenate([text, short])
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], text[new]


def _signatures(block: Block, bands: int, rows: int) -> tuple[np.ndarray, ...]:
    grams, text = ngram_sets(block)
    n = block.n_texts
    sizes = np.bincount(text, minlength=n)
    filled = np.flatnonzero(sizes)
    first = (np.cumsum(sizes) - sizes)[filled]
    prints = np.zeros((n, 2), np.uint64)
    keys = np.zeros((n, bands), np.uint64)
    if len(filled):
        prints[filled, 0] = np.add.reduceat(mix(grams), first)
        prints[filled, 1] = np.add.reduceat(mix(grams ^ np.uint64(0x5DEECE66D)), first)
        for band in range(bands):
            key = np.full(len(filled), band, np.uint64)
            for k in range(rows):
                key = mix(key + np.minimum.reduceat(grams * _ODD[band * rows + k], first))
            keys[filled, band] = key
    return sizes, prints, keys


def class_rows(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """key, id, body and, of every text, print_a, print_b (of its set), n_grams, keys (by band)."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                sizes, prints, keys = _signatures(block, bands, rows)
                offsets = np.arange(block.n_texts + 1, dtype=np.int32) * bands
                yield pa.RecordBatch.from_pydict(
                    {
                        **{c: batch.column(c).slice(block.first, block.n_texts) for c in ("key", "id", "body")},
                        "print_a": prints[:, 0].view(np.int64),
                        "print_b": prints[:, 1].view(np.int64),
                        "n_grams": sizes,
                        "keys": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64))),
                    }
                )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "id", "body", "text").mapInArrow(
        signed, f"key {kind}, id long, body long, print_a long, print_b long, n_grams long, keys array<long>"
    )


def _common(grams: np.ndarray, owner: np.ndarray, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Sizes of the intersections of the sets of ``a`` with those of ``b``."""
    _, place, count = np.unique(grams, return_inverse=True, return_counts=True)
    shared = count[place] > 1
    place, owner = place[shared], owner[shared]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    columns = np.zeros(len(place), np.int64)
    columns[1:] = np.cumsum(place[1:] != place[:-1])
    row_a, row_b = np.full(n, -1), np.full(n, -1)
    row_a[a], row_b[b] = np.arange(len(a)), np.arange(len(b))
    common = np.zeros((len(a), len(b)), np.float32)
    step = max(64, (1 << 21) // max(1, n))  # strips of at most 8 MB
    for low in range(0, int(columns[-1]) + 1 if len(columns) else 0, step):
        lo, hi = np.searchsorted(columns, [low, low + step])
        who, where = owner[lo:hi], columns[lo:hi] - low
        strips = []
        for rows, m in ((row_a, len(a)), (row_b, len(b))):
            strip = np.zeros((m, step), np.float32)
            inside = rows[who] >= 0
            strip[rows[who[inside]], where[inside]] = 1
            strips.append(strip)
        common += strips[0] @ strips[1].T
    return common


def _verified(threshold: float):
    def links(key, table):
        band, left, right = key[0].as_py(), key[2].as_py(), key[3].as_py()
        names, side = table.column("node").to_numpy(), table.column("part").to_numpy()
        weight = table.column("n_docs").to_numpy()
        keys = np.array(table.column("keys").combine_chunks().flatten()).reshape(len(names), -1)
        parts = [(g, t + block.first) for block in blocks(table.column("text")) for g, t in [ngram_sets(block)]]
        grams, owner = (np.concatenate(x) for x in zip(*parts))
        sizes = np.bincount(owner, minlength=len(names))
        a, b = np.flatnonzero(side == left), np.flatnonzero(side == right)
        common = _common(grams, owner, a, b, len(names))
        union = sizes[a][:, None] + sizes[b][None, :] - common
        linked = common >= threshold * union - 1e-6
        if left == right:
            np.fill_diagonal(linked, False)
        for earlier in range(band):  # pairs that meet in an earlier band count there
            linked &= keys[a, earlier][:, None] != keys[b, earlier][None, :]
        linked &= keys[a, band][:, None] == keys[b, band][None, :]
        n_links = np.zeros(len(names), np.int64)
        label = np.arange(len(names))
        sides = [(a, b, linked)] if left == right else [(a, b, linked), (b, a, linked.T)]
        for own, other, flags in sides:
            n_links[own] += flags @ weight[other]
        while True:  # the least name reached through the links of this group
            before = label.copy()
            for own, other, flags in sides:
                reached = np.where(flags, label[other][None, :], len(names)).min(axis=1, initial=len(names))
                label[own] = np.minimum(label[own], reached)
            label = label[label]
            if (label == before).all():
                break
        some = n_links > 0
        return pa.table({"node": names[some], "n_links": n_links[some], "partner": names[label[some]]})

    return links


def _buckets(classes: DataFrame, block: int) -> DataFrame:
    """band, hash, node, part, n_parts: the classes of each bucket that is looked at."""
    met = classes.select("node", F.posexplode("keys").alias("band", "hash"))
    buckets = (
        met.groupBy("band", "hash")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who"))
        .where("n > 1")
        .groupBy("n", "who")
        .agg(F.min(F.struct("band", "hash")).alias("first"))
        .select("first.band", "first.hash", F.ceil(F.col("n") / block).cast("int").alias("n_parts"))
    )
    part = F.pmod(F.xxhash64(F.lit("part"), "node"), F.col("n_parts")).cast("int")
    return met.join(buckets, ["band", "hash"]).withColumn("part", part)


def jaccard_groups(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block: int = BLOCK,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: key, body (hash of the text), class_id, group_id,
    first_body, n_copies, n_links.

    class_id: least id of the texts with the same set. group_id and first_body: the least id
    of the connected group, and the hash of its text. n_links: other documents within the
    threshold, copies included.
    """
    bands, rows = choose_bands(threshold, recall)
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(whole).alias("body"), whole.alias("text")).withColumn(
        "id", F.coalesce(F.col("key").cast("long"), F.lit(-1) - F.abs(F.col("body") % F.lit(1 << 61)))
    )
    signed = settled(class_rows(texts, bands, rows), "signatures")
    prints = ["print_a", "print_b"]
    classes = settled(
        signed.where("n_grams > 0")
        .groupBy(*prints)
        .agg(F.min(F.struct("id", "body")).alias("first"), F.count(F.lit(1)).alias("n_docs"), F.first("keys").alias("keys"))
        .withColumn("node", F.xxhash64(*prints)),
        "classes",
    )
    members = settled(_buckets(classes, block), "members")
    wanted = members.select("node").distinct().join(classes.select("node", "first.id", "first.body", "n_docs", "keys"), "node")
    held = texts.select("id", "body", "text").join(wanted, ["id", "body"]).dropDuplicates(["node"])
    held = settled(held.select("node", "text", "n_docs", "keys"), "texts")
    cells = F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))
    placed = members.select("band", "hash", "node", "part", cells.alias("other")).select(
        "band", "hash", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right"), "node", "part"
    )
    found = settled(
        placed.join(held, "node")
        .groupBy("band", "hash", "left", "right")
        .applyInArrow(_verified(threshold), "node long, n_links long, partner long"),
        "links",
    )
    linked = found.groupBy("node").agg(F.sum("n_links").alias("linked"))
    roots = components(found.select(F.col("node").alias("a"), F.col("partner").alias("b")))
    rooted = classes.drop("keys").join(linked, "node", "left").join(roots, "node", "left")
    rooted = settled(rooted.withColumn("root", F.coalesce("root", "node")), "roots")
    groups = rooted.groupBy("root").agg(F.min("first").alias("group"))
    known = rooted.join(groups, "root").select(
        *prints,
        F.col("first.id").alias("class_id"),
        F.col("group.id").alias("group_id"),
        F.col("group.body").alias("first_body"),
        F.col("n_docs").alias("n_copies"),
        (F.col("n_docs") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
    )
    with_sets = signed.where("n_grams > 0").select("key", "body", *prints).join(known, prints).drop(*prints)
    without = signed.where("n_grams = 0").select(
        "key",
        "body",
        F.col("id").alias("class_id"),
        F.col("id").alias("group_id"),
        F.col("body").alias("first_body"),
        F.lit(1).cast("long").alias("n_copies"),
        F.lit(0).cast("long").alias("n_links"),
    )
    return with_sets.unionByName(without)


def op6_jaccard_join(docs: DataFrame) -> DataFrame:
    return jaccard_groups(docs).select(
        F.col("key").alias("doc_id"), "class_id", "group_id", "n_copies", "n_links"
    )


def near_duplicate_stage(docs: DataFrame) -> DataFrame:
    """One document of each near-duplicate group: the one of least id (then text hash).

    Documents without words are in no group and stay. Rows that repeat whole ids and texts
    are one document. Other columns stay as they are, whatever they are called.
    """
    return beside_others(docs, ("doc_id", "text"), _one_of_each)


def _one_of_each(docs: DataFrame) -> DataFrame:
    groups = jaccard_groups(docs)
    whole = F.coalesce("text", F.lit(""))
    own = docs.withColumn("_body", F.xxhash64(whole)).withColumn(
        "_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1) - F.abs(F.col("_body") % F.lit(1 << 61)))
    )
    keepers = settled(groups.select(F.col("group_id").alias("_id"), F.col("first_body").alias("_body")).distinct(), "keepers")
    return own.join(keepers, ["_id", "_body"], "left_semi").dropDuplicates(["_id", "_body"]).drop("_id", "_body")

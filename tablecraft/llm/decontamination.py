"""Benchmark passages in documents, by SimHash windows, as DataFrame operations only.

Words are lower-cased runs without white space; shingles are ``WIDTH`` words. A window of a
document has as many words as the item that it is compared with; a document of fewer words is
one window.

1. Windows and items that have a weighted Jaccard similarity of ``THRESHOLD`` hold a known
   number of equal shingles, so all windows are looked at that hold so many shingles of the
   item, wherever they stand; this loses nothing. The shingles of the items are broadcast if
   their number is at most ``broadcast_shingles``, else joined by a shuffle. Bitmaps of the
   documents with such windows keep the other texts out of the shuffle that brings texts and
   windows together.
2. Windows and items get a SimHash of 256 bits, each shingle weighted by its occurrences. Its
   distance is told and decides nothing: short windows exceed any radius at times.
3. Pairs are verified by the exact weighted Jaccard similarity (sum of least occurrences / sum
   of greatest), and the best window of each document and item is kept if it reaches the
   threshold.

Defined results: null and empty texts match nothing, nor do items of fewer than ``WIDTH``
words. Rows that repeat give one result. A null id comes back as null. Items that repeat are
matched each. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.columns import beside_others
from tablecraft.shared import settled

WIDTH = 5
THRESHOLD = 0.8
BROADCAST_SHINGLES = 200_000
#: Bitmaps of 4,096 bytes each that tell which texts are needed again: 16 MB at every size.
FILTER_BITMAPS = 4096
_BITS = 32_768
_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, also if it stands inside a lambda."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """64-bit hashes of all shingles in order; an empty array for shorter texts."""
    words = F.filter(F.split(F.lower(text), _SPACE), lambda w: w != "")

    def hashed(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - width)
        hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        return F.when(F.size(w) >= width, hashes).otherwise(F.array().cast("array<bigint>"))

    return _let(words, hashed)


def fingerprint(hashes: Column) -> Column:
    """Four longs: bit b of long k is set if most shingles have bit b of their k-th hash set.

    Bits are summed four at a time, in lanes of 16 bits (windows have at most 65,535 words).
    """
    lanes = F.lit(0x0001000100010001)

    def shifted(value: Column, by: Column) -> Column:
        return F.call_function("shiftrightunsigned", value, by.cast("int"))

    def long_of(k: int) -> Column:
        own = F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k)))

        def summed(o: Column) -> Column:
            def lane(b: Column) -> Column:
                return F.aggregate(o, F.lit(0).cast("bigint"), lambda a, h: a + shifted(h, b).bitwiseAND(lanes))

            return F.transform(F.sequence(F.lit(0), F.lit(15)), lane)

        def voted(sums: Column) -> Column:
            def bit(a: Column, b: Column) -> Column:
                ones = shifted(F.get(sums, b % 16), F.floor(b / 16) * 16).bitwiseAND(F.lit(0xFFFF))
                one = F.call_function("shiftleft", F.lit(1).cast("bigint"), b)
                return a.bitwiseOR(F.when(ones * 2 > F.size(hashes), one).otherwise(F.lit(0).cast("bigint")))

            return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), bit)

        return _let(_let(own, summed), voted)

    return F.array(*[long_of(k) for k in range(4)])


def occurrences(hashes: Column) -> Column:
    """Each hash joined with the number of equal ones before it: a set that keeps weights."""
    return F.transform(
        hashes,
        lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(hashes, F.lit(1), i), lambda x: x == h))),
    )


def _starts(threshold: float) -> Column:
    """Starts of all windows that hold as many ``places`` as the threshold asks for at least.

    Sizes n and n_window of a similarity t have t / (1 + t) * (n + n_window) in common.
    """
    least = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("n") + F.col("n_window")) - 1e-9).cast("int")

    def around(need: Column) -> Column:
        def starts(i: Column) -> Column:
            first, last = F.get("places", i), F.get("places", i + need - 1)
            after = F.greatest(F.lit(0), last - F.col("n_window") + 1)
            span = F.sequence(after, F.least(first, F.col("n_all") - F.col("n_window")))
            return F.when(last - first < F.col("n_window"), span).otherwise(F.array().cast("array<int>"))

        return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size("places") - need), starts)))

    some = F.size("places") >= least
    return F.when(some, _let(F.greatest(least, F.lit(1)), around)).otherwise(F.array().cast("array<int>"))


def _bitmap_place(row: Column) -> tuple[Column, Column]:
    """Bitmap and bit of a row's hash."""
    return F.pmod(row, F.lit(FILTER_BITMAPS)), F.pmod(F.shiftrightunsigned(row, 24), F.lit(_BITS))


def _perhaps_hit(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """All rows that have hits and few others, so that other texts are not shuffled.

    Beyond some hundred million hit rows the bits fill up and more rows pass; the join that
    follows decides in any case.
    """
    bitmap, bit = _bitmap_place(F.col("row"))
    bits = hits.select(bitmap.alias("bitmap"), bit.alias("bit")).groupBy("bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return rows.withColumn("bitmap", bitmap).join(F.broadcast(bits), "bitmap").where(is_set).select(*rows.columns)


def matches(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    broadcast_shingles: int = BROADCAST_SHINGLES,
) -> DataFrame:
    """doc_id, body (hash of the text), item_id, start (first word of the window, from 0),
    n_words, distance, similarity: the best window of each document and item."""
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("doc_id", body).alias("row"), F.xxhash64(body).alias("body"), body.alias("text"))
    known = settled(
        items.select("item_id", F.monotonically_increasing_id().alias("item"), shingle_hashes(F.coalesce("text", F.lit(""))).alias("hashes"))
        .where(F.size("hashes") > 0),
        "items",
    )
    placed = known.select("item", F.size("hashes").alias("n"), F.explode(F.array_distinct("hashes")).alias("hash"))
    placed = settled(placed, "placed")
    small = placed.count() <= broadcast_shingles
    lookup = F.broadcast(placed) if small else placed
    shingled = rows.select("row", shingle_hashes(F.col("text")).alias("all")).withColumn("n_all", F.size("all"))
    spots = shingled.select("row", "n_all", F.posexplode("all").alias("pos", "hash"))
    hits = spots.join(lookup, "hash").groupBy("row", "item", "n", "n_all").agg(F.array_sort(F.collect_set("pos")).alias("places"))
    hits = hits.withColumn("n_window", F.least("n", "n_all"))
    hits = hits.select("row", "item", "n_window", _starts(threshold).alias("starts")).where(F.size("starts") > 0)
    hits = settled(hits, "hits")

    # One row per document that has hits, with the windows wanted from it.
    wanted = hits.groupBy("row").agg(F.collect_list(F.struct("item", "n_window", "starts")).alias("wanted"))
    held = _perhaps_hit(rows, hits).join(wanted, "row").dropDuplicates(["row"])
    held = held.select("doc_id", "body", shingle_hashes(F.col("text")).alias("all"), "wanted")

    def cut(w: Column) -> Column:
        return F.transform(
            w["starts"],
            lambda s: F.struct(w["item"].alias("item"), s.alias("start"), F.slice("all", s + 1, w["n_window"]).alias("hashes")),
        )

    windows = held.select("doc_id", "body", F.explode(F.flatten(F.transform("wanted", cut))).alias("w")).select("doc_id", "body", "w.*")
    windows = settled(windows.withColumn("print", fingerprint(F.col("hashes"))), "windows")

    own = known.select("item", "item_id", F.col("hashes").alias("own"), fingerprint(F.col("hashes")).alias("own_print"))
    own = settled(own, "prints")
    distance = sum((F.bit_count(F.col("print")[k].bitwiseXOR(F.col("own_print")[k])) for k in range(1, 4)),
                   F.bit_count(F.col("print")[0].bitwiseXOR(F.col("own_print")[0])))
    common = F.size(F.array_intersect(occurrences(F.col("hashes")), occurrences(F.col("own"))))
    checked = (
        windows.join(own, "item")
        .withColumn("distance", distance)
        .withColumn("similarity", common / (F.size("hashes") + F.size("own") - common))
        .where(F.col("similarity") >= threshold)
        .withColumn("n_words", F.size("hashes") + WIDTH - 1)
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "distance", "n_words")).alias("best")
    return (
        checked.groupBy("doc_id", "body", "item", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "body",
            "item_id",
            (-F.col("best.back")).alias("start"),
            F.col("best.n_words").alias("n_words"),
            F.col("best.distance").alias("distance"),
            F.col("best.similarity").alias("similarity"),
        )
    )


def op5_decontamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    return matches(docs, items).drop("body")


def decontamination_stage(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with their columns, whatever these are called."""
    return beside_others(docs, ("doc_id", "text"), lambda rows: _without_items(rows, items))


def _without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = settled(matches(docs, items).select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).distinct(), "found")
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.withColumn("_own", body)
    hit = rows["doc_id"].eqNullSafe(found["_id"]) & (rows["_own"] == found["_body"])
    return rows.join(found, hit, "left_anti").drop("_own")

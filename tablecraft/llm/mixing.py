"""Mixing sources to target weights by Pareto order sampling.

Sizes are words. Sources in order of their names (nulls last) weigh 5, 2, 1 in turn and
share the words of the mix; a source gives at most ``max_copies`` times its size, and what
it can't give goes to the others by weight. A document of a source expects

    e = rate * (1 + lean * (a - 1)),   rate = target / source size,

copies, where ``a`` falls with the document's length and has the mean 1 over the source's
words; ``lean`` is 1 unless a document would then exceed ``max_copies``. The whole part of
``e`` is certain. For the rest p each document draws U and gets the rank
(U / (1 - U)) / (p / (1 - p)); documents of the lowest ranks join, until the words of the
source come nearest to the target. U is a hash of the document, so reruns agree.

Ranks are cut at a bucket of 4096 first; only the bucket that holds the cut is ordered row by
row. So a source with a third of all rows is counted, not collected.

Defined results: null texts have size 0; a null source is a source of its own; a null id
draws by its text; rows that repeat draw alike and are taken one by one. An empty table gives
an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.llm.columns import beside_others
from tablecraft.shared import settled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUCKETS = 4096


def drawn(key: Column, seed: str) -> Column:
    """A number inside (0, 1), from the first 48 bits of an MD5."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key.cast("string"))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = 3) -> DataFrame:
    """source, source_size, mean_pull, most_pull, target: one row per source."""
    # Pull falls with the length: 1 for an empty text, 0.5 far above 1,000 words.
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.sum(F.col("size") * F.col("pull")).alias("pulled"),
        F.max("pull").alias("most_pull"),
    )
    ordered = Window.orderBy(F.asc_nulls_last("source"))  # one row per source
    turn = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ceiling = F.col("source_size") * max_copies
    everything = Window.partitionBy()
    by_ceiling = Window.orderBy(F.col("ceiling") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_ceiling.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ceiling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        sources.withColumn("weight", weight)
        .withColumn("ceiling", ceiling)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("given", F.coalesce(F.sum("ceiling").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("given")) / F.sum("weight").over(after))
        .withColumn("is_full", F.col("level") * F.col("weight") >= F.col("ceiling"))
        .withColumn("final_level", F.min(F.when(~F.col("is_full"), F.struct(F.col("ceiling") / F.col("weight"), "level"))).over(everything)["level"])
        .withColumn("target", F.when(F.col("is_full"), F.col("ceiling").cast("double")).otherwise(F.col("final_level") * F.col("weight")))
        .select("source", "source_size", "pulled", "most_pull", "target")
    )


def mix(
    docs: DataFrame,
    weights=WEIGHTS,
    max_copies: int = 3,
    seed: str = "mix",
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """key, source, size, source_size, target, copies and the columns ``extra``: one row per
    row of ``docs``.

    The word count of every text, the sums of every source and the ranks of every document
    cover the whole table.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    sizes = docs.select(
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        F.when(F.col(key).isNull(), F.md5(body)).otherwise(F.col(key).cast("string")).alias("draw_key"),
        *extra,
    ).withColumn("pull", F.lit(0.5) + F.lit(0.5) / (F.lit(1.0) + F.col("size") / F.lit(1000.0)))
    sizes = settled(sizes, "sizes")
    targets = settled(source_targets(sizes, weights, max_copies), "targets")

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    mean = F.when(F.col("source_size") > 0, F.col("pulled") / F.col("source_size")).otherwise(1.0)
    above = F.col("most_pull") / F.col("mean") - 1
    lean = F.when(above > 0, F.least(F.lit(1.0), (max_copies / F.col("rate") - 1) / above)).otherwise(0.0)
    expected = F.col("rate") * (1 + F.col("lean") * (F.col("pull") / F.col("mean") - 1))
    joined = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    chances = (
        joined.withColumn("rate", rate)
        .withColumn("mean", mean)
        .withColumn("lean", F.when(F.col("rate") > 0, lean).otherwise(0.0))
        .withColumn("expected", F.greatest(F.lit(0.0), F.least(F.lit(float(max_copies)), expected)))
        .withColumn("certain", F.floor(F.round("expected", 9)))
        .withColumn("chance", F.greatest(F.lit(0.0), F.col("expected") - F.col("certain")))
        .withColumn("draw", drawn(F.col("draw_key"), seed))
    )
    open_to_draw = (F.col("chance") > 1e-9) & (F.col("size") > 0)
    odds = (F.col("draw") / (1 - F.col("draw"))) / (F.col("chance") / (1 - F.col("chance")))
    ranked = (
        chances.withColumn("order", F.when(open_to_draw, odds / (1 + odds)))
        .withColumn("bucket", F.when(F.col("order") < 1, F.floor(F.col("order") * BUCKETS)).when(F.col("order").isNotNull(), BUCKETS - 1).cast("int"))
        .select("key", "draw_key", "source", "size", "source_size", "target", "certain", "order", "bucket", *extra)
    )
    ranked = settled(ranked, "ranked")

    # Words that each bucket of ranks adds to what is certain, and the bucket of the cut.
    words = ranked.groupBy("source", "bucket").agg(
        F.sum(F.when(F.col("order").isNotNull(), F.col("size")).otherwise(0)).alias("drawn"),
        F.sum(F.col("size") * F.col("certain")).alias("sure"),
        F.first("target").alias("target"),
    )
    by_bucket = Window.partitionBy("source").orderBy("bucket")
    sure = F.sum("sure").over(Window.partitionBy("source"))
    cuts = words.withColumn("before", F.sum("drawn").over(by_bucket) - F.col("drawn") + sure).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "before", (F.col("before") + F.col("drawn")).alias("until")
    )
    marked = ranked.join(cuts, ranked["source"].eqNullSafe(F.col("s")) & ranked["bucket"].eqNullSafe(F.col("b"))).drop("s", "b")
    whole = F.col("until") <= F.col("target")
    beyond = (F.col("before") >= F.col("target")) & ~whole
    by_row = Window.partitionBy("source", "bucket").orderBy("order", "draw_key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = marked.where(F.col("bucket").isNotNull() & ~whole & ~beyond)
    reached = F.col("before") + F.sum("size").over(by_row)
    # Taken if the end comes nearer to the target with the document than without it.
    near = (reached - F.col("target")) <= (F.col("target") - (reached - F.col("size")))
    split = split.withColumn("extra", F.when(near, 1).otherwise(0))
    plain = marked.where(F.col("bucket").isNull() | whole | beyond)
    plain = plain.withColumn("extra", F.when(F.col("bucket").isNotNull() & whole, 1).otherwise(0))
    return plain.unionByName(split).select(
        "key", "source", "size", "source_size", "target", (F.col("certain") + F.col("extra")).alias("copies"), *extra
    )


def op4_pareto_mix(docs: DataFrame) -> DataFrame:
    return mix(docs).select(
        F.col("key").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.col("copies").cast("long").alias("copies"),
    )


def mixing_stage(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (at most ``max_copies`` times).

    Rows that repeat whole are alike, so they share the copies of all of them in any order:
    their copies are added up and dealt to the distinct row. Other columns stay as they are,
    whatever they are called.
    """
    return beside_others(docs, ("doc_id", "text", "source"), lambda rows: _mixed(rows, **options))


def _mixed(docs: DataFrame, **options) -> DataFrame:
    columns = docs.columns
    body = F.md5(F.coalesce("text", F.lit("")))
    rows = docs.withColumn("_body", body)
    tagged = mix(docs.withColumn("_body", body), extra=("_body",), **options)
    copies = (
        tagged.groupBy("key", "source", "_body")
        .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
        .select(F.col("key").alias("_key"), F.col("source").alias("_source"), F.col("_body").alias("_own"), "_copies", "_rows")
    )
    copies = settled(copies, "copies")
    on = rows["doc_id"].eqNullSafe(copies["_key"]) & rows["source"].eqNullSafe(copies["_source"]) & (rows["_body"] == copies["_own"])
    joined = rows.join(copies, on)
    # Of n equal rows with c copies in all, each gives c // n and the first c % n one more.
    # They are numbered within written partitions first, so that no task holds all of them.
    single = joined.where("_rows = 1").withColumn("_n", F.col("_copies"))
    several = settled(joined.where("_rows > 1").withColumn("_part", F.spark_partition_id()), "several")
    alike = ["_key", "_source", "_own"]
    sizes = several.groupBy(*alike, "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = (F.sum("_size").over(Window.partitionBy(*alike).orderBy("_part")) - F.col("_size")).alias("_before")
    offsets = sizes.select(*[F.col(c).alias(f"{c}_o") for c in (*alike, "_part")], before)
    same = several["_part"] == offsets["_part_o"]
    for c in alike:
        same = same & several[c].eqNullSafe(offsets[f"{c}_o"])
    turn = F.row_number().over(Window.partitionBy(*alike, "_part").orderBy(F.lit(0))) + F.col("_before")
    several = several.join(offsets, same).withColumn("_turn", turn).withColumn(
        "_n", F.floor(F.col("_copies") / F.col("_rows")) + (F.col("_turn") <= F.col("_copies") % F.col("_rows")).cast("long")
    ).select(*single.columns)
    each = single.unionByName(several).where("_n > 0")
    return each.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*[F.col(f"`{c}`") for c in columns])

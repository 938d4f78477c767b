"""Stages beside columns of any name, and plain versions of what they decide."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablecraft.llm import decontamination, mixing, neardup, quality, sharding

NAMES = "_body _id _own _text _key _source _copies _copy _n _rows _turn _part _size kept probability n_words base_failed row body key size source_size".split()
RNG = random.Random(12)
WORDS = [f"w{i}x" for i in range(80)]


def sentence(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def named(spark):
    base = sentence(90)
    near = base.replace(base.split()[30], "other", 1)
    item = sentence(40)
    rows = [(1, base, "a"), (2, near, "a"), (3, f"{sentence(30)} {item} {sentence(30)}", "b"), (4, None, "b"), (None, base, None)]
    rows += [(10 + i, sentence(80), "abc"[i % 3]) for i in range(12)] + [(10, "same " * 70, "a")] * 5
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in NAMES) + ", `a.b` int"
    made = [(*r, *[f"{n}-{i}" for n in NAMES], i) for i, r in enumerate(rows)]
    return spark.createDataFrame(made, schema).repartition(3), spark.createDataFrame([(1, item)], "item_id long, text string")


def test_columns_of_any_name_stay(spark, named):
    docs, items = named
    labels = spark.createDataFrame([(1, 1, 0), (10, 0, 0)], "doc_id long, quality int, toxic int")
    stages = {
        "quality": lambda d: quality.quality_stage(d, labels),
        "near": neardup.near_duplicate_stage,
        "decontamination": lambda d: decontamination.decontamination_stage(d, items),
        "mixing": mixing.mixing_stage,
    }
    given = {tuple(r) for r in docs.collect()}
    for name, stage in stages.items():
        out = stage(docs)
        assert out.schema.simpleString() == docs.schema.simpleString(), name
        found = [tuple(r) for r in out.collect()]
        assert found and set(found) <= given, name


def test_repeated_rows_share_their_copies(spark):
    """Equal rows in several partitions give the copies of all of them, none more than one beyond another."""
    rows = [(1, "a b c d", "s", i) for i in range(90)] + [(2, "x " * 200, "t", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, place int").repartition(7)
    taken = Counter(r["place"] for r in mixing.mixing_stage(docs).where("doc_id = 1").collect())
    whole = mixing.op4_pareto_mix(docs).where("doc_id = 1").agg((F.sum("taken") / 4).cast("int")).first()[0]
    assert sum(taken.values()) == whole
    counts = [taken.get(i, 0) for i in range(90)]
    assert max(counts) - min(counts) <= 1


def plain_targets(sizes):
    """Water filling by hand: shares by weight, what a source can't hold goes to the others."""
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, free, targets = float(sum(sizes.values())), dict(weights), {}
    while free:
        total = sum(free.values())
        full = [s for s, w in free.items() if left * w / total > 3 * sizes[s]]
        if not full:
            return targets | {s: left * w / total for s, w in free.items()}
        for s in full:
            targets[s] = 3.0 * sizes[s]
            del free[s]
        left = sum(sizes.values()) - sum(targets.values())
    return targets


@pytest.mark.parametrize("sizes", [{"a": 5000, "b": 700, "c": 30}, {"a": 3, "b": 4000, "c": 900, "d": 50, None: 1200}, {"a": 10}])
def test_targets_equal_water_filling(spark, sizes):
    rows = []
    for s, n in sizes.items():
        while n > 0:
            words = min(n, RNG.randint(1, 40))
            rows.append((len(rows), " ".join(["w"] * words), s))
            n -= words
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.op4_pareto_mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    targets = plain_targets(sizes)
    taken = Counter()
    for r in found:
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["source_size"] == sizes[r["source"]] and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 40 + 1e-6 * target


def test_shards_are_balanced_by_rows_whatever_repeats(spark):
    rows = [(i, sentence(5)) for i in range(60)] + [(7, "same")] * 40
    found = sharding.op3_consistent_sharding(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    per_shard = Counter(r["shard"] for r in found)
    assert set(per_shard) == set(range(8)) and max(per_shard.values()) - min(per_shard.values()) <= 1
    for shard, n in per_shard.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(n))

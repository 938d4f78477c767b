"""Hard negatives against all pairs in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tablecraft.llm import hardnegatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, tile string, v long"


def expected(rows):
    """All pairs of the rows that take part, as whole numbers of any size."""
    kept = []
    for key, vector, label, *_ in dict.fromkeys((r[0], None if r[1] is None else tuple(r[1]), r[2]) for r in rows):
        if key is None or label is None or vector is None or not all(x is not None and math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in np.array(vector, np.float32).astype(float).tolist()]
        kept.append((key, (label + 1) % 10 if key % 7 == 0 else label, whole))
    out = []
    for key, label, vector in kept:
        if key % 100:
            continue
        scored = [(max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(vector, w)))), k, m) for k, m, w in kept if k != key]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for p, positive, _ in [x for x in scored if x[2] == label][:5]:
            found = [x for x in scored if x[2] != label and 30 * p <= 100 * x[0] <= 90 * p][:10]
            out += [(key, positive, rank, x[1], p, x[0]) for rank, x in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, partitions=3, **settings):
    frame = hn.op13_hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(partitions), **settings)
    assert frame.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in frame.collect())


def random_rows(n=420, width=5, labels=4):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0.3, 1) for _ in range(width)], rng.randrange(labels), "t", 1) for i in range(n)]
    rows += [(n + i, rows[50][1], 1, "t", 1) for i in range(60)]  # one frequent vector: ties
    rows += [(-100, [1.0] * width, 0, "", 0), (None, [1.0] * width, 1, "", 0), (700, None, 1, "", 0), (701, [1.0], None, "", 0)]
    rows += [(702, [math.nan] * width, 1, "", 0), (703, [math.inf, 1.0], 1, "", 0), (704, [None, 1.0], 1, "", 0)]
    rows += [(800, [], 2, "", 0), (801, [2.0], 3, "", 0), (802, [1.0] * (width + 3), 2, "", 0), rows[100], rows[100]]
    return rows


def test_equals_all_pairs(spark):
    rows = random_rows()
    assert mined(spark, rows) == expected(rows)


def test_many_tiles(spark, monkeypatch):
    """Tiles of 20 rows and blocks of few boxes give the same rows."""
    rows = random_rows()
    assert mined(spark, rows, tile_rows=20) == expected(rows)
    monkeypatch.setattr(hn, "ROOTS", 4)
    assert mined(spark, rows, tile_rows=20) == expected(rows)


def test_small_pieces_and_shelves(spark, monkeypatch):
    """Tiles in pieces of a few rows, on shelves of a few tiles, give the same rows."""
    rows = random_rows()
    for name, value in (("PIECE", 30), ("SHELF_BYTES", 600), ("PART_BYTES", 500), ("TILE_BYTES", 2000)):
        monkeypatch.setattr(hn, name, value)
    monkeypatch.setattr(hn, "ROUTED", 2)
    assert mined(spark, rows) == expected(rows)


def sent_to_python(frame):
    """Bytes that the nodes of a plan sent to Python, after it ran."""

    def nodes(plan):
        name = plan.getClass().getSimpleName()
        below = [plan.finalPhysicalPlan()] if name == "AdaptiveSparkPlanExec" else [plan.plan()] if name.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
        return [plan, *(x for p in below for x in nodes(p))]

    metrics = [x.metrics().get("pythonDataSent") for x in nodes(frame._jdf.queryExecution().executedPlan())]
    return sum(m.get().value() for m in metrics if m.isDefined())


def test_boxes_of_tiles_do_not_travel_with_each_anchor(spark):
    """What tasks read is 3 times the rows; with all boxes beside each window of an anchor it was 32 times."""
    rng = np.random.default_rng(5)
    rows = [(i * 5, v.tolist(), i % 3, "", 0) for i, v in enumerate(rng.normal(0.2, 1, (800, 32)).astype(np.float32))]
    frame = hn.op13_hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3), tile_rows=20)
    assert sorted(tuple(r) for r in frame.collect()) == expected(rows)
    assert 0 < sent_to_python(frame) < 5 * 800 * 8 * 32


@pytest.mark.parametrize("same", [True, False])
def test_windows_of_an_anchor_are_searched_at_once(monkeypatch, same):
    """Several windows of each anchor, over several trees, against all rows; with ties of scores and ids."""
    rng = np.random.default_rng(6)
    monkeypatch.setattr(hn, "HITS", 50)
    vectors, labels, ids = np.floor(rng.normal(size=(900, 3)) * 4), rng.integers(0, 3, 900), rng.integers(0, 600, 900)
    at = np.arange(0, 900, 30)
    n = rng.integers(1, 4, len(at))
    low = rng.integers(-30, 10, n.sum())
    high = low + rng.integers(0, 40, n.sum())
    search = hn.Search.of_anchors(ids[at], labels[at], vectors[at], same, n, low, high, 4)
    for i in range(0, 900, 300):
        part = slice(i, i + 300)
        search.run(hn.Tree(ids[part], labels[part], hn._narrow(vectors[part]), leaf=20))
    for ask, anchor in enumerate(np.repeat(at, n)):
        score = (vectors @ vectors[anchor]).astype(int)
        fits = ((labels == labels[anchor]) == same) & (ids != ids[anchor]) & (low[ask] <= score) & (score <= high[ask])
        best = sorted(zip((-score[fits]).tolist(), ids[fits].tolist()))[:4]
        assert search.found[ask] == [(-s, i) for s, i in best]


def test_numbers_travel_exactly():
    for numbers in ([0, -32767, 32767], [-32768, 5], [1 << 31, -1], [-(1 << 63), (1 << 63) - 1], []):
        numbers = np.array(numbers, np.int64)
        assert hn._unpressed(hn._pressed(numbers)).tolist() == numbers.tolist()
    vectors = [[1.0, -2.0], [2.0**100], [], [70000.0, 1.0, 3.0]]
    assert hn._decoded([hn._coded(np.array(v)) for v in vectors]).tolist() == [[1, -2, 0], [2.0**100, 0, 0], [0, 0, 0], [70000, 1, 3]]


def test_one_label_and_one_vector(spark):
    rows = [(i, [0.5, 0.5], 1, "", 0) for i in range(300)]
    assert mined(spark, rows) == expected(rows)
    rows += [(1000 + i, [0.4, 0.4], 2, "", 0) for i in range(300)]
    found = mined(spark, rows, tile_rows=50)
    assert found and found == expected(rows)


def test_empty_table(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1, "", 0)]) == []


def test_scores_beyond_the_whole_numbers_of_a_double(spark):
    rows = [(200, [2.0**100, 1.0], 3, "", 0), (5, [2.0**100, 7.0], 3, "", 0)]
    assert mined(spark, rows) == expected(rows)
    rows = [(100, [2.0**27 + 16, 1.0], 1, "", 0), (1, [2.0**18 + 1 / 256, -3.0], 1, "", 0), (2, [2.0**17 + 1 / 256, 2.0], 2, "", 0), (3, [2.0**17, 1.0], 2, "", 0)]
    assert mined(spark, rows) == expected(rows)


def test_boxes_hold_their_rows_and_all_products():
    rng = np.random.default_rng(1)
    vectors = np.floor(rng.normal(size=(3000, 6)) * 256)
    labels = rng.integers(0, 5, 3000)
    tree = hn.Tree(np.arange(3000), labels, vectors)
    assert sorted(tree.ids.tolist()) == list(range(3000))
    anchors = vectors[:40]
    for level, (low, high, label_low, label_high) in enumerate(tree.levels):
        for node in range(len(low)):
            rows = [node]
            for below in range(level, -1, -1):
                rows = [r for n in rows for r in tree.below(below, n)]
            assert (tree.vectors[rows] >= low[node]).all() and (tree.vectors[rows] <= high[node]).all()
            assert (tree.labels[rows] >= label_low[node]).all() and (tree.labels[rows] <= label_high[node]).all()
            least, most = hn.intervals(anchors, low[node : node + 1], high[node : node + 1])
            score = anchors @ tree.vectors[rows].T
            assert (score >= least).all() and (score <= most).all()
    assert len(tree.levels[-1][0]) == 1


def test_search_prunes(monkeypatch):
    """In few dimensions most leaves are never scored."""
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(size=(20_000, 2)) * 256)
    tree = hn.Tree(np.arange(20_000), np.zeros(20_000, np.int64), vectors)
    scored = []
    real = hn.products
    monkeypatch.setattr(hn, "products", lambda a, b: scored.append(len(b)) or real(a, b))
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    search = hn.Search(np.array([5]), np.array([0]), vectors[5:6], True, np.array([least]), np.array([most]), np.array([least]), 5)
    search.run(tree)
    score = (vectors @ vectors[5]).astype(int)
    score[5] = score.min() - 1
    assert sorted((x[0] for x in search.found[0]), reverse=True) == sorted(score, reverse=True)[:5]
    assert sum(scored) < 2_000


@pytest.mark.parametrize("same", [True, False])
def test_intervals_of_large_numbers_have_room(same):
    low, high = np.array([[-(2.0**60), 2.0**59]]), np.array([[2.0**61, 2.0**60]])
    least, most = hn.intervals(np.array([[2.0**55 + 8, -3.0]]), low, high)
    assert least[0, 0] <= int(low[0, 0]) * (2**55 + 8) - 3 * 2**60
    assert most[0, 0] >= int(high[0, 0]) * (2**55 + 8) - 3 * 2**59

"""Katz scores against a model of plain dictionaries."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablecraft.llm import katz

K = katz.FREQUENT
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, block string, kind long"


def discounts(counts):
    n = Counter(counts.values())
    out = {}
    large = (K + 1) * n[K + 1] / n[1] if n[1] else 1
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - large) / (1 - large) if n[r] and large < 1 else 1
        out[r] = d if 0 < d <= 1 else 1
    return lambda c: out.get(c, 1)


class Plain:
    """p(word | before) from dictionaries of all counts."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for tokens in texts:
            self.one.update(tokens)
            self.two.update(zip(["<start>", *tokens], tokens))
        self.d1, self.d2 = discounts(self.one), discounts(self.two)
        self.n = sum(self.one.values())
        kept = sum(self.d1(c) * c for c in self.one.values())
        self.total = self.n if kept < self.n - 1e-9 else self.n + 1
        self.unknown = 1 - kept / self.total
        self.after = {}
        for (h, w), c in self.two.items():
            self.after.setdefault(h, {})[w] = c

    def p1(self, w):
        c = self.one[w]
        return self.d1(c) * c / self.total if c else self.unknown

    def p(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.p1(w)
        total = sum(seen.values())
        kept = sum(self.d2(c) * c for c in seen.values())
        total += kept >= total - 1e-9
        if w in seen:
            return self.d2(seen[w]) * seen[w] / total
        return (1 - kept / total) / (1 - sum(map(self.p1, seen))) * self.p1(w)


def tokens_of(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), "</end>"]


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def expected(rows):
    model = Plain([tokens_of(r[1]) for r in rows if not is_held(r[0])])
    out = []
    for r in rows:
        t = tokens_of(r[1])
        base = sum(math.log10((model.one[w] + 1) / (model.n + len(model.one) + 1)) for w in t)
        score = sum(math.log10(model.p(h, w)) for h, w in zip(["<start>", *t], t))
        out.append((r[0], is_held(r[0]), len(t), sum(model.one[w] > 0 for w in t), model.n, base, score))
    return out


def scores(spark, rows, partitions=3, **division):
    frame = katz.op12_katz_scores(spark.createDataFrame(rows, SCHEMA).repartition(partitions), **division)
    assert frame.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return [tuple(r) for r in frame.collect()]


def same(ours, theirs):
    def order(rows):
        return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[6], 6)))

    ours, theirs = order(ours), order(theirs)
    assert [r[:5] for r in ours] == [r[:5] for r in theirs]
    assert np.allclose([r[5:] for r in ours], [r[5:] for r in theirs], rtol=1e-9, atol=1e-9)


def random_rows(n=120, words=60):
    rng = random.Random(3)
    vocabulary = [f"W{i}é" if i % 5 else f"the{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60)))
        rows.append((i, rng.choice([" ", "\n", ""]) + text + (f" once{i}" if i % 3 else ""), "b", 1))
    odd = [(None, "The the", None, None), (None, None, None, None), (500, None, "x", 2), (501, "", "x", 2), (502, " \n\t", "x", 2), (503, " \x1f", "x", 2)]
    return rows + odd + [rows[2], rows[2]]


def test_equals_the_plain_model(spark):
    rows = random_rows()
    same(scores(spark, rows, part_bytes=1 << 11), expected(rows))


def test_the_partitioning_does_not_matter(spark):
    rows = random_rows(40)
    same(scores(spark, rows, 1), expected(rows))
    same(scores(spark, rows, 7), expected(rows))


def test_probabilities_after_a_word_sum_to_one():
    rows = random_rows()
    model = Plain([tokens_of(r[1]) for r in rows])
    for h in ["<start>", "the0", "w1é", "never"]:
        assert sum(model.p(h, w) for w in model.one) + model.p(h, "unknown") == pytest.approx(1)


def test_split_first_words(spark):
    """First words beyond ``hot_word``, the start of a text too, are dealt over several parts."""
    rows = random_rows()
    same(scores(spark, rows, part_bytes=1 << 11, hot_word=20), expected(rows))


def test_long_text_and_hot_word(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["the", "of", f"x{rng.randint(0, 500)}"]) for _ in range(60_000))
    rows = [(0, long, "b", 1), (3, long[:1000], "b", 1), *random_rows(20)[5:]]
    same(scores(spark, rows), expected(rows))


def test_empty_table_and_nothing_to_learn_from(spark):
    assert scores(spark, []) == []
    held = next(i for i in range(100) if is_held(i))
    assert scores(spark, [(held, "a b", "", 0)]) == [(held, True, 3, 0, 0, 0.0, 0.0)]


def test_good_turing():
    found = katz.good_turing(np.array([100, 40, 20, 12, 8, 5]))
    large = 6 * 5 / 100
    assert found[1] == pytest.approx((2 * 40 / 100 - large) / (1 - large))
    assert found[6] == 1
    assert (katz.good_turing(np.zeros(6, np.int64)) == 1).all()

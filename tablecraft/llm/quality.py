"""Quality rules and a hashed n-gram classifier, scored in Arrow batches.

The classifier is a logistic regression on hashed words, word pairs and byte 4-grams (of
UTF-8), each as a share of its kind in the text. It is fitted on a bounded sample of
labelled rows (``SAMPLE`` rows, by order of a hash of the id), three quarters of it for the
weights and the rest to calibrate the score to a probability. Everything else reads every
row and the whole of every text.

Defined results: a null or empty text has no words, so it fails the base rules. Rows that
repeat get equal verdicts. Labels without a document, and null labels, are not used. With
fewer than ``LEAST_LABELS`` rows of either label there is no classifier, and the base rules
decide alone. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.columns import beside_others
from tablecraft.llm.textblocks import Block, blocks, mix, repeated

BITS = 17
SAMPLE = 4000
LEAST_LABELS = 20
THRESHOLD = 0.5
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"


@dataclass(frozen=True)
class Model:
    """Weights by feature hash, a bias, and the two numbers that calibrate the margin."""

    weights: np.ndarray | None
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0


def rule_counts(block: Block, words: np.ndarray) -> dict[str, np.ndarray]:
    n = block.n_texts
    code_point = (block.data & 0xC0) != 0x80
    start, end, text = block.lines()
    filled = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(~block.is_space, out=filled[1:])
    has_word = filled[end] > filled[start]
    line = mix(block.hashes(start, end) + text.astype(np.uint64))
    dup_line = repeated(line)[1] & has_word
    triple, at = block.windows(words, 3)
    many, _ = repeated(mix(triple + block.word_text[at].astype(np.uint64)))
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[at[many] + k] = True
    n_words = block.n_words
    n_repeat = np.bincount(block.word_text[covered], minlength=n)
    return {
        "n_words": n_words,
        "word_chars": block.per_text(code_point & ~block.is_space),
        "n_symbols": block.per_text(_SYMBOL[block.data]),
        "n_dup_lines": np.bincount(text[dup_line], minlength=n),
        "n_repeat_words": n_repeat,
        "base_failed": (n_words < LEAST_WORDS) | (100 * n_repeat > MOST_REPEATED_PERCENT * n_words),
    }


def features(block: Block, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For words, word pairs and byte 4-grams: feature and text of every occurrence."""
    drop = np.uint64(64 - BITS)
    yield (words >> drop).astype(np.int32), block.word_text
    pair, at = block.windows(words, 2)
    yield (pair >> drop).astype(np.int32), block.word_text[at]
    data = block.data.astype(np.uint32)
    n = max(0, len(data) - 3)
    gram = data[:n] | data[1 : 1 + n] << 8 | data[2 : 2 + n] << 16 | data[3 : 3 + n] << 24
    gram = (gram * np.uint32(2654435769)) >> np.uint32(32 - BITS)
    lengths = np.maximum(0, np.diff(block.starts) - 3)
    text = np.repeat(np.arange(block.n_texts), lengths)
    first = np.repeat(block.starts[:-1] - (np.cumsum(lengths) - lengths), lengths)
    yield gram[np.arange(len(text)) + first].astype(np.int32), text


def margins(model: Model, block: Block, words: np.ndarray) -> np.ndarray:
    total = np.full(block.n_texts, model.bias)
    for feature, text in features(block, words):
        counts = np.bincount(text, minlength=block.n_texts)
        sums = np.bincount(text, model.weights[feature], minlength=block.n_texts)
        total += sums / np.maximum(counts, 1)
    return total


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(labels: np.ndarray, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, steps: int = 150) -> Model:
    """Weights by accelerated gradient steps; then slope and shift on the rows held out."""
    rank = np.arange(len(labels))
    train = rank % 4 != 0
    used = train[rows]
    r, c, v = rows[used], columns[used], values[used]
    # Features count by how much they vary, so rare ones move as freely as common ones.
    spread = np.sqrt(np.bincount(c, v * v, minlength=1 << BITS) / max(1, train.sum()))
    scale = 1 / (spread + 1e-3)
    v = v * scale[c]
    n, decay = train.sum(), 1e-3
    w, step_w, bias, m, s, mb, sb = np.zeros(1 << BITS), None, 0.0, np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0, 0.0
    for step in range(1, steps + 1):
        error = _sigmoid(np.bincount(r, v * w[c], minlength=len(labels)) + bias) - labels
        error[~train] = 0
        g, gb = np.bincount(c, v * error[r], minlength=1 << BITS) / n + decay * w, error.sum() / n
        m, s, mb, sb = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        fade, fades = 1 - 0.9**step, 1 - 0.99**step
        w = w - 0.02 * (m / fade) / (np.sqrt(s / fades) + 1e-8)
        bias -= 0.02 * (mb / fade) / (np.sqrt(sb / fades) + 1e-8)
    margin = np.bincount(rows, values * scale[columns] * w[columns], minlength=len(labels)) + bias
    slope, shift = _calibrated(margin[~train], labels[~train])
    return Model((w * scale).astype(np.float64), float(bias), slope, shift)


def _calibrated(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic fit of labels on margins, with smoothed labels, by Newton steps."""
    good, bad = label.sum(), len(label) - label.sum()
    aim = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.column_stack([margin, np.ones_like(margin)])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ beta)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        beta = beta - np.clip(np.linalg.solve(hessian, x.T @ (p - aim)), -2, 2)
    return float(beta[0]), float(beta[1])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            words = block.word_hashes()
            keys, shares = [], []
            for feature, text in features(block, words):
                key, count = np.unique(text.astype(np.int64) << BITS | feature, return_counts=True)
                total = np.bincount(text, minlength=block.n_texts)
                keys.append(key)
                shares.append(count / total[key >> BITS])
            key, share = np.concatenate(keys), np.concatenate(shares)
            order = np.argsort(key, kind="stable")
            key, share = key[order], share[order]
            ends = np.searchsorted(key >> BITS, np.arange(block.n_texts), "right")
            bounds = np.concatenate([[0], ends])
            for i in range(block.n_texts):
                part = slice(bounds[i], bounds[i + 1])
                yield pa.RecordBatch.from_pydict(
                    {
                        "rank": batch.column("rank").slice(block.first + i, 1),
                        "label": batch.column("label").slice(block.first + i, 1),
                        "columns": pa.array([(key[part] & ((1 << BITS) - 1)).astype(np.int32).tobytes()], pa.binary()),
                        "shares": pa.array([share[part].astype(np.float32).tobytes()], pa.binary()),
                    }
                )


def _fit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    taken = [row for batch in batches for row in batch.to_pylist()]
    taken.sort(key=lambda row: (row["rank"], row["label"], row["columns"]))
    labels = np.array([row["label"] for row in taken], float)
    if min(labels.sum(), len(labels) - labels.sum()) < LEAST_LABELS:
        return
    columns = [np.frombuffer(row["columns"], np.int32) for row in taken]
    rows = np.repeat(np.arange(len(taken)), [len(c) for c in columns])
    shares = np.concatenate([np.frombuffer(row["shares"], np.float32) for row in taken]).astype(float)
    model = fit(labels, rows, np.concatenate(columns), shares)
    yield pa.RecordBatch.from_pydict(
        {
            "weights": pa.array([model.weights.tobytes()], pa.binary()),
            "bias": [model.bias],
            "slope": [model.slope],
            "shift": [model.shift],
        }
    )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows, the first ones by a hash of the id."""
    rank = F.xxhash64(F.lit("sample"), "doc_id")
    chosen = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL")
        .select("doc_id", F.col("quality").cast("int").alias("label"), rank.alias("rank"))
        .orderBy("rank", "label")
        .limit(sample)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(chosen, "doc_id").select("rank", "label", "text").orderBy("rank", "label", "text").limit(sample)
    parts = rows.repartition(8, "rank").mapInArrow(_sample_features, "rank long, label int, columns binary, shares binary")
    fitted = parts.coalesce(1).mapInArrow(_fit_batches, "weights binary, bias double, slope double, shift double")
    found = fitted.collect()  # one row of 2 ** BITS weights
    if not found:
        return Model(None)
    row = found[0]
    return Model(np.frombuffer(row["weights"], np.float64), row["bias"], row["slope"], row["shift"])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """The rule counts and the verdict beside the columns ``keep`` of each row of ``docs``."""
    keep = ["doc_id"] if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS numbers
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", " + _SCHEMA

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for block in blocks(batch.column("_text")):
                words = block.word_hashes()
                found = rule_counts(block, words)
                good = ~found["base_failed"]
                p = np.where(good, 1.0, 0.0)
                if fitted.weights is not None:
                    p = _sigmoid(fitted.slope * margins(fitted, block, words) + fitted.shift)
                found |= {"kept": good & (p >= threshold), "probability": p}
                kept = [batch.column(i).slice(block.first, block.n_texts) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    kept + [pa.array(x) for x in found.values()], names=[*keep, *found]
                )

    columns = [F.col(f"`{c}`") for c in keep]
    return docs.select(*columns, F.coalesce("text", F.lit("")).alias("_text")).mapInArrow(scored, schema)


def op8_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels)).drop("probability")


def quality_stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules and the classifier keep, with their columns, whatever these
    are called."""
    model = train(docs, labels)
    return beside_others(docs, ("doc_id", "text"), lambda rows: score(rows, model, keep=rows.columns).where("kept"))

"""A bigram language model with Katz backoff, counted and evaluated in packed blocks.

1. Texts are cut into words; about 10 MB of whole texts are a block. A block has a dictionary
   of its different words, so whatever is shuffled has one entry for each block at most,
   however frequent a word is.
2. Words are dealt by their hash into the parts of the unigram table; each part sums the
   counts of the training texts and answers every block with the number and count of its words.
3. Bigrams are dealt by their first word into the parts of the bigram table; first words beyond
   ``HOT_WORD`` training tokens are dealt by both words. Each part answers a block with the counts
   of its bigrams and, for each first word, what its backoff weight needs: how many followers
   were counted 1, 2 ... ``FREQUENT`` times, the sum of larger counts, and the unigram
   probability of all followers. Split first words are added up over their parts.
4. Each block evaluates its tokens: p(w | h) = d(c) c / T(h) if the bigram was counted, else
   b(h) p(w), and p(w) = d(c) c / N, or what is left to words that were not counted.

Good-Turing discounts d(c) hold for counts up to ``FREQUENT``, of words and of bigrams apart; a
discount that the counts of counts give no value between 0 and 1 is 1. Where discounts leave
nothing to backoff, one is added to T(h), or to N. Backoff weights are normalised exactly: over
all counted words and the one unknown word p(. | h) sums to 1.

The first word of a text follows a mark of its start; the end of a text is a token. Words of more
bytes than others are just longer. Different words are told apart by 64 bits, their bigrams by
dense numbers of the words: among a billion different words two meet with a probability of 3 %.

Defined results: null and empty texts hold the end alone. A null id counts as the empty string
for the choice of training texts. Rows that repeat are each a row, and are learned from each
time. An empty table gives no rows; without training texts every token is unknown and has
probability 1. A text of any length is one block at most (some 150 bytes of memory per token).
Extra columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.packing import arrow_table, pack, pack_rising, runs, unpack, unpack_rising
from tablecraft.llm.textblocks import blocks, mix
from tablecraft.shared import settled

#: Larger counts are reliable and not discounted.
FREQUENT = 5
#: Bytes of text in a block, and bytes of text for each part of the tables.
BLOCK = 10 << 20
PART = 1 << 23
#: Training tokens of a first word in one part; of more, its bigrams are dealt over more parts.
HOT_WORD = 1 << 22
#: One text in ``FOLDS`` is held out: those of remainder ``HELD_OUT``.
FOLDS, HELD_OUT = 7, 2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END = np.uint64(0xE11D0F7E87000001)
_START = 1  # number of the mark before the first word
_ANSWER = "block long, kind string, part int, a binary, b binary, c binary"


# ---- 1: blocks of texts ---------------------------------------------------------------

_BLOCKS = "block long, part int, keys binary, locals binary, trained binary, doc_ids binary, nulls binary, held binary, lengths binary, tokens binary, n_trained long"


def _one_block(words: np.ndarray, n_words: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Length of each text, its tokens as places in the dictionary, the dictionary, and how often
    each of its words stands in training texts. Frequent words have low places."""
    lengths = n_words + 1
    sequence = np.full(int(lengths.sum()), _END, np.uint64)
    inner = np.ones(len(sequence), bool)
    inner[np.cumsum(lengths) - 1] = False
    sequence[inner] = words
    order = np.argsort(sequence)
    first = runs(sequence[order])
    size = np.diff(np.append(first, len(sequence)))
    by_size = np.argsort(-size, kind="stable")
    place = np.empty(len(first), np.int64)
    place[by_size] = np.arange(len(first))
    tokens = np.empty(len(sequence), np.int64)
    tokens[order] = np.repeat(place, size)
    trained = np.bincount(tokens[np.repeat(~held, lengths)], minlength=len(first))
    return lengths, tokens, sequence[order[first]][by_size], trained


def _block_rows(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """Rows of two kinds: the texts of a block (part null), and its words in one part of the table."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for b in blocks(batch.column("_text"), BLOCK, _LOWER):
                held = batch.column("_held").slice(b.first, b.n_texts).to_numpy(zero_copy_only=False).astype(bool)
                ids = batch.column("_key").slice(b.first, b.n_texts)
                lengths, tokens, words, trained = _one_block(b.word_hashes(), b.n_words, held)
                rows = [
                    {
                        "block": block,
                        "doc_ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                        "nulls": np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(),
                        "held": np.packbits(held).tobytes(),
                        "lengths": pack(lengths),
                        "tokens": pack(tokens),
                        "n_trained": int((~held).sum()),
                    }
                ]
                part = (words % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                for mine in np.split(order, runs(part[order])[1:]):
                    rows.append({"block": block, "part": int(part[mine[0]]), "keys": words[mine].astype("<u8").tobytes(), "locals": pack_rising(mine), "trained": pack(trained[mine])})
                yield from arrow_table(_BLOCKS, rows).to_batches()
                block += 1

    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(key).cast("long").alias("_key"),
        F.coalesce(text, F.lit("")).alias("_text"),
        (crc % FOLDS == HELD_OUT).alias("_held"),
    )
    return rows.mapInArrow(cut, _BLOCKS)


# ---- 2: words -------------------------------------------------------------------------


def _counts_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(counts[counts <= FREQUENT + 1], minlength=FREQUENT + 2)[1:].tolist()


def _words(rows: DataFrame, parts: int) -> DataFrame:
    """Answers to each block: a its words, b their numbers, c their counts. One more row of each
    part (block null) has in a: tokens, different words, and the counts of counts."""

    def summed(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, "<u8") for k in group.column("keys").to_pylist()]
        sizes = [len(k) for k in keys]
        every = np.concatenate(keys)
        order = np.argsort(every)
        first = runs(every[order])
        trained = np.concatenate([unpack(x) for x in group.column("trained").to_pylist()])
        count = np.add.reduceat(trained[order], first)
        which = np.empty(len(every), np.int64)
        which[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(every))))
        part = group.column("part")[0].as_py()
        known = count[count > 0]
        said = [{"kind": "totals", "a": np.array([known.sum(), len(known), *_counts_of_counts(known)], "<i8").tobytes()}]
        for block, own, mine in zip(group.column("block").to_pylist(), group.column("locals").to_pylist(), np.split(which, np.cumsum(sizes)[:-1])):
            said.append({"block": block, "kind": "words", "part": part, "a": own, "b": pack(_START + 1 + part + parts * mine), "c": pack(count[mine])})
        return arrow_table(_ANSWER, said)

    return rows.where("part IS NOT NULL").select("block", "part", "keys", "locals", "trained").groupBy("part").applyInArrow(summed, _ANSWER)


def _totals(answers: DataFrame, kind: str) -> np.ndarray:
    """Sums of the totals of all parts: a handful of numbers for each, added up in a task."""
    n = FREQUENT + (3 if kind == "totals" else 1)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            for value in batch.column("a").to_pylist():
                total += np.frombuffer(value, "<i8")
        yield pa.RecordBatch.from_pydict({f"n{i}": pa.array([int(x)], pa.int64()) for i, x in enumerate(total)})

    rows = answers.where(F.col("kind") == kind).select("a").mapInArrow(added, ", ".join(f"n{i} long" for i in range(n)))
    found = rows.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(n)]).first()
    return np.array(list(found), np.int64)


# ---- the model's numbers --------------------------------------------------------------


def good_turing(counts: np.ndarray) -> np.ndarray:
    """Discounts of counts 0 (no use), 1 ... FREQUENT, and of all larger ones, from the numbers of
    things counted 1, 2 ... FREQUENT + 1 times."""
    out = np.ones(FREQUENT + 2)
    n = np.concatenate([[0], counts]).astype(float)
    if n[1] <= 0:
        return out
    large = (FREQUENT + 1) * n[FREQUENT + 1] / n[1]
    for r in range(1, FREQUENT + 1):
        if n[r] > 0 and large < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - large) / (1 - large)
            out[r] = d if 0 < d <= 1 else 1
    return out


def _mass(classes: np.ndarray, discounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts, and what is left of them after discounts. ``classes`` has, in its last
    axis, the numbers of things counted 1 ... FREQUENT times and the sum of larger counts."""
    r = np.append(np.arange(1, FREQUENT + 1), 1)
    total = (classes * r).sum(-1).astype(float)
    taken = (classes[..., :-1] * (r[:-1] * (1 - discounts[1:-1]))).sum(-1)
    nothing = taken <= 0
    return total + nothing, taken + nothing


class Unigrams:
    """p(w) from the count of a word; a count of 0 is the unknown word."""

    def __init__(self, totals: np.ndarray):
        self.n, self.v, self.counts = int(totals[0]), int(totals[1]), totals[2:]
        self.discounts = good_turing(self.counts)
        few = self.counts[:FREQUENT]
        large = self.n - int((few * np.arange(1, FREQUENT + 1)).sum())
        total, left = _mass(np.append(few, large), self.discounts)
        self.total, self.unknown = float(total), float(left / total)

    def __call__(self, count: np.ndarray) -> np.ndarray:
        d = self.discounts[np.minimum(count, FREQUENT + 1)]
        return np.where(count > 0, d * count / self.total, self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.n + self.v + 1))


# ---- 3: bigrams -----------------------------------------------------------------------


class _Block:
    """Texts of a block with the numbers and counts of its words."""

    def __init__(self, texts: pa.Table, words: list[dict]):
        row = texts.to_pylist()[0]
        self.lengths, self.tokens = unpack(row["lengths"]), unpack(row["tokens"])
        n = len(self.lengths)
        self.nulls = np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=n).astype(bool)
        self.held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=n).astype(bool)
        self.ids = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=self.nulls)
        size = int(self.tokens.max()) + 1
        self.number, self.count = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)
        for answer in words:
            at = unpack_rising(answer["a"])
            self.number[at], self.count[at] = unpack(answer["b"]), unpack(answer["c"])
        self.number[size] = _START
        self.starts = np.cumsum(self.lengths) - self.lengths
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        before[self.starts] = size
        self.pair = before * (size + 1) + self.tokens
        self.order = np.argsort(self.pair)
        self.first = runs(self.pair[self.order])
        pairs = self.pair[self.order[self.first]]
        self.h, self.w = pairs // (size + 1), pairs % (size + 1)

    def asked(self, parts: int, starts: int, hot_word: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bigrams of known words, by part, first word and second; their parts; and whether
        their first word is dealt over several parts."""
        known = np.flatnonzero((self.count[self.w] > 0) & ((self.count[self.h] > 0) | (self.number[self.h] == _START)))
        h, w = self.number[self.h[known]], self.number[self.w[known]]
        size = np.where(h == _START, starts, self.count[self.h[known]])
        hot = size > hot_word
        share = 1 + size // hot_word
        spread = (mix(w.astype(np.uint64)) % share.astype(np.uint64)).astype(np.int64)
        part = np.where(hot, (h + spread * 7919) % parts, h % parts)
        order = np.lexsort((w, h, part))
        return known[order], part[order], hot[order]


def _bigram_requests(texts: DataFrame, words: DataFrame, parts: int, starts: int, hot_word: int) -> DataFrame:
    schema = "block long, part int, h binary, w binary, c binary, trained binary, hot binary"

    def asked(texts: pa.Table, words: pa.Table) -> pa.Table:
        block = _Block(texts, words.to_pylist())
        number = texts.column("block")[0].as_py()
        use, part, hot = block.asked(parts, starts, hot_word)
        taught = np.repeat(~block.held, block.lengths).astype(np.int64)
        trained = np.add.reduceat(taught[block.order], block.first)
        rows = []
        for a, b in zip(runs(part), [*runs(part)[1:], len(part)]):
            mine = use[a:b]
            rows.append(
                {
                    "block": number,
                    "part": int(part[a]),
                    "h": pack_rising(block.number[block.h[mine]]),
                    "w": pack(block.number[block.w[mine]]),
                    "c": pack(block.count[block.w[mine]]),
                    "trained": pack(trained[mine]),
                    "hot": pack(hot[a:b]),
                }
            )
        return arrow_table(schema, rows)

    return texts.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(asked, schema)


def _bigrams(requests: DataFrame, unigram: Unigrams) -> DataFrame:
    """Answers to each block: a the counts of its bigrams of a part, b and c what the backoff of
    each of its first words needs. Rows of kind 'hot' have in block the first word and in a the
    blocks that ask, kind 'pairs' (block null) the counts of counts."""

    def summed(group: pa.Table) -> pa.Table:
        h = [unpack_rising(x) for x in group.column("h").to_pylist()]
        cuts = np.cumsum([len(x) for x in h])[:-1]
        h = np.concatenate(h)
        w, c, trained, hot = (np.concatenate([unpack(x) for x in group.column(name).to_pylist()]) for name in ("w", "c", "trained", "hot"))
        if h.max(initial=0) < 1 << 31 and w.max(initial=0) < 1 << 32:
            order = np.argsort(h << 32 | w)
        else:
            order = np.lexsort((w, h))
        new = np.ones(len(h), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
        first = np.flatnonzero(new)
        count = np.add.reduceat(trained[order], first)
        which = np.empty(len(h), np.int64)
        which[order] = np.cumsum(new) - 1
        # by first word, over the different bigrams
        head = h[order[first]]
        start = runs(head)
        seen = count > 0
        classes = np.empty((len(start), FREQUENT + 1), np.int64)
        for r in range(1, FREQUENT + 1):
            classes[:, r - 1] = np.add.reduceat(count == r, start, dtype=np.int64)
        classes[:, FREQUENT] = np.add.reduceat(np.where(count > FREQUENT, count, 0), start)
        covered = np.add.reduceat(np.where(seen, unigram(c[order[first]]), 0.0), start)
        head_of = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(head))))
        part = group.column("part")[0].as_py()
        rows = [{"kind": "pairs", "part": part, "a": np.array(_counts_of_counts(count[seen]), "<i8").tobytes()}]
        split = np.unique(head_of[which[hot.astype(bool)]])
        asking: dict[int, list[int]] = {int(i): [] for i in split}
        for block, mine, is_hot in zip(group.column("block").to_pylist(), np.split(which, cuts), np.split(hot, cuts)):
            heads = head_of[mine][runs(head_of[mine])]
            rows.append({"block": block, "kind": "bigrams", "part": part, "a": pack(count[mine]), "b": pack(classes[heads].ravel()), "c": covered[heads].astype("<f8").tobytes()})
            for i in np.unique(head_of[mine[is_hot.astype(bool)]]):
                asking[int(i)].append(block)
        for i in split:
            rows.append({"block": int(head[start[i]]), "kind": "hot", "part": part, "a": pack(np.array(asking[int(i)])), "b": pack(classes[i]), "c": covered[i : i + 1].astype("<f8").tobytes()})
        return arrow_table(_ANSWER, rows)

    return requests.groupBy("part").applyInArrow(summed, _ANSWER)


def _hot_answers(answers: DataFrame) -> DataFrame:
    """For each split first word, its sums over all parts, to every block that asks."""
    names = [f"n{i}" for i in range(FREQUENT + 1)]
    plain = f"h long, asks long, covered double, {', '.join(f'{n} long' for n in names)}"

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asks, classes = unpack(row["a"]), unpack(row["b"])
                n = len(asks) + 1  # the first row has the sums, the others name the blocks
                cell = lambda value, kind: pa.array([value] + [None] * (n - 1), kind)
                yield pa.RecordBatch.from_pydict(
                    {"h": pa.array([row["block"]] * n, pa.int64()), "asks": pa.array([None, *asks.tolist()], pa.int64()), "covered": cell(float(np.frombuffer(row["c"], "<f8")[0]), pa.float64())}
                    | {name: cell(int(x), pa.int64()) for name, x in zip(names, classes)}
                )

    rows = settled(answers.where("kind = 'hot'").select("block", "a", "b", "c").mapInArrow(opened, plain), "hot-words")
    sums = rows.where("asks IS NULL").groupBy("h").agg(F.sum("covered").alias("covered"), *[F.sum(n).alias(n) for n in names])
    asks = rows.where("asks IS NOT NULL").select("h", F.col("asks").alias("block")).distinct()
    return asks.join(sums, "h").select("block", "h", "covered", F.array(*names).alias("classes"))


# ---- 4: probabilities -----------------------------------------------------------------

_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(
    texts: DataFrame, answers: DataFrame, parts: int, starts: int, hot_word: int, unigram: Unigrams, pairs: np.ndarray
) -> DataFrame:
    discounts = good_turing(pairs)

    def scored(texts: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.to_pylist()
        block = _Block(texts, [x for x in answers if x["kind"] == "words"])
        use, part, _ = block.asked(parts, starts, hot_word)
        count = np.zeros(len(block.h), np.int64)
        size = len(block.count)
        classes, covered = np.zeros((size, FREQUENT + 1), np.int64), np.zeros(size)
        cut = dict(zip(part[runs(part)].tolist(), np.split(use, runs(part)[1:])))
        for x in answers:
            if x["kind"] == "bigrams":
                mine = cut[x["part"]]
                count[mine] = unpack(x["a"])
                heads = block.h[mine][runs(block.h[mine])]
                classes[heads] = unpack(x["b"]).reshape(-1, FREQUENT + 1)
                covered[heads] = np.frombuffer(x["c"], "<f8")
        local = {int(n): i for i, n in enumerate(block.number)} if any(x["kind"] == "hot" for x in answers) else {}
        for x in answers:
            if x["kind"] == "hot":
                h = local[x["h"]]
                classes[h], covered[h] = x["classes"], x["covered"]
        total, left = _mass(classes, discounts)
        seen_before = classes.sum(-1) > 0
        weight = np.where(seen_before, left / total / (1 - covered), 1.0)
        lower = unigram(block.count[block.w])
        found = discounts[np.minimum(count, FREQUENT + 1)] * count / total[block.h]
        p = np.where(count > 0, found, weight[block.h] * lower)
        by_token = np.empty(len(block.tokens))
        by_token[block.order] = np.repeat(np.log10(p), np.diff(np.append(block.first, len(block.tokens))))
        per_text = lambda values: np.add.reduceat(values, block.starts)
        known = (block.count > 0)[block.tokens]
        return pa.table(
            {
                "doc_id": block.ids,
                "held_out": pa.array(block.held),
                "n_tokens": block.lengths,
                "n_known": per_text(known.astype(np.int64)),
                "train_tokens": np.full(len(block.lengths), unigram.n, np.int64),
                "base_score": per_text(unigram.base(block.count)[block.tokens]),
                "score": per_text(by_token),
            }
        )

    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, _SCORED)


def op12_katz_scores(
    docs: DataFrame, key: str = "doc_id", text: str = "text", part_bytes: int = PART, hot_word: int = HOT_WORD
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every text.

    ``part_bytes`` and ``hot_word`` say how finely tables are divided; no result depends on them.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    rows = settled(_block_rows(docs, key, text, parts), "katz-blocks")
    texts = rows.where("part IS NULL").select("block", "doc_ids", "nulls", "held", "lengths", "tokens")
    starts = rows.agg(F.sum("n_trained")).first()[0] or 0
    words = settled(_words(rows, parts), "katz-words")
    unigram = Unigrams(_totals(words, "totals"))
    own = words.where("kind = 'words'")
    bigrams = settled(_bigrams(_bigram_requests(texts, own.select("block", "a", "b", "c"), parts, starts, hot_word), unigram), "katz-bigrams")
    pairs = _totals(bigrams, "pairs")
    answers = own.unionByName(bigrams.where("kind = 'bigrams'")).unionByName(
        _hot_answers(bigrams).withColumn("kind", F.lit("hot")), allowMissingColumns=True
    )
    return _scored(texts, answers, parts, starts, hot_word, unigram, pairs)

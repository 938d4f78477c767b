"""Links between the tokens that two tokenizers make of the same text.

1. Texts are cut where neither tokenizer joins what stands on both sides; about 12 MB of whole
   texts are a block, and each different piece of a block is encoded and aligned once. A
   dictionary from cumulative byte end to index is made for each tokenizer; the ends that both
   hash sets hold, sorted, slice both lists of ids into groups, and each slice is expanded into
   its links.
2. Each block counts, for every pair of ids, how many of its texts hold it linked. Pairs are dealt
   by hash, so what is shuffled has one entry for each block at most, however frequent a pair is.
   Each part adds up the counts and answers every block; the highest count of each id of the
   first tokenizer is a table bounded by its vocabulary, which is collected and broadcast.
3. Each block adds up, for each piece and then for each text, the counts of its links.

Cuts are made at single blanks between signs that are no white space. They are proved from the
files: the first tokenizer must keep such a blank with the sign after it (byte level with its own
expression and no normaliser), the second must have no normaliser and no piece with a blank mark
behind another sign. If either does not hold, each whole text is one piece.

Defined results: null and empty texts, and texts whose bytes are not given back by both tokenizers
(those that hold the blank mark U+2581 for one), have zeros and an empty ``groups_sha256``, and
hold no pair. A null id stays null. Rows that repeat are documents of their own, and count each.
An empty table gives no rows. A text of any length is in one block (some 60 bytes of memory for
each byte of it without blanks, much less otherwise); groups of many tokens are expanded by
their different ids. Extra columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.packing import arrow_table, pack, pack_rising, runs, unpack, unpack_rising
from tablecraft.llm.textblocks import mix
from tablecraft.shared import settled

#: Bytes of text in a block, and bytes of text for each part of the table of pairs.
BLOCK = 12 << 20
PART = 1 << 23
#: Pieces that are encoded and aligned together.
SLICE = 1 << 13
#: Links of a group beyond which its different ids are paired, with how often they meet.
LARGE_GROUP = 1 << 12
#: Texts and links that are looked at together when pairs are counted.
_AT_ONCE = 1 << 21
_BLANK = "▁"
#: White space, and texts in which a blank stands beside some, or at an end.
_SPACE = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_ODD = f"{_SPACE} | {_SPACE}|^ | $"
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Letters, then signs: the expression of byte-level files takes each of the two whole.
_PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+)([.,;:!?]*)")


def _byte_signs() -> dict[str, int]:
    """Signs of byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the groups of pieces of text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        signs, vocabulary = _byte_signs(), self.a.get_vocab()
        self.signs = {b: c for c, b in signs.items()}
        self.blank = self.signs[32]
        self.ends: dict[str, list[int]] = {}
        size = max(vocabulary.values()) + 1
        self.bytes_a = [b""] * size
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        hexes = [re.fullmatch("<0x([0-9A-F]{2})>", p) for p in pieces]
        self.bytes_b = [bytes([int(h[1], 16)]) if h else p.replace(_BLANK, " ").encode() for p, h in zip(pieces, hexes)]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # Digest pieces: an id and what stands behind it.
        self.written = [f"{i}{end}".encode() for n, ends in ((size, ",|"), (len(pieces), ",;")) for end in ends for i in range(n)]
        self.offsets = (0, size, 2 * size, 2 * size + len(pieces))
        self.n_b = len(pieces)
        self.cuts = self._cuts_hold(json.loads(self.a.to_str()), sentencepiece_model_pb2.ModelProto, path_b, pieces)

    @staticmethod
    def _cuts_hold(a: dict, proto, path_b: str, pieces: list[str]) -> bool:
        step = a["pre_tokenizer"] or {}
        first = a["normalizer"] is None and step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
        model = proto()
        with open(path_b, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        plain = rules.name == "identity" and not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        own_signs = any(p.type == 4 for p in model.pieces)  # user-defined pieces
        return bool(first and plain and not own_signs and not any(re.search(f"[^{_BLANK}]{_BLANK}", p) for p in pieces))

    def split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """The order in which texts are taken, their numbers of pieces, each piece's place among
        the different pieces, and these: parts of a text, without the blank before each, that both
        tokenizers take one by one. An empty text has none."""
        length = pc.binary_length(texts)
        if self.cuts:
            odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        else:
            odd = np.ones(len(texts), bool)
        empty = length.to_numpy() == 0
        plain, rest = np.flatnonzero(~odd & ~empty), np.flatnonzero(odd | empty)
        cut = _CUT.split if self.cuts else lambda text: [text]
        by_hand = [cut(t) if t else [] for t in texts.take(pa.array(rest)).to_pylist()]
        lists = [pc.split_pattern(texts.take(pa.array(plain)), " "), pa.array(by_hand, pa.list_(texts.type))]
        n_pieces = np.concatenate([x.value_lengths().to_numpy(zero_copy_only=False) for x in lists]).astype(np.int64)
        found = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
        piece, pieces = found.indices.to_numpy().astype(np.int64), found.dictionary.to_numpy(zero_copy_only=False).tolist()
        # Pieces with outer white space stand last, so that most can be encoded together.
        outer = np.fromiter((p[0].isspace() or p[-1].isspace() for p in pieces), bool, len(pieces))
        last = np.argsort(outer, kind="stable")
        place = np.empty(len(last), np.int64)
        place[last] = np.arange(len(last))
        return np.concatenate([plain, rest]), n_pieces, place[piece], [pieces[i] for i in last]

    def _ids_a(self, piece: str) -> list[int] | None:
        """Ids of letters and the signs behind them, from the model without the steps before it."""
        match = _PLAIN.fullmatch(piece)
        if match is None:
            return None
        letters, signs = match.groups()
        said = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.signs)
        found = [token.id for token in self.a.model.tokenize(self.blank + said)]
        if signs:
            if signs not in self.ends:
                if len(self.ends) > 10_000:
                    self.ends.clear()
                self.ends[signs] = self.a.encode(signs, add_special_tokens=False).ids
            found += self.ends[signs]
        return found

    def _together(self, pieces: list[str]) -> tuple[list[int], list[int]] | None:
        """Ids of many pieces one after another, if the bytes of both are the text of the pieces."""
        known = [self._ids_a(p) for p in pieces]
        others = [p for p, ids in zip(pieces, known) if ids is None]
        rest = self.a.encode(" " + " ".join(others), add_special_tokens=False).ids if others else []
        sizes = np.cumsum([len(p.encode()) + 1 for p in others])
        ends = np.searchsorted(np.cumsum(self.length_a[rest]), sizes, "right").tolist()
        parts = iter(rest[i:j] for i, j in zip([0, *ends], ends))
        a = list(chain.from_iterable(next(parts) if ids is None else ids for ids in known))
        text = " ".join(pieces)
        said = b" " + text.encode()
        b = self.b.encode(text)
        same = b"".join(map(self.bytes_a.__getitem__, a)) == said == b"".join(map(self.bytes_b.__getitem__, b))
        return (a, b) if same else None

    def _alone(self, piece: str) -> tuple[list[int], list[int]] | None:
        """Ids of a piece, if the bytes of both are a blank and the piece."""
        said = b" " + piece.encode()
        a = self.a.encode(" " + piece, add_special_tokens=False).ids
        b = self.b.encode(piece)
        same = b"".join(map(self.bytes_a.__getitem__, a)) == said == b"".join(map(self.bytes_b.__getitem__, b))
        return (a, b) if same else None

    def align(self, pieces: list[str]) -> Aligned:
        """Groups and links of different pieces, some thousand pieces at once."""
        return Aligned([self._slice(pieces[i : i + SLICE], i) for i in range(0, len(pieces), SLICE)], self.n_b)

    def _slice(self, pieces: list[str], number: int) -> Slice:
        # White space at an end would run together with the blank between two pieces.
        alone = not self.cuts or any(p[0].isspace() or p[-1].isspace() for p in pieces)
        together = None if alone else self._together(pieces)
        found = [together] if together else [self._alone(p) for p in pieces]
        right = np.ones(len(pieces), bool)
        if not together:
            right[[i for i, both in enumerate(found) if both is None]] = False
        a, b = (np.array(list(chain.from_iterable(both[k] for both in found if both)), np.int64) for k in (0, 1))
        size = np.array([len(p) if p.isascii() else len(p.encode()) for p in pieces], np.int64) + 1
        ends_a, ends_b, ends = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b]), np.cumsum(size * right)
        n_a, n_b = (np.diff(np.searchsorted(x, ends, "right"), prepend=0) for x in (ends_a, ends_b))
        index_a = dict(zip(ends_a.tolist(), range(1, len(a) + 1)))
        index_b = dict(zip(ends_b.tolist(), range(1, len(b) + 1)))
        common = sorted(index_a.keys() & index_b.keys())
        cut_a = np.array([0, *map(index_a.__getitem__, common)], np.int64)
        cut_b = np.array([0, *map(index_b.__getitem__, common)], np.int64)
        return Slice(self, number, right, a, b, n_a, n_b, cut_a, cut_b)


class Slice:
    """Groups and links of some different pieces; ``number`` is the place of the first."""

    def __init__(self, aligner: Aligner, number: int, right, a, b, n_a, n_b, cut_a, cut_b):
        self.right, self.n_a, self.n_b = right, n_a, n_b
        in_a, in_b = np.diff(cut_a), np.diff(cut_b)
        group_piece = np.repeat(np.arange(len(n_a)), n_a)[cut_a[1:] - 1]
        self.n_groups = np.bincount(group_piece, minlength=len(n_a))
        self.n_links = np.bincount(group_piece, in_a * in_b, minlength=len(n_a)).astype(np.int64)
        self.digests = self._digests(aligner, a, b, cut_a, cut_b, group_piece)
        self._link(aligner.n_b, a, b, cut_a, cut_b, group_piece + number)

    def _digests(self, aligner: Aligner, a, b, cut_a, cut_b, group_piece) -> list[bytes]:
        """What each piece adds to the text that is hashed: ``a1,a2|b1;`` for each group."""
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        last_a[cut_a[1:] - 1] = last_b[cut_b[1:] - 1] = True
        at = aligner.offsets
        written = np.concatenate([a + np.where(last_a, at[1], at[0]), b + np.where(last_b, at[3], at[2])])
        # tokens of a stand before those of b in every group
        group = np.concatenate([np.repeat(np.arange(len(group_piece)), np.diff(cut)) for cut in (cut_a, cut_b)])
        written = written[np.argsort(group * 2 + np.repeat([0, 1], [len(a), len(b)]), kind="stable")]
        parts = list(map(aligner.written.__getitem__, written.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(parts[i:j]) for i, j in zip([0, *ends], ends)]

    def _link(self, n_b: int, a, b, cut_a, cut_b, group_piece) -> None:
        """One entry for every link: its pair of ids, its piece, and how often it is meant."""
        in_a, in_b = np.diff(cut_a), np.diff(cut_b)
        large = np.flatnonzero(in_a * in_b > LARGE_GROUP)
        few = np.flatnonzero(in_a * in_b <= LARGE_GROUP)
        n = (in_a * in_b)[few]
        group = np.repeat(few, n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        pair = [a[cut_a[group] + k // in_b[group]] * n_b + b[cut_b[group] + k % in_b[group]]]
        piece, times = [group_piece[group]], [np.ones(len(group), np.int64)]
        for g in large:
            ids_a, often_a = np.unique(a[cut_a[g] : cut_a[g + 1]], return_counts=True)
            ids_b, often_b = np.unique(b[cut_b[g] : cut_b[g + 1]], return_counts=True)
            pair.append((ids_a[:, None] * n_b + ids_b).ravel())
            times.append((often_a[:, None] * often_b).ravel())
            piece.append(np.full(len(pair[-1]), group_piece[g]))
        self.pair, self.piece, self.times = np.concatenate(pair), np.concatenate(piece), np.concatenate(times)


class Aligned:
    """Different pieces of a block: figures and digests of each, and its links: different pairs
    (``pairs``), frequent ones first; per piece ``n_own`` entries of ``own`` (places in ``pairs``)
    with ``times``, how often the piece links them."""

    def __init__(self, slices: list[Slice], n_b: int):
        def whole(name: str, kind: type) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *[getattr(s, name) for s in slices]])

        self.right = whole("right", bool)
        self.n_a, self.n_b, self.n_groups, self.n_links = (whole(x, np.int64) for x in ("n_a", "n_b", "n_groups", "n_links"))
        self.digests = [d for s in slices for d in s.digests]
        pair, piece, times = (whole(x, np.int64) for x in ("pair", "piece", "times"))
        order = np.argsort(pair)
        first = runs(pair[order])
        size = np.diff(np.append(first, len(pair)))
        by_size = np.argsort(-size, kind="stable")
        self.pairs = pair[order[first]][by_size]
        place = np.empty(len(first), np.int64)
        place[by_size] = np.arange(len(first))
        own = np.empty(len(pair), np.int64)
        own[order] = np.repeat(place, size)
        # entries of a piece together, each pair once
        code = piece * max(1, len(first)) + own
        order = np.argsort(code)
        first = runs(code[order])
        self.own, self.times = own[order[first]], np.add.reduceat(times[order], first) if len(first) else times
        self.n_own = np.bincount(piece[order[first]], minlength=len(self.n_a))

    def texts_with(self, n_pieces: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """For each pair, the number of texts that link it; texts are lists of pieces."""
        total = np.zeros(len(self.pairs), np.int64)
        starts = np.cumsum(self.n_own) - self.n_own
        text = np.repeat(np.arange(len(n_pieces)), n_pieces)
        ends = np.cumsum(self.n_own[piece]) if len(piece) else np.zeros(0, np.int64)
        bounds = np.append(0, ends)[np.append(0, np.cumsum(n_pieces))]  # links before each text
        low = 0
        while low < len(n_pieces):
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + _AT_ONCE, "right")) - 1)
            high = min(high, len(n_pieces))
            mine = slice(int(n_pieces[:low].sum()), int(n_pieces[:high].sum()))
            code = np.sort(text[mine] * len(self.n_own) + piece[mine])
            code = code[runs(code)]
            t, p = np.divmod(code, len(self.n_own))
            n = self.n_own[p]
            k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            held = np.sort(np.repeat(t, n) * len(self.pairs) + self.own[np.repeat(starts[p], n) + k])
            total += np.bincount(held[runs(held)] % max(1, len(self.pairs)), minlength=len(self.pairs))
            low = high
        return total


@cache
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """One for each Python worker, shared by its tasks one after another."""
    return Aligner(path_a, path_b)


# ---- 1: blocks of texts ---------------------------------------------------------------

_TEXT_COLUMNS = ("doc_ids", "nulls", "n_a", "n_b", "n_groups", "n_links", "digests", "n_pieces", "pieces", "n_own", "own", "times")
_BLOCKS = "block long, part int, pairs binary, locals binary, texts binary, " + ", ".join(f"{c} binary" for c in _TEXT_COLUMNS)
_ANSWER = "block long, part int, locals binary, a binary, counts binary"


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of ``n`` values each, 0 for none."""
    ends = np.cumsum(n)
    sums = np.append(0, np.cumsum(values))
    return sums[ends] - sums[ends - n]


def _block_rows(docs: DataFrame, paths: tuple[str, str], key: str, text: str, parts: int) -> DataFrame:
    """Rows of two kinds: the texts of a block (part null), and its pairs in one part of the table."""

    def rows_of(block: int, ids: pa.Array, texts: pa.Array) -> list[dict]:
        aligner = aligner_of(*paths)
        taken, n_pieces, piece, pieces = aligner.split(texts)
        ids = ids.take(pa.array(taken))
        found = aligner.align(pieces)
        whole = _sums(~found.right[piece], n_pieces) == 0
        piece, n_pieces = piece[np.repeat(whole, n_pieces)], n_pieces * whole
        ends = np.cumsum(n_pieces).tolist()
        said = list(map(found.digests.__getitem__, piece.tolist()))
        digests = [hashlib.sha256(b"".join(said[i:j])[:-1]).digest() if j > i else bytes(32) for i, j in zip([0, *ends], ends)]
        texts_with = found.texts_with(n_pieces, piece)
        per_text = {name: pack(_sums(getattr(found, name)[piece], n_pieces)) for name in ("n_a", "n_b", "n_groups", "n_links")}
        # frequent pieces get low numbers
        often = np.bincount(piece, minlength=len(found.right))
        order = np.argsort(-often, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        order = order[: int((often > 0).sum())]
        n_own = found.n_own[order]
        k = np.arange(int(n_own.sum())) - np.repeat(np.cumsum(n_own) - n_own, n_own)
        entry = np.repeat((np.cumsum(found.n_own) - found.n_own)[order], n_own) + k
        rows = [
            {
                "block": block,
                "doc_ids": ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                "nulls": np.packbits(ids.is_null().to_numpy(zero_copy_only=False)).tobytes(),
                "digests": b"".join(digests),
                "n_pieces": pack(n_pieces),
                "pieces": pack(place[piece]),
                "n_own": pack(n_own),
                "own": pack(found.own[entry]),
                "times": pack(found.times[entry]),
            }
            | per_text
        ]
        held = np.flatnonzero(texts_with)  # pairs of texts without tokens are held by none
        part = (mix(found.pairs[held].astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        for mine in np.split(held[order], runs(part[order])[1:]) if len(held) else []:
            rows.append(
                {"block": block, "part": int(mix(found.pairs[mine[:1]].astype(np.uint64))[0] % np.uint64(parts)), "pairs": pack(found.pairs[mine]), "locals": pack_rising(mine), "texts": pack(texts_with[mine])}
            )
        return rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        gc.disable()  # millions of short lists that hold no cycles
        for batch in batches:
            texts, ids = batch.column("_text"), batch.column("_key")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy())
            i = 0
            while i < len(texts):
                before = int(sizes[i - 1]) if i else 0
                j = max(i + 1, int(np.searchsorted(sizes, before + BLOCK, "right")))
                yield from arrow_table(_BLOCKS, rows_of(block, ids.slice(i, j - i), texts.slice(i, j - i))).to_batches()
                block, i = block + 1, j

    rows = docs.select(F.col(key).cast("long").alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    return rows.mapInArrow(cut, _BLOCKS)


# ---- 2: pairs -------------------------------------------------------------------------


def _pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """Answers to each block: the count of each of its pairs, and its id of the first tokenizer."""

    def summed(group: pa.Table) -> pa.Table:
        pairs = [unpack(x) for x in group.column("pairs").to_pylist()]
        cuts = np.cumsum([len(p) for p in pairs])[:-1]
        every = np.concatenate(pairs)
        order = np.argsort(every)
        first = runs(every[order])
        texts = np.concatenate([unpack(x) for x in group.column("texts").to_pylist()])
        count = np.empty(len(every), np.int64)
        count[order] = np.repeat(np.add.reduceat(texts[order], first), np.diff(np.append(first, len(every))))
        blocks, locals_ = group.column("block").to_pylist(), group.column("locals").to_pylist()
        part = group.column("part")[0].as_py()
        said = [
            {"block": block, "part": part, "locals": own, "a": pack(p // n_b), "counts": pack(c)}
            for block, own, p, c in zip(blocks, locals_, pairs, np.split(count, cuts))
        ]
        return arrow_table(_ANSWER, said)

    return rows.where("part IS NOT NULL").select("block", "part", "pairs", "locals", "texts").groupBy("part").applyInArrow(summed, _ANSWER)


def _highest(answers: DataFrame, size: int) -> np.ndarray:
    """The highest count of each id of the first tokenizer: at most one row for each id."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.zeros(size, np.int64)
        for batch in batches:
            for a, counts in zip(batch.column("a").to_pylist(), batch.column("counts").to_pylist()):
                np.maximum.at(top, unpack(a), unpack(counts))
        used = np.flatnonzero(top)
        yield pa.RecordBatch.from_pydict({"a": used.astype(np.int64), "top": top[used]})

    table = answers.select("a", "counts").mapInArrow(best, "a long, top long").groupBy("a").agg(F.max("top").alias("top")).toArrow()
    top = np.zeros(size, np.int64)
    top[table.column("a").to_numpy()] = table.column("top").to_numpy()
    return top


# ---- 3: sums over the links of each text ----------------------------------------------

_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _aligned(texts: DataFrame, answers: DataFrame, top: np.ndarray) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(top)

    def summed(texts: pa.Table, answers: pa.Table) -> pa.Table:
        row = texts.to_pylist()[0]
        n_pieces, piece, n_own, own, times = (unpack(row[c]) for c in ("n_pieces", "pieces", "n_own", "own", "times"))
        count = np.zeros(int(own.max(initial=0)) + 1, np.int64)
        best = np.zeros(len(count), np.int64)
        for answer in answers.to_pylist():
            at, counts = unpack_rising(answer["locals"]), unpack(answer["counts"])
            count[at], best[at] = counts, counts == shared.value[unpack(answer["a"])]
        n = len(n_pieces)
        nulls = np.unpackbits(np.frombuffer(row["nulls"], np.uint8), count=n).astype(bool)
        hexes, none = row["digests"].hex(), "0" * 64
        digests = [hexes[64 * i : 64 * i + 64] for i in range(n)]
        return pa.table(
            {"doc_id": pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=nulls)}
            | {name: unpack(row[name]) for name in ("n_a", "n_b", "n_groups", "n_links")}
            | {name: _sums(_sums(times * value[own], n_own)[piece], n_pieces) for name, value in (("n_best", best), ("count_sum", count))}
            | {"groups_sha256": ["" if d == none else d for d in digests]}
        )

    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(summed, _ALIGNED)


def op11_token_alignment(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", part_bytes: int = PART
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every text.

    ``path_a`` is a byte-level file for tokenizers, ``path_b`` one for sentencepiece; both must be
    at these places on every executor. No result depends on ``part_bytes``.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    rows = settled(_block_rows(docs, (path_a, path_b), key, text, parts), "aligned-blocks")
    aligner = aligner_of(path_a, path_b)
    answers = settled(_pair_counts(rows, aligner.n_b), "aligned-pairs")
    texts = rows.where("part IS NULL").select("block", *_TEXT_COLUMNS)
    return _aligned(texts, answers, _highest(answers, len(aligner.bytes_a)))

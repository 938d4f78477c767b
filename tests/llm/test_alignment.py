"""Aligned tokens against whole texts encoded and aligned one by one."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tablecraft.llm import alignment

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block long, part string"


class Plain:
    """Whole texts, with the libraries alone."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer
        from tokenizers.decoders import ByteLevel  # noqa: F401

        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.sign = {chr(x): x for x in kept}
        self.sign |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in kept)}

    def bytes_a(self, i):
        return bytes(self.sign[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        if not b"".join(map(self.bytes_a, a)) == b"".join(map(self.bytes_b, b)) == b" " + text.encode():
            return []
        ends = []
        for ids, of in ((a, self.bytes_a), (b, self.bytes_b)):
            ends.append(np.cumsum([len(of(i)) for i in ids]).tolist())
        common = set(ends[0]) & set(ends[1])
        groups, last_a, last_b = [], 0, 0
        for end in sorted(common):
            i, j = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append((a[last_a:i], b[last_b:j]))
            last_a, last_b = i, j
        return groups


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(plain, rows):
    every = [plain.groups(r[1]) for r in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in every]
    count = Counter(pair for found in links for pair in found)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for row, groups, found in zip(rows, every, links):
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append(
            (
                row[0],
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                sum(found.values()),
                sum(n for pair, n in found.items() if count[pair] == best[pair[0]]),
                sum(n * count[pair] for pair, n in found.items()),
                hashlib.sha256(said.encode()).hexdigest() if groups else "",
            )
        )
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def odd_texts():
    rng = random.Random(8)
    signs = list("abcdefgéüßÀ'’\"-.,;:!?()[]{}#$%0123456789 \n\t    　​\x1c\x85\x00中文字ёжя\U0001f600ﬁ×÷ǆªº²") + ["'s", "'ll", " <s>", "</s>", "<|endoftext|>", "<unk>", "<0x41>", "  ", "\n\n", "\r\n", " \n "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(150)]
    words = ["the", "Haus", "straße", "réseau", "token", "alignment", "1234", "don't", "x=3;", "naïve", "end.", "what?!", "(a)", "AKIA99", "a—b"]
    texts += [" ".join(rng.choice(words) for _ in range(40)) for _ in range(40)]
    texts += ["", None, " ", "  a", "a  ", "▁", "a ▁ b", "word", "word " * 300, "a" * 3000, "中" * 400, "\n", "\n\n a", "ab" * 2000 + "'s", "é" * 777]
    return texts


def test_equals_whole_texts(spark, plain):
    rows = [(i, t, 1, "p") for i, t in enumerate(odd_texts())]
    rows += [(None, "the Haus", None, None), (None, None, None, None), rows[160], rows[160], rows[161]]
    frame = alignment.op11_token_alignment(spark.createDataFrame(rows, SCHEMA).repartition(4), A, B, part_bytes=1 << 10)
    assert frame.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ordered(frame.collect()) == ordered(expected(plain, rows))


def test_pieces_give_the_tokens_of_the_whole_text(plain):
    aligner = alignment.Aligner(A, B)
    assert aligner.cuts
    texts = [t for t in odd_texts() if t and "▁" not in t]
    order, n_pieces, piece, pieces = aligner.split(pa.array(texts))
    found = aligner.align(pieces)
    assert found.right.all()
    ends = np.cumsum(n_pieces)
    for t, i, j in zip(order, ends - n_pieces, ends):
        said = b"".join(found.digests[p] for p in piece[i:j])
        groups = plain.groups(texts[t])
        assert said.decode() == "".join(f"{','.join(map(str, a))}|{','.join(map(str, b))};" for a, b in groups)


def test_without_cuts_each_text_is_a_piece(plain):
    aligner = alignment.Aligner(A, B)
    aligner.cuts = False
    texts = ["the Haus ▁ token", "the Haus", "", "a b"]
    order, n_pieces, piece, pieces = aligner.split(pa.array(texts))
    assert sorted(pieces) == ["a b", "the Haus", "the Haus ▁ token"]
    found = aligner.align(pieces)
    assert found.right.tolist() == ["▁" not in p for p in pieces]
    assert found.n_groups.tolist() == [len(plain.groups(p)) for p in pieces]


def test_large_groups_are_counted_by_their_ids(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "LARGE_GROUP", 0)
    aligner = alignment.Aligner(A, B)
    texts = [t for t in odd_texts() if t and "▁" not in t]
    order, n_pieces, piece, pieces = aligner.split(pa.array(texts))
    large = aligner.align(pieces)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1 << 40)
    small = aligner.align(pieces)
    assert large.n_links.tolist() == small.n_links.tolist()
    for one in (large, small):
        starts = np.cumsum(one.n_own) - one.n_own
        assert [sorted(zip(one.pairs[one.own[s : s + n]].tolist(), one.times[s : s + n].tolist())) for s, n in zip(starts, one.n_own)] == [
            sorted(Counter(x * aligner.n_b + y for a, b in plain.groups(p) for x in a for y in b).items()) for p in pieces
        ]


def test_texts_with_a_pair_in_small_steps(monkeypatch):
    aligner = alignment.Aligner(A, B)
    texts = [t for t in odd_texts() if t]
    _, n_pieces, piece, pieces = aligner.split(pa.array(texts))
    found = aligner.align(pieces)
    whole = found.texts_with(n_pieces, piece)
    monkeypatch.setattr(alignment, "_AT_ONCE", 3)
    assert (found.texts_with(n_pieces, piece) == whole).all()


def test_empty_tables_and_nothing_to_align(spark):
    assert alignment.op11_token_alignment(spark.createDataFrame([], SCHEMA), A, B).collect() == []
    rows = [(1, "", None, None), (2, None, None, None), (3, "▁", None, None)]
    found = alignment.op11_token_alignment(spark.createDataFrame(rows, SCHEMA), A, B).collect()
    assert ordered(found) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_a_very_long_text(spark, plain):
    rng = random.Random(2)
    text = " ".join(rng.choice(["long", "texte", "wörter", "are", "one.", "block\nof"]) for _ in range(3_000))
    rows = [(1, text, 0, ""), (2, "long", 0, ""), (3, text, 0, "")]
    found = alignment.op11_token_alignment(spark.createDataFrame(rows, SCHEMA), A, B).collect()
    assert ordered(found) == ordered(expected(plain, rows))

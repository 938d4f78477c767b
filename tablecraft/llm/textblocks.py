"""Words, lines and shingles of many texts at once, as numpy arrays over their bytes.

Used inside Arrow batches. A block holds whole texts of about ``BLOCK_BYTES`` bytes (or one
longer text), so memory follows the block and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LETTERS = np.random.default_rng(20260101).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * _MIX
    values ^= values >> np.uint64(29)
    values *= _BASE
    values ^= values >> np.uint64(32)
    return values


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        n = max(n, BLOCK_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


class Block:
    """Bytes of consecutive texts; ``starts[i]:starts[i + 1]`` is text i."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, first: int):
        self.data, self.starts, self.first = data, starts, first
        self.n_texts = len(starts) - 1
        size = len(data)
        self.is_space = (data == 32) | ((data >= 9) & (data <= 13))
        edges = starts[:-1][starts[:-1] < starts[1:]]  # first bytes of texts that have any
        after = np.empty(size, bool)
        before = np.empty(size, bool)
        if size:
            before[0] = after[-1] = True
            before[1:] = self.is_space[:-1]
            after[:-1] = self.is_space[1:]
            before[edges] = True
            after[edges[1:] - 1] = True
        self.word_start = np.flatnonzero(before & ~self.is_space)
        self.word_end = np.flatnonzero(after & ~self.is_space) + 1
        self.word_text = np.searchsorted(starts, self.word_start, "right") - 1
        self._sums: np.ndarray | None = None

    @property
    def n_words(self) -> np.ndarray:
        return np.bincount(self.word_text, minlength=self.n_texts)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the strings ``start:end``; equal strings have equal hashes."""
        up, down = _power_tables(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_LETTERS[self.data] * up[: len(self.data)], out=self._sums[1:])
        value = (self._sums[end] - self._sums[start]) * down[start]
        return mix(value + (end - start).astype(np.uint64) * _MIX)

    def word_hashes(self) -> np.ndarray:
        return self.hashes(self.word_start, self.word_end)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Number of flagged bytes of each text."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def windows(self, words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``width`` consecutive words of one text, and the number of their text."""
        n = len(words) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        value = words[:n].copy()
        for k in range(1, width):
            value = mix(value * _BASE + words[k : k + n])
        inside = self.word_text[:n] == self.word_text[width - 1 :]
        return value[inside], np.flatnonzero(inside)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """start, end and text of every line, split at line feeds; empty texts have one."""
        feeds = np.flatnonzero(self.data == 10)
        start = np.concatenate([self.starts[:-1], feeds + 1])
        text = np.concatenate([np.arange(self.n_texts), np.searchsorted(self.starts, feeds, "right") - 1])
        order = np.lexsort((start, text))
        start, text = start[order], text[order]
        end = np.empty_like(start)
        end[:-1] = np.where(text[1:] == text[:-1], start[1:] - 1, self.starts[text[:-1] + 1])
        if len(end):
            end[-1] = self.starts[text[-1] + 1]
        return start, end, text


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES, table: np.ndarray | None = None) -> Iterator[Block]:
    """Blocks of an Arrow string array; null texts are empty. ``table`` maps each byte first."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, len(texts))
        part = data[offsets[i] : offsets[j]]
        yield Block(part if table is None else table[part], offsets[i : j + 1] - offsets[i], i)
        i = j


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether an equal one stands before."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(keys), bool)
    many = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    return many, again

"""Removal of passages of 50 bytes that an earlier document holds, by suffix sorting.

A global suffix sort of every byte would move many times the input, so the text is first cut
where equal text is cut alike, which loses nothing:

1. The anchor of a window of ``LENGTH`` bytes is its least ``GRAM``-byte string by hash.
   Equal windows have equal anchors at equal places. Consecutive windows of one anchor form
   a cell. Cells meet by anchor; a cell whose whole content stands in a cell of an earlier
   document is repeated, and a cell whose anchor stands in one document only is not.
2. Anchors with several contents are open: windows of the one may stand in another. The
   least document of each such content sends it on. All windows with an anchor are in its
   contents, so anchors can be dealt over tasks, and each task sorts the suffixes of its
   contents by a difference cover modulo 3: sort the triples at two thirds of the places,
   name them, recurse on the names (until names span ``LENGTH`` bytes), sort the remaining
   suffixes by their first byte and the rank behind it, and merge. Adjacent suffixes whose
   first ``LENGTH`` bytes agree are equal windows; those of later documents are repeated.
3. Repeated windows of each document are joined to runs, and their bytes removed.

Hashes of 48 bits under an anchor decide whether cells are equal; windows are compared byte
by byte.

Defined results: a null or empty text has nothing to remove, nor has one under ``LENGTH``
bytes. Rows of a null id lose nothing and take nothing from others. Rows that repeat an id
don't take from each other. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.textblocks import Block, blocks, mix, repeated
from tablecraft.shared import settled

LENGTH = 50
GRAM = 16
GROUP_BYTES = 16 << 20  # text whose anchors meet in one group
OPEN_BYTES = 1 << 20  # open contents that are sorted in one group
BATCH_BYTES = 12 << 20
_PLACE = np.uint64((1 << 30) - 1)
_48 = np.uint64((1 << 48) - 1)


def cells(block: Block) -> tuple[np.ndarray, ...]:
    """anchor, content (48-bit hashes), text, first and last window start and place of the
    anchor of every cell."""
    size = len(block.data)
    n = size - LENGTH + 1
    if n <= 0:
        return tuple(np.zeros(0, np.uint64) for _ in range(2)) + tuple(np.zeros(0, np.int64) for _ in range(4))
    at = np.arange(size - GRAM + 1)
    grams = block.hashes(at, at + GRAM)
    least = (grams & ~_PLACE) | at.astype(np.uint64)
    span, width = 1, LENGTH - GRAM + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: -(width - span)], least[width - span :])
    anchor = (least & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(block.n_texts), np.diff(block.starts))[:n]
    inside = np.arange(n) + LENGTH <= block.starts[text + 1]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    new &= inside
    first = np.flatnonzero(new)
    ends = np.ones(n, bool)
    ends[:-1] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~inside[1:]
    last = np.flatnonzero(ends & inside)
    content = block.hashes(first, last + LENGTH) + (anchor[first] - first).astype(np.uint64)
    return mix(grams[anchor[first]]) & _48, mix(content) & _48, text[first], first, last, anchor[first]


def _key(anchor: np.ndarray, content: np.ndarray) -> np.ndarray:
    """One 64-bit name of a content under its anchor."""
    return mix(mix(anchor) + content)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of one length by byte planes, compressed."""
    planes = b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(data: bytes, n: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(n, 8, -1)
    return [np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes]


def _dealt(groups: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            anchor, content, doc = (np.concatenate(x) for x in zip(*held))
            group = (anchor % np.uint64(groups)).astype(np.int64)
            order = np.lexsort((doc, anchor, group))
            anchor, content, doc, group = anchor[order], content[order], doc[order], group[order]
            names, firsts = np.unique(group, return_index=True)
            bounds = [*firsts, len(group)]
            data = [_pack(anchor[a:b], content[a:b], doc[a:b]) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_pydict({"group": pa.array(names, pa.int64()), "cells": pa.array(data, pa.binary())})

        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for block in blocks(batch.column("text")):
                anchor, content, text, *_ = cells(block)
                if len(anchor):
                    held.append((anchor, content, ids[block.first + text].astype(np.uint64)))
                size += len(block.data)
                if size > BATCH_BYTES and held:
                    yield from packed()
                    held, size = [], 0
        if held:
            yield from packed()

    return deal


def _met(groups: int):
    """Per bucket of documents: document, name and kind (1: sent on) of the contents marked."""

    def met(key, table):
        doc, name, opened = _marks(table)
        bucket = (mix(doc.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((name, doc, bucket))
        doc, name, opened, bucket = doc[order], name[order], opened[order], bucket[order]
        names, firsts = np.unique(bucket, return_index=True)
        bounds = [*firsts, len(bucket)]
        data = [_pack(doc[a:b], name[a:b], opened[a:b]) for a, b in zip(bounds, bounds[1:])]
        return pa.table({"bucket": pa.array(names, pa.int64()), "marks": pa.array(data, pa.binary())})

    return met


def _per_doc(key, table):
    """doc_id, lost, sent: the names marked, of the documents of a bucket."""
    doc, name, opened = (np.concatenate(x) for x in zip(*(_unpack(d.as_py(), 3) for d in table.column("marks"))))
    doc, opened = doc.astype(np.int64), opened > 0
    order = np.lexsort((name, doc))
    doc, name, opened = doc[order], name[order], opened[order]
    ids, firsts = np.unique(doc, return_index=True)
    bounds = [*firsts, len(doc)]
    lost = [name[a:b][~opened[a:b]].tobytes() for a, b in zip(bounds, bounds[1:])]
    sent = [np.unique(name[a:b][opened[a:b]]).tobytes() for a, b in zip(bounds, bounds[1:])]
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "lost": pa.array(lost, pa.binary()), "sent": pa.array(sent, pa.binary())})


def _marks(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, name, opened of the contents that are repeated or open."""
    parts = [_unpack(data.as_py(), 3) for data in table.column("cells")]
    anchor, content, doc = (np.concatenate(x) for x in zip(*parts))
    doc = doc.astype(np.int64)
    order = np.lexsort((doc, content, anchor))
    anchor, content, doc = anchor[order], content[order], doc[order]
    new_anchor = np.ones(len(anchor), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new = new_anchor.copy()
    new[1:] |= content[1:] != content[:-1]
    firsts = np.flatnonzero(new)
    which = np.cumsum(new) - 1
    repeated = doc > doc[firsts][which]
    # Open: the anchor has several contents, and stands in several documents.
    at = np.flatnonzero(new_anchor)
    of = np.cumsum(new_anchor) - 1
    several = np.add.reduceat(new, at) > 1
    several &= np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
    opened = new & several[of]
    taken = repeated | opened
    return doc[taken], _key(anchor[taken], content[taken]), opened[taken].astype(np.uint64)


def _runs(starts: np.ndarray, ends: np.ndarray) -> bytes:
    return np.stack([starts, ends]).astype("<i8").T.tobytes()


def _names_of(column: pa.Array, block: Block) -> np.ndarray:
    """The names listed for each text of the block, mixed with the number of the text."""
    parts = [column[block.first + i].as_py() or b"" for i in range(block.n_texts)]
    names = np.frombuffer(b"".join(parts), np.uint64)
    return mix(names + np.repeat(np.arange(block.n_texts), [len(p) // 8 for p in parts]).astype(np.uint64))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            anchor, content, text, first, last, spot = cells(block)
            name = mix(_key(anchor, content) + text.astype(np.uint64))
            at = first - block.starts[text]
            lost = np.flatnonzero(np.isin(name, _names_of(batch.column("lost"), block)))
            pairs = np.stack([at[lost], (last - first + 1)[lost] + at[lost]]).astype("<i8").T
            bounds = np.searchsorted(text[lost], np.arange(block.n_texts + 1))
            runs = [pairs[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
            sent = np.flatnonzero(np.isin(name, _names_of(batch.column("sent"), block)))
            sizes = last[sent] + LENGTH - first[sent]
            ends = np.cumsum(sizes)
            source = np.repeat(first[sent] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(sent), [None, pa.py_buffer(offsets), pa.py_buffer(block.data[source].tobytes())])
            fields = [pa.array(anchor[sent].astype(np.int64)), pa.array(at[sent]), pa.array((spot - first)[sent]), data]
            places = np.searchsorted(text[sent], np.arange(block.n_texts + 1)).astype(np.int32)
            opens = pa.ListArray.from_arrays(pa.array(places), pa.StructArray.from_arrays(fields, names=["anchor", "at", "spot", "content"]))
            total = np.bincount(text[sent], sizes, minlength=block.n_texts).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row").slice(block.first, block.n_texts),
                    "doc_id": batch.column("doc_id").slice(block.first, block.n_texts),
                    "runs": pa.array(runs, pa.binary()),
                    "opens": opens,
                    "n_open": pa.array(total),
                }
            )


def suffix_order(symbols: np.ndarray, spans: int = 1, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of ``symbols`` (1 and above, each standing for ``spans`` bytes) in order of
    their first ``depth`` bytes at least, by a difference cover modulo 3."""
    n = len(symbols)
    s = np.concatenate([symbols, np.zeros(3, symbols.dtype)]).astype(np.int64)
    place = np.arange(n + (n % 3 == 1))  # a place behind the end keeps the halves apart
    sample = np.concatenate([place[1::3], place[2::3]])
    width = np.int64(s.max() + 1)
    s = np.concatenate([s, np.zeros(2, np.int64)])
    if width < (1 << 21):
        key = (s[sample] * width + s[sample + 1]) * width + s[sample + 2]
        order = np.argsort(key, kind="stable")
        change = key[order][1:] != key[order][:-1]
    else:
        order = np.lexsort((s[sample + 2], s[sample + 1], s[sample]))
        change = np.zeros(len(order) - 1, bool)
        for k in range(3):
            values = s[sample[order] + k]
            change |= values[1:] != values[:-1]
    names = np.empty(len(sample), np.int64)
    names[order] = np.concatenate([[1], 1 + np.cumsum(change)]) if len(order) else []
    if len(order) and names.max() < len(sample) and spans * 3 < depth:
        order = suffix_order(names, spans * 3, depth)
    rank = np.zeros(n + 4, np.int64)
    if len(order):
        if spans * 3 < depth or names.max() == len(sample):
            rank[sample[order]] = np.arange(1, len(order) + 1)
        else:
            rank[sample] = names  # equal names agree on the whole depth
    sampled = sample[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    high = np.int64(rank.max() + 1)
    rest = rest[np.argsort(s[rest] * high + rank[rest + 1], kind="stable")]
    # Merge: how many of the rest stand before each sampled suffix, by its own residue.
    before = np.empty(len(sampled), np.int64)
    one = sampled % 3 == 1
    a, b = sampled[one], sampled[~one]
    before[one] = np.searchsorted(s[rest] * high + rank[rest + 1], s[a] * high + rank[a + 1], "left")
    pairs = s * width
    pairs[:-1] += s[1:]
    # Pairs and ranks may not fit one number, so they are named first.
    both = np.concatenate([rest, b])
    kinds, named = np.unique(pairs[both], return_inverse=True)
    keys = named * high + rank[both + 2]
    # The rest is in order of (byte, rank behind it), which orders these keys as well.
    before[~one] = np.searchsorted(keys[: len(rest)], keys[len(rest) :], "left")
    out = np.empty(n, np.int64)
    to = np.arange(len(sampled)) + np.maximum.accumulate(before) if len(sampled) else before
    out[to] = sampled
    free = np.ones(n, bool)
    free[to] = False
    out[free] = rest
    return out


def repeated_windows(contents: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each content the window starts whose bytes also stand in one of a smaller document."""
    lengths = np.array([len(c) for c in contents], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    text = np.frombuffer(b"\0".join(contents) + b"\0" * 8, np.uint8)
    owner = np.repeat(np.arange(len(contents)), lengths + 1)
    symbols = text[: len(owner)].astype(np.int64) + 2
    symbols[starts + lengths] = 1
    order = suffix_order(symbols)
    order = order[(starts + lengths)[owner[order]] - order >= LENGTH]
    words = np.ndarray((len(text) - 7,), "<u8", text.tobytes(), strides=(1,))
    same = np.ones(max(0, len(order) - 1), bool)
    for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):  # compare adjacent prefixes
        values = words[order + k]
        same &= values[1:] == values[:-1]
    new = np.concatenate([[True], ~same])[: len(order)]
    if not len(order):
        return [np.zeros(0, np.int64) for _ in contents]
    doc = docs[owner[order]]
    least = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1]
    hit = np.sort(order[doc > least])
    parts = np.split(hit, np.searchsorted(hit, starts[1:]))
    return [p - s for p, s in zip(parts, starts)]


def _with_partner(table: pa.Table) -> np.ndarray:
    """Whether another content of the anchor agrees with it on 17 bytes left or right of it.

    A window reaches that far beyond its anchor on one side at least, so contents without a
    partner share no window.
    """
    side = (LENGTH - GRAM) // 2
    content = table.column("content").combine_chunks()
    offsets = np.frombuffer(content.buffers()[1], np.int32)[content.offset : content.offset + len(content) + 1].astype(np.int64)
    data = np.frombuffer(content.buffers()[2], np.uint8)
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    anchor = table.column("anchor").to_numpy().astype(np.uint64)
    spot = table.column("spot").to_numpy() + offsets[:-1]
    held = np.zeros(len(content), bool)
    for start, there in ((spot - side, spot - side >= offsets[:-1]), (spot + GRAM, spot + GRAM + side <= offsets[1:])):
        some = np.flatnonzero(there)
        key = anchor[some]
        for k in (0, 8, side - 8):
            key = mix(key + words[start[some] + k])
        many, _ = repeated(key)
        held[some[many]] = True
    return held


def _sorted_group(key, table):
    table = table.filter(pa.array(_with_partner(table)))
    contents = table.column("content").to_pylist()
    docs, at = table.column("doc_id").to_numpy(), table.column("at").to_numpy()
    found = repeated_windows(contents, docs)
    runs = [_runs(f + a, f + a + 1) for f, a in zip(found, at)]
    some = np.array([len(f) > 0 for f in found], bool)
    return pa.table({"row": table.column("row").to_numpy()[some], "runs": pa.array([r for r, s in zip(runs, some) if s], pa.binary())})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n_bytes, n_removed, n_spans, kept bytes of each row."""
    for batch in batches:
        out = {"row_id": batch.column("doc_id"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
        for text, runs in zip(batch.column("text"), batch.column("runs")):
            data = (text.as_py() or "").encode()
            starts = np.frombuffer(b"".join(runs.as_py() or ()), "<i8").reshape(-1, 2)
            steps = np.zeros(len(data) + 1, np.int64)
            np.add.at(steps, starts[:, 0], 1)
            np.add.at(steps, np.minimum(starts[:, 1] - 1 + LENGTH, len(data)), -1)
            gone = np.cumsum(steps[:-1]) > 0
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(data) else 0)
            out["kept"].append(np.frombuffer(data, np.uint8)[~gone].tobytes())
        kinds = [None, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = [v if k is None else pa.array(v, k) for v, k in zip(out.values(), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, group_bytes: int = GROUP_BYTES, open_bytes: int = OPEN_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that are left) of every row."""
    whole = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", whole).alias("row"), whole.alias("text"))
    numbered = rows.where("doc_id IS NOT NULL")
    total = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    dealt = numbered.select("doc_id", "text").mapInArrow(_dealt(groups), "group long, cells binary")
    met = dealt.groupBy("group").applyInArrow(_met(groups), "bucket long, marks binary")
    per_doc = met.groupBy("bucket").applyInArrow(_per_doc, "doc_id long, lost binary, sent binary")
    marked = numbered.join(per_doc.hint("shuffle_hash"), "doc_id")
    kind = "row long, doc_id long, runs binary, opens array<struct<anchor:bigint,at:bigint,spot:bigint,content:binary>>, n_open long"
    marked = settled(marked.select("row", "doc_id", "text", "lost", "sent").mapInArrow(_marked, kind), "marked")
    open_total = marked.agg(F.sum("n_open")).first()[0] or 0
    parts = max(1, -(-open_total // open_bytes))
    opened = marked.select("row", "doc_id", F.explode("opens").alias("o")).select(
        "row", "doc_id", "o.anchor", "o.at", "o.spot", "o.content", F.pmod(F.xxhash64("o.anchor"), F.lit(parts)).alias("part")
    )
    windows = opened.groupBy("part").applyInArrow(_sorted_group, "row long, runs binary")
    runs = marked.where(F.length("runs") > 0).select("row", "runs").union(windows)
    runs = runs.groupBy("row").agg(F.collect_list("runs").alias("runs"))
    joined = rows.join(runs.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op1_suffix_dedup(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

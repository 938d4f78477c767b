"""Token ids in files of independent rANS blocks.

1. Texts become ids with the tokenizer. It parts pieces at white space, and runs of letters
   from other signs; each distinct piece is encoded once while it stays in a worker's bounded
   cache, and ids are put together by piece. That it does so is read from its configuration;
   with any other configuration whole texts are encoded.
2. Ids of the whole table are counted on the way; the counts, scaled to 2 ** PRECISION, are
   the shared frequency table.
3. Rows are ordered by id of the document over range partitions. Each partition writes
   blocks of whole documents, closed at ``BLOCK_TOKENS`` ids. A block is coded by a static
   range asymmetric numeral system in ``LANES`` interleaved lanes: lane l takes ids l,
   l + LANES and so on. States hold 32 to 63 bits and give out 32 at a time.
4. A block carries what decoding it alone needs: the lanes' last states (its checkpoint), its
   words, its documents with their lengths, and a CRC-32 of its ids and of its words.

Files: Parquet with one row per block (columns of ``BLOCK_SCHEMA``; integers little-endian)
under ``blocks``, and the table (id, frequency) under ``frequencies``.

Defined results: null and empty texts hold the end id alone. Rows with a null id stand first.
Rows that repeat an id of the
document stand in the order of a hash of their token ids, then of these. An empty table gives empty
files. A document of any length is one block at most.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.shared import new_folder, settled

END_ID = 1
PRECISION = 20
LANES = 2048
BLOCK_TOKENS = 1 << 19
CACHE_PIECES = 1_000_000
_LOW = np.uint64(1 << 31)
BLOCK_SCHEMA = "part int, block int, n_tokens long, doc_ids binary, doc_nulls binary, lengths binary, states binary, words binary, crc_ids long, crc_words long"
_SENTINEL = "\u0001"
#: Texts with characters whose lower case or kind (letter or not) is not certain; the tokenizer
#: keeps runs of letters apart from runs of other signs, except for an apostrophe.
_UNSURE = "[^\x00-\xa9\xab-\xb4\xb6-\xb9\xbb-\u012f\u0131-\u017f]|'|[\x1c-\x1f]|<\\|"
_SIGNS = "([^\t-\r a-z\xdf-\xf6\xf8-\u017f]+)"
#: Runs of letters that the tokenizer passes to its model whole and, in lower case, as they are.
_LETTER_RUN = re.compile("[a-z\xdf-\xf6\xf8-\u0130\u0132-\u017e]+")
#: The steps for which all this holds, as configurations name them.
_KNOWN_NORMALIZERS = (
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
)
_KNOWN_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}


def _steps(step: dict | None, inner: str) -> list[dict]:
    if step is None:
        return []
    return step[inner] if step["type"] == "Sequence" else [step]


def cuts_hold(config: dict) -> bool:
    """Whether words and runs of letters go to the model one by one, letters in lower case as they
    are: text is only composed, its white space shortened and its letters lowered; pieces are
    those of the known expression, as bytes; and the model adds nothing before them."""
    pieces = _steps(config["pre_tokenizer"], "pretokenizers")
    model = config["model"]
    return (
        all(step in _KNOWN_NORMALIZERS for step in _steps(config["normalizer"], "normalizers"))
        and {"type": "Lowercase"} in _steps(config["normalizer"], "normalizers")
        and len(pieces) == 2
        and pieces[0] == _KNOWN_SPLIT
        and pieces[1]["type"] == "ByteLevel"
        and not pieces[1]["add_prefix_space"]
        and not pieces[1]["use_regex"]
        and model["type"] == "BPE"
        and not model.get("dropout")
        and not model.get("continuing_subword_prefix")
        and all("<|" in token["content"] for token in config["added_tokens"])
    )


def byte_signs() -> dict[int, str]:
    """Signs of byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Places(dict):
    """Numbers of pieces; a piece that is not known gets the next one and is noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        place = self[piece] = len(self)
        self.new.append(piece)
        return place


class _Grown:
    """An array that is appended to, with room to grow."""

    def __init__(self, kind: type):
        self.room, self.n = np.zeros(1 << 10, kind), 0

    def append(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            room = np.zeros(2 * (self.n + len(values)), self.room.dtype)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : self.n + len(values)] = values
        self.n += len(values)


class PieceEncoder:
    """Ids of texts, each distinct piece encoded once while it stays in the bounded cache."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ids = self._whole(_SENTINEL)
        self.mark = ids[0] if len(ids) == 1 else None
        self.signs = byte_signs()
        self.cuts = cuts_hold(json.loads(self.tokenizer.to_str()))
        self.forget()

    def forget(self) -> None:
        self.place = _Places()
        self.ids, self.lengths, self.firsts = _Grown(np.uint32), _Grown(np.int64), _Grown(np.int64)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _of_letters(self, run: str) -> list[int]:
        """Ids of a run of letters, from the model without the steps that leave such runs alone."""
        text = run if run.isascii() else run.encode().decode("latin-1").translate(self.signs)
        return [token.id for token in self.tokenizer.model.tokenize(text)]

    def _of_others(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece, many pieces to a call, parted by a mark of one id."""
        found = []
        for i in range(0, len(pieces), 4096):
            part = pieces[i : i + 4096]
            if self.mark is not None and self.cuts and not any(_SENTINEL in p for p in part):
                got = np.array(self._whole(f" {_SENTINEL} ".join(part)), np.uint32)
                marks = np.flatnonzero(got == self.mark)
                if len(marks) == len(part) - 1:
                    found += [ids[k > 0 :].tolist() for k, ids in enumerate(np.split(got, marks))]
                    continue
            # a piece holds the mark, or holds it in another guise
            found += [self._whole(p) for p in part]
        return found

    def _learn(self) -> None:
        """Take in the ids of the pieces noted as new."""
        new, self.place.new = self.place.new, []
        direct = [self.cuts and _LETTER_RUN.fullmatch(p) is not None and p == p.lower() for p in new]
        others = iter(self._of_others([p for p, letters in zip(new, direct) if not letters]))
        found = [self._of_letters(p) if letters else next(others) for p, letters in zip(new, direct)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.firsts.append(self.ids.n + np.cumsum(lengths) - lengths)
        self.lengths.append(lengths)
        self.ids.append(np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())))

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Number of pieces of each text, and the pieces, whose ids one after another are those of
        the text: words, of which signs are parted from letters where all characters are certain."""
        if not self.cuts:
            return np.ones(len(texts), np.int64), texts
        parted = pc.replace_substring_regex(pc.utf8_lower(texts), _SIGNS, " \\1 ")
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(texts, _UNSURE), texts, parted))
        return split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), split.flatten()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, with the end id after each text, and their number by text."""
        if len(self.place) > CACHE_PIECES:
            self.forget()
        n_words, pieces = self._pieces(texts)
        different = pieces.dictionary_encode()
        every = different.dictionary.to_numpy(zero_copy_only=False).tolist()
        which = np.fromiter(map(self.place.__getitem__, every), np.int64, len(every))[different.indices.to_numpy()]
        if self.place.new:
            self._learn()
        # The end of each text is one more piece of one id.
        ends = np.cumsum(n_words) + np.arange(len(texts))
        length, start = np.ones(len(which) + len(texts), np.int64), np.zeros(len(which) + len(texts), np.int64)
        inner = np.ones(len(length), bool)
        inner[ends] = False
        length[inner], start[inner] = self.lengths.room[which], self.firsts.room[which]
        before = np.cumsum(length) - length
        source = np.repeat(start - before, length) + np.arange(int(length.sum()))
        source[before[ends]] = 0
        out = self.ids.room[source]
        out[before[ends]] = END_ID
        bounds = np.concatenate([[0], before[ends] + 1])
        return out, np.diff(bounds)


_press = zstandard.ZstdCompressor(level=1)
_unpress = zstandard.ZstdDecompressor()


def _packed(ids: np.ndarray) -> bytes:
    """Ids by byte planes, compressed: what travels between tasks. The first byte is the width."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    planes = ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + _press.compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(_unpress.decompress(data[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint32)


@cache
def encoder_of(path: str) -> PieceEncoder:
    """One encoder for each Python worker, shared by its tasks one after another."""
    return PieceEncoder(path)


def token_rows(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (packed), n: the ids of each row's text, with the end id.

    Each task adds a row without n that holds its count of every id.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of short lists that hold no cycles
        encoder = encoder_of(path)
        total = np.zeros(0, np.int64)
        for batch in batches:
            texts = batch.column("_text")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy())
            i = 0
            while i < len(texts):  # about 2 MB of text at once
                before = int(sizes[i - 1]) if i else 0
                j = max(i + 1, int(np.searchsorted(sizes, before + (1 << 21), "right")))
                ids, counts = encoder.encode(texts.slice(i, j - i))
                count = np.bincount(ids, minlength=len(total))
                count[: len(total)] += total
                total = count
                ends = np.cumsum(counts)
                parts = [_packed(ids[a:b]) for a, b in zip(ends - counts, ends)]
                yield pa.RecordBatch.from_pydict(
                    {"key": batch.column("key").slice(i, j - i), "ids": pa.array(parts, pa.binary()), "n": pa.array(counts, pa.int64())}
                )
                i = j
        yield pa.RecordBatch.from_pydict(
            {"key": pa.array([None], pa.int64()), "ids": pa.array([total.astype("<i8").tobytes()]), "n": pa.array([None], pa.int64())}
        )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("_text"))
    return rows.mapInArrow(encoded, "key long, ids binary, n long")


def frequencies(rows: DataFrame, precision: int = PRECISION) -> DataFrame:
    """id, frequency: counts of the whole table scaled to sum to 2 ** precision, 1 at least.

    One row per id of the vocabulary.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("ids"):
                count = np.frombuffer(value.as_py(), "<i8")
                seen = np.flatnonzero(count)
                yield pa.RecordBatch.from_pydict({"id": seen.astype(np.int32), "n": count[seen]})

    counts = rows.where("n IS NULL").select("ids").mapInArrow(counted, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy()
    by_size = Window.orderBy(F.desc("n"), "id")
    scaled = F.greatest(F.lit(1), F.floor(F.col("n") / F.sum("n").over(whole) * ((1 << precision) - F.count("id").over(whole))))
    # What rounding leaves goes to the most frequent id.
    rest = (1 << precision) - F.sum("f").over(whole)
    return (
        counts.withColumn("f", scaled.cast("long"))
        .withColumn("frequency", (F.col("f") + F.when(F.row_number().over(by_size) == 1, rest).otherwise(0)).cast("int"))
        .select("id", "frequency")
    )


class Coder:
    """Encodes and decodes the ids of a block with one frequency table."""

    def __init__(self, ids: np.ndarray, frequency: np.ndarray, precision: int = PRECISION):
        order = np.argsort(ids)
        self.symbol = ids[order].astype(np.uint32)
        self.count = frequency[order].astype(np.uint64)
        self.first = np.cumsum(self.count) - self.count
        self.precision = np.uint64(precision)
        self.slots: np.ndarray | None = None
        self.index = np.zeros(int(self.symbol[-1]) + 1 if len(ids) else 1, np.int32)
        self.index[self.symbol] = np.arange(len(self.symbol))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last states of the lanes, and the words in the order in which decoding takes them."""
        which = self.index[ids]
        states = np.full(LANES, _LOW, np.uint64)
        bits, words = self.precision, []
        steps = -(-len(which) // LANES)
        for step in range(steps - 1, -1, -1):
            at = which[step * LANES : (step + 1) * LANES]
            n = len(at)
            f, c, x = self.count[at], self.first[at], states[:n]
            full = x >= (f << (np.uint64(63) - bits))
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
            high, low = np.divmod(x, f)
            states[:n] = (high << bits) + low + c
        return states, np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")

    def decode(self, n: int, states: np.ndarray, words: np.ndarray) -> np.ndarray:
        if self.slots is None:
            self.slots = np.repeat(np.arange(len(self.symbol), dtype=np.int32), self.count.astype(np.int64))
        states = states.astype(np.uint64)
        out, taken = np.empty(n, np.int32), 0
        mask = np.uint64((1 << int(self.precision)) - 1)
        for low in range(0, n, LANES):
            m = min(LANES, n - low)
            x = states[:m]
            slot = x & mask
            which = self.slots[slot]
            out[low : low + m] = which
            x = self.count[which] * (x >> self.precision) + slot - self.first[which]
            empty = np.flatnonzero(x < _LOW)
            x[empty] = (x[empty] << np.uint64(32)) | words[taken : taken + len(empty)].astype(np.uint64)
            taken += len(empty)
            states[:m] = x
        if taken != len(words) or (states != _LOW).any():
            raise ValueError("a block of token ids does not end where it should")
        return self.symbol[out]


def _table_of(frame: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequency table, bounded by the vocabulary."""
    table = frame.toArrow()
    return table.column("id").to_numpy(), table.column("frequency").to_numpy()


def write_blocks(rows: DataFrame, table: DataFrame, folder: str, parts: int | None = None) -> None:
    """Write the frequency table and the blocks of ``rows`` (key, ids, n) below ``folder``."""
    table.coalesce(1).write.parquet(f"{folder}/frequencies")
    shared = rows.sparkSession.sparkContext.broadcast(_table_of(rows.sparkSession.read.parquet(f"{folder}/frequencies")))

    def block_of(part: int, number: int, held: list) -> dict:
        keys = np.array([k or 0 for k, _ in held], "<i8")
        nulls = np.array([k is None for k, _ in held], np.uint8)
        ids = np.concatenate([x for _, x in held])
        states, words = coder_of().encode(ids)
        return {
            "part": part,
            "block": number,
            "n_tokens": len(ids),
            "doc_ids": keys.tobytes(),
            "doc_nulls": np.packbits(nulls).tobytes(),
            "lengths": np.array([len(x) for _, x in held], "<u4").tobytes(),
            "states": states.astype("<u8").tobytes(),
            "words": words.tobytes(),
            "crc_ids": zlib.crc32(ids.astype("<u4").tobytes()),
            "crc_words": zlib.crc32(words.tobytes()),
        }

    made: list[Coder] = []

    def coder_of() -> Coder:
        if not made:
            made.append(Coder(*shared.value))
        return made[0]

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for key, packed in zip(batch.column("key").to_pylist(), batch.column("ids")):
                ids = _unpacked(packed.as_py())
                if held and size + len(ids) > BLOCK_TOKENS:
                    yield pa.RecordBatch.from_pylist([block_of(part, number, held)])
                    number, held, size = number + 1, [], 0
                held.append((key, ids))
                size += len(ids)
        if held:
            yield pa.RecordBatch.from_pylist([block_of(part, number, held)])

    # Bounds of ranges are drawn on the driver: their keys are two numbers, whatever a text's length.
    ranges = [F.asc_nulls_first("key"), F.asc("_hash")]
    rows = rows.withColumn("_hash", F.xxhash64("ids"))
    ranged = rows.repartitionByRange(parts, *ranges) if parts else rows.repartitionByRange(*ranges)
    ranged.sortWithinPartitions(*ranges, "ids").select("key", "ids").mapInArrow(_typed(written), BLOCK_SCHEMA).write.parquet(f"{folder}/blocks")


def _typed(function):
    """Batches with the types of ``BLOCK_SCHEMA``."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in BLOCK_SCHEMA.split(", "))])

    def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in function(batches):
            yield pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in schema], schema=schema)

    return typed


def read_blocks(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 32-bit), ids_crc32, from the files alone."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    shared = spark.sparkContext.broadcast(_table_of(spark.read.parquet(f"{folder}/frequencies")))
    # One row per partition of the files.
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("block")
    index = blocks.select("part", "block", (F.sum("n_tokens").over(in_part) - F.col("n_tokens")).alias("block_start"))
    starts = index.join(bases, "part").select("part", "block", (F.col("block_start") + F.col("part_start")).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        for batch in batches:
            for row in batch.to_pylist():
                if zlib.crc32(row["words"]) != row["crc_words"]:
                    raise ValueError("the words of a block of token ids are damaged")
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ids = coder.decode(row["n_tokens"], np.frombuffer(row["states"], "<u8"), np.frombuffer(row["words"], "<u4"))
                data = ids.astype("<u4").tobytes()
                if zlib.crc32(data) != row["crc_ids"]:
                    raise ValueError("the ids of a block are damaged")
                nulls = np.unpackbits(np.frombuffer(row["doc_nulls"], np.uint8), count=len(lengths)).astype(bool)
                ends = np.cumsum(lengths)
                pieces = [data[4 * (e - n) : 4 * e] for e, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=nulls),
                        "part": np.full(len(lengths), row["part"], np.int32),
                        "block": np.full(len(lengths), row["block"], np.int32),
                        "offset": ends - lengths,
                        "n_tokens": lengths,
                        "ids": pa.array(pieces, pa.binary()),
                        "ids_crc32": pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                    }
                )

    schema = "doc_id long, part int, block int, offset long, n_tokens long, ids binary, ids_crc32 long"
    decoded = blocks.mapInArrow(read, schema)
    return decoded.join(settled(starts, "starts"), ["part", "block"]).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids", "ids_crc32"
    )


def op10_token_ids(docs: DataFrame, path: str) -> DataFrame:
    folder = new_folder(docs.sparkSession, "token-ids")
    rows = settled(token_rows(docs, path), "ids")
    write_blocks(rows.where("n IS NOT NULL"), frequencies(rows), folder)
    return read_blocks(docs.sparkSession, folder).drop("ids")

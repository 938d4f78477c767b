"""Arrays of whole numbers as bytes that travel between tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

_press = zstandard.ZstdCompressor(level=1)
_unpress = zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """Numbers of 0 or more by byte planes, compressed. The first byte is the width."""
    values = np.ascontiguousarray(values).astype("<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + _press.compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(_unpress.decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def pack_rising(values: np.ndarray) -> bytes:
    """``pack`` of the steps between numbers that never fall."""
    return pack(np.diff(values, prepend=0))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def runs(ordered: np.ndarray) -> np.ndarray:
    """Places at which a run of equal values starts in an ordered array."""
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(first)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def arrow_table(schema: str, rows: list[dict]) -> pa.Table:
    """Rows with the columns and types of a Spark schema; what a row does not have is null."""
    names = [c.split(" ") for c in schema.split(", ")]
    return pa.Table.from_pylist(rows, schema=pa.schema([(name, _KINDS[kind]) for name, kind in names]))

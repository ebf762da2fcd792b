"""Arrays of integers and short texts as compressed bytes, for rows that carry them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(values: np.ndarray, dtype: str = "<u4") -> bytes:
    """Compressed by byte planes: the high bytes of small integers cost next to nothing."""
    raw = np.ascontiguousarray(values, dtype)
    planes = raw.view("u1").reshape(len(raw), raw.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def unpacked(data: bytes, dtype: str = "<u4") -> np.ndarray:
    planes = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(np.frombuffer(planes, "u1").reshape(size, len(planes) // size).T.tobytes(), dtype)


def cut(data: bytes, lengths: np.ndarray) -> list[bytes]:
    """``data`` in pieces of these lengths."""
    bounds = [0, *np.cumsum(lengths).tolist()]
    return [data[a:b] for a, b in zip(bounds, bounds[1:])]


def pack_texts(texts: list[bytes]) -> bytes:
    lengths = packed(np.fromiter(map(len, texts), np.int64, len(texts)))
    return len(lengths).to_bytes(8, "little") + lengths + packed(np.frombuffer(b"".join(texts), np.uint8), "u1")


def unpack_texts(data: bytes) -> list[bytes]:
    at = 8 + int.from_bytes(data[:8], "little")
    return cut(unpacked(data[at:], "u1").tobytes(), unpacked(data[8:at]).astype(int))

"""Integer arrays as short byte strings."""

from __future__ import annotations

import numpy as np
import zstandard


def squeeze(values: np.ndarray) -> bytes:
    """An integer array byte plane by byte plane, so that planes of zeros take no room."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def stretch(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).ravel()


def squeeze_sorted(values: np.ndarray) -> bytes:
    """Sorted uint64 values by their differences."""
    return squeeze(np.diff(values, prepend=values.dtype.type(0)))


def stretch_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(stretch(data, "<u8"), dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A uint64 hash of uint64 values."""
    values = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> np.uint64(shift)
        values *= np.uint64(factor)
    return values ^ (values >> np.uint64(31))

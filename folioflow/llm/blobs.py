"""Arrays of numbers as compressed bytes, for tables that hold many of them in a row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard


def pack(a: np.ndarray) -> bytes:
    """Numbers as planes of bytes, compressed: high bytes are mostly equal and cost nothing."""
    a = np.ascontiguousarray(a)
    return a.dtype.str.encode() + zstandard.compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes(), 3)


def unpack(b: bytes) -> np.ndarray:
    t, data = np.dtype(bytes(b[:3]).decode()), bytes(b[3:])  # the name of a number type has three letters
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(t.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(t).reshape(-1)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=a.dtype.type(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=None)


def slices(buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield int(buckets[a]), slice(a, b)

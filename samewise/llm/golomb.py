"""Golomb-Rice coding of sorted distinct integers: unary quotients, then fixed-width remainders."""

from __future__ import annotations

import math
import struct

_HEAD = struct.Struct("<IBI")


def encode(values) -> bytes:
    """``values``: ascending distinct unsigned integers below 2**62, as a numpy array."""
    import numpy as np

    n = len(values)
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(-1)) - 1
    width = max(0, int(math.log2(max(1.0, float(gaps.mean()) * math.log(2))))) if n else 0
    quotients = gaps >> width
    unary = np.zeros(int(quotients.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    bits = ((gaps[:, None] >> np.arange(width - 1, -1, -1)) & 1).astype(np.uint8).ravel()
    first = np.packbits(unary).tobytes()
    return _HEAD.pack(n, width, len(first)) + first + np.packbits(bits).tobytes()


def decode(data: bytes):
    import numpy as np

    n, width, size = _HEAD.unpack_from(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    at = _HEAD.size
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, at)))[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(data, np.uint8, -1, at + size))[: n * width].reshape(n, width).astype(np.int64)
    remainders = bits @ (np.int64(1) << np.arange(width - 1, -1, -1, dtype=np.int64)) if width else np.zeros(n, np.int64)
    return np.cumsum((quotients << width) + remainders + 1) - 1

"""Golomb-Rice coding of sorted distinct integers, as numpy arrays.

The gaps between neighbours are cut into a quotient (unary code) and ``k`` low
bits; the two streams stand one after the other, so both directions work on
whole arrays.
"""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray, universe: int) -> bytes:
    """Code of sorted distinct uint64 ``values`` below ``universe``; first byte is k."""
    n = len(values)
    if not n:
        return b""
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(-1)) - 1
    k = max(0, int(universe // n).bit_length() - 1)
    quotients = gaps >> k
    ends = np.cumsum(quotients + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    low = ((gaps[:, None] >> np.arange(k)) & 1).astype(np.uint8)
    return bytes([k]) + np.packbits(unary).tobytes() + np.packbits(low.ravel()).tobytes()


def decode(code: bytes, n: int) -> np.ndarray:
    """The ``n`` values that ``encode`` got, as int64."""
    if not n:
        return np.empty(0, np.int64)
    k = code[0]
    low_bytes = (n * k + 7) // 8
    body = np.frombuffer(code, np.uint8, offset=1)
    unary = np.unpackbits(body[:len(body) - low_bytes])
    ends = np.flatnonzero(unary)[:n]
    gaps = np.diff(ends, prepend=-1) - 1
    if k:
        low = np.unpackbits(body[len(body) - low_bytes:])[:n * k].reshape(n, k)
        gaps = (gaps << k) + low @ (np.int64(1) << np.arange(k, dtype=np.int64))
    return np.cumsum(gaps + 1) - 1

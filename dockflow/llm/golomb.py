"""Golomb coding of sorted fingerprints, vectorised.

The divisor is the power of two below the mean gap. Quotients stand in one bit
stream as runs of ones, remainders in another with a fixed width.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<IBQ")


def encode(values: np.ndarray) -> bytes:
    """Code of ascending unsigned 64-bit values; equal neighbours are allowed."""
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0)
    first = int(values[0])
    gaps = np.diff(values)
    if n == 1:
        return _HEAD.pack(1, 0, first)
    mean = (int(values[-1]) - first) // (n - 1)
    k = max(mean, 1).bit_length() - 1
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]), np.uint8)
    unary[ends - 1] = 0
    rest = b""
    if k:
        low = (gaps & np.uint64((1 << k) - 1)).astype(">u8").view(np.uint8).reshape(-1, 8)
        rest = np.packbits(np.unpackbits(low, axis=1)[:, 64 - k :]).tobytes()
    return _HEAD.pack(n, k, first) + np.packbits(unary).tobytes() + rest


def decode(code: bytes) -> np.ndarray:
    n, k, first = _HEAD.unpack_from(code)
    out = np.full(n, first, np.uint64)
    if n < 2:
        return out
    body = np.frombuffer(code, np.uint8, offset=_HEAD.size)
    rest = -(-(n - 1) * k // 8)
    ends = np.flatnonzero(np.unpackbits(body[: len(body) - rest]) == 0)[: n - 1]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(body[len(body) - rest :])[: (n - 1) * k].reshape(n - 1, k)
        low = np.zeros((n - 1, 64), np.uint8)
        low[:, 64 - k :] = bits
        gaps |= np.packbits(low, axis=1).view(">u8").ravel().astype(np.uint64)
    out[1:] += np.cumsum(gaps)
    return out

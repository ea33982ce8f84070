"""Ids of texts by way of their distinct pieces.

Pieces of a batch are dictionary-encoded, so that only distinct ones meet the
cache, and only those new to the cache meet the encoder.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from dockflow.llm.pretokens import piece_starts

#: Distinct pieces kept by a worker; beyond it the cache starts anew.
CACHED = 800_000
#: Longer pieces aren't kept.
LONGEST = 64


class PieceEncoder:
    """``encode_many`` gives the ids of each of a list of pieces (UTF-8 bytes)."""

    def __init__(self, encode_many: Callable[[list[bytes]], list], attach_space: bool = True):
        self.encode_many, self.attach_space = encode_many, attach_space
        self._reset()

    def _reset(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.pool, self.begin, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = self.count = 0

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        """Slots for new pieces."""
        ids = self.encode_many(pieces)
        sizes = np.fromiter((len(x) for x in ids), np.int64, len(ids))
        total, n = int(sizes.sum()), len(ids)
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.count + n > len(self.size):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.pool[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        new = np.arange(self.count, self.count + n)
        self.begin[new], self.size[new] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.count = self.used + total, self.count + n
        self.slots.update((p, i) for p, i in zip(pieces, new.tolist()) if len(p) <= LONGEST)
        return new

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, number of ids of each text)."""
        if self.count > CACHED:
            self._reset()
        joined = "".join(texts)
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        firsts = np.cumsum(lengths) - lengths
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        starts = piece_starts(points, firsts[lengths > 0], self.attach_space)
        raw = joined.encode()
        ends = np.append(starts, len(points))
        if len(raw) > len(points):
            widths = np.ones(len(points) + 1, np.int64)
            widths[0] = 0
            for limit in (0x80, 0x800, 0x10000):
                widths[1:] += points >= limit
            ends = np.cumsum(widths)[ends]
        buffers = [None, pa.py_buffer(np.ascontiguousarray(ends, np.int64)), pa.py_buffer(raw)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        known, get = coded.dictionary.to_pylist(), self.slots.get
        slots = np.fromiter((get(p, -1) for p in known), np.int64, len(known))
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self._add([known[i] for i in new])
        slots = slots[coded.indices.to_numpy()]
        sizes = self.size[slots]
        ends = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.begin[slots] - ends + sizes, sizes) + np.arange(ends[-1])]
        before = np.append(0, ends)[np.searchsorted(starts, np.append(firsts, len(points)))]
        return ids, np.diff(before)

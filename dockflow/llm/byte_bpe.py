"""Byte-level BPE by a rank file: texts to ids and back.

Pieces come from ``pretokens``. A piece that is no token is merged pair by
pair, lowest rank first and leftmost among equals, for all new pieces at once.
"""

from __future__ import annotations

import base64
import heapq
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import over_texts, text_groups
from dockflow.llm.piece_ids import PieceEncoder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
_NONE = np.int64(1) << np.int64(40)
#: Bytes up to which pieces are merged together; longer ones one by one with a heap.
_TOGETHER = 48


class Merges:
    """The ranks of a file, and the pairs of tokens that make a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.width = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.width
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a * self.width + b] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(self.tokens), np.uint8)

    def _one(self, piece: bytes) -> list[int]:
        """A long piece: a heap of mergeable neighbours over a linked list."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        get, width, heap = self.pairs.get, self.width, []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := get(ids[i] * width + ids[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = rank, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [x for x, ok in zip(ids, alive) if ok]

    def _many(self, pieces: list[bytes]) -> list[list[int]]:
        """Short pieces, one merge in each of them per round."""
        out: list = [None] * len(pieces)
        names = np.arange(len(pieces))
        sizes = np.fromiter((len(p) for p in pieces), np.int64, len(pieces))
        ids = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        while len(names):
            firsts = np.cumsum(sizes) - sizes
            rank = np.full(len(ids), _NONE)
            key = ids[:-1] * self.width + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank[:-1] = np.where(self.keys[at] == key, self.made[at], _NONE)
            rank[firsts + sizes - 1] = _NONE
            # Rank before place: the leftmost pair of the lowest rank.
            best = np.minimum.reduceat((rank << np.int64(20)) + (np.arange(len(ids)) - np.repeat(firsts, sizes)), firsts)
            low = best >> np.int64(20)
            merging = low < _NONE
            if not merging.all():
                for i in np.flatnonzero(~merging).tolist():
                    out[names[i]] = ids[firsts[i] : firsts[i] + sizes[i]].tolist()
            place = (firsts + (best & np.int64((1 << 20) - 1)))[merging]
            ids[place] = low[merging]
            keep = np.repeat(merging, sizes)
            keep[place + 1] = False
            ids, names, sizes = ids[keep], names[merging], sizes[merging] - 1
        return out

    def encode_many(self, pieces: list[bytes]) -> list[list[int]]:
        out: list = [[rank] if (rank := self.ranks.get(p)) is not None else None for p in pieces]
        short = [i for i, x in enumerate(out) if x is None and len(pieces[i]) <= _TOGETHER]
        if short:
            for i, ids in zip(short, self._many([pieces[i] for i in short])):
                out[i] = ids
        return [self._one(p) if x is None else x for p, x in zip(pieces, out)]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids, number of bytes of each text): ids find their bytes
        by the offsets at which tokens lie on end."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        out = self.letters[np.repeat(self.begins[ids] - ends + sizes, sizes) + np.arange(total)]
        return out, np.diff(np.append(0, ends)[np.append(0, np.cumsum(counts))])


@cache
def merges(path: str) -> Merges:
    return Merges(path)


@cache
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(merges(path).encode_many)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = RANKS) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers.

    A null or empty text has no ids, special tokens are ordinary text, one row
    per document, repeated rows included; other columns aren't read.
    """

    def run(batch):
        names, texts = batch.columns[0], [t or "" for t in batch.columns[1].to_pylist()]
        for a, b in text_groups([len(t) for t in texts]):
            ids, counts = _encoder(path).encode(texts[a:b])
            yield pa.RecordBatch.from_arrays([names[a:b], _binary(ids.astype("<u4"), counts * 4)], names=["doc_id", "ids"])

    return over_texts(docs, [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body")], run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for."""

    def run(batch):
        names, coded = batch.columns
        raw = coded.to_pylist()
        for a, b in text_groups([len(x) for x in raw]):
            ids = np.frombuffer(b"".join(raw[a:b]), "<u4").astype(np.int64)
            out, sizes = merges(path).decode(ids, np.array([len(x) // 4 for x in raw[a:b]], np.int64))
            yield pa.RecordBatch.from_arrays([names[a:b], coded[a:b], _binary(out, sizes)], names=["doc_id", "ids", "decoded"])

    return over_texts(encoded, ["doc_id", "ids"], run, "doc_id long, ids binary, decoded binary")

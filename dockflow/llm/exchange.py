"""Finding fingerprints that occur more than once, without shuffling them.

Every partition of the rows sends each owner of a slice of the hash space one
message: its distinct fingerprints there, sorted and Golomb-coded, a bit for
each that it holds more than once, and optional 32-bit tags that must agree
too. An owner answers each message with one bit per fingerprint. A fingerprint
held by a third of all rows costs one entry per partition.

Answers find their way back by partition number. ``align`` lays them beside the
rows they belong to, so that rows (whole texts) need no shuffle; it wants rows
whose partitions hold the same rows in the same order each time, as those of a
file scan do, and marks sent with each row show if they don't.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import RDD

from dockflow.llm import golomb


def distinct(values: np.ndarray, tags: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Ascending distinct (value, tag) pairs, and which of them occur repeatedly."""
    if tags is None:
        got, n = np.unique(values, return_counts=True)
        return got, None, n > 1
    order = np.lexsort((tags, values))
    v, t = values[order], tags[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    return v[at], t[at], np.diff(at, append=len(v)) > 1


def messages(part: int, values: np.ndarray, tags: np.ndarray | None, owners: int) -> Iterator[tuple]:
    """(owner, part, coded fingerprints, repeat bits, tags) for every owner that gets any."""
    got, tag, twice = distinct(values, tags)
    to = ((got >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
    for owner in np.unique(to):
        a, b = np.searchsorted(to, [owner, owner + np.uint64(1)])
        yield (
            int(owner),
            part,
            golomb.encode(got[a:b]),
            np.packbits(twice[a:b]).tobytes(),
            b"" if tag is None else tag[a:b].astype("<u4").tobytes(),
        )


def _answer(mail: list[tuple]) -> Iterator[tuple]:
    """(part, (owner, the duplicates coded, one bit per fingerprint)) for the mail of one owner."""
    owner = mail[0][0]
    coded = [golomb.decode(bytes(m[2])) for m in mail]
    ends = np.cumsum([len(v) for v in coded])
    values = np.concatenate(coded)
    hit = np.concatenate([np.unpackbits(np.frombuffer(bytes(m[3]), np.uint8))[: len(v)].astype(bool) for m, v in zip(mail, coded)])
    tags = np.concatenate([np.frombuffer(bytes(m[4]), "<u4") for m in mail]) if mail[0][4] else None
    order = np.argsort(values, kind="stable") if tags is None else np.lexsort((tags, values))
    v = values[order]
    same = v[1:] == v[:-1]
    if tags is not None:
        same &= tags[order][1:] == tags[order][:-1]
    both = np.zeros(len(v), bool)
    both[1:] |= same
    both[:-1] |= same
    hit[order[both]] = True
    for m, end, v in zip(mail, ends, coded):
        own = hit[end - len(v) : end]
        yield m[1], (owner, golomb.encode(v[own]), np.packbits(own).tobytes())


def answers(sent: RDD, owners: int) -> RDD:
    """Replies (part, (owner, duplicates, bits)) to ``sent``, an RDD of messages."""

    def serve(mail):
        boxes: dict[int, list[tuple]] = {}
        for owner, message in mail:
            boxes.setdefault(owner, []).append(message)
        while boxes:
            yield from _answer(boxes.popitem()[1])

    return sent.map(lambda m: (m[0], tuple(m))).partitionBy(owners, int).mapPartitions(serve)


def _zip(rows: RDD, other: RDD) -> RDD:
    more = other.getNumPartitions() - rows.getNumPartitions()
    if more > 0:
        rows = rows.context.union([rows, rows.context.parallelize([], more)])
    return rows.zip(other)


def align(rows: RDD, counts: dict[int, int], replies: RDD, per_row) -> RDD:
    """(row, reply) in the partitions of ``rows``.

    ``counts`` is the number of rows by partition, ``per_row(part, replies, n)``
    gives the n values that go beside the rows of a partition.
    """
    n_parts = rows.getNumPartitions()

    def lay(part, mail):
        n = counts.get(part, 0)
        if n:
            yield from per_row(part, [m for _, m in mail], n)

    return _zip(rows, replies.partitionBy(max(n_parts, 1), int).mapPartitionsWithIndex(lay))

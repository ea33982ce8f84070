"""Best-fit packing of token sequences by a configuration program.

Only the histogram of piece lengths decides, at most one entry per length up to
the capacity. A configuration is a multiset of lengths that fits a sequence.
Multiplicative weights cover the histogram with configurations: lengths that
are covered less weigh more, and the heaviest configuration is priced by a
knapsack over the capacity. Rounding takes whole multiples of what remains;
what then is left is filled longest first, each pattern as often as it goes.

A piece is placed by its length and its number among all pieces of that length,
which is its number in its partition plus those of earlier partitions: no task
sees all pieces of a length, however many documents have it.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.llm.common import cut
from dockflow.llm.word_ids import folded_words, kind

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 4096
#: Rounds of multiplicative weights, and how fast covered lengths lose weight.
ROUNDS, RATE = 160, 6.0


def _price(weights: np.ndarray, capacity: int) -> dict[int, int]:
    """The heaviest multiset of lengths within the capacity: a knapsack over
    capacities; ``weights[l]`` is what one piece of length l is worth."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    own = weights[1:]
    for room in range(1, capacity + 1):
        worth = best[room - 1 :: -1][:room] + own[:room]
        i = int(worth.argmax())
        if worth[i] > best[room - 1]:
            best[room], last[room] = worth[i], i + 1
        else:
            best[room] = best[room - 1]
    config, room = defaultdict(int), capacity
    while room > 0:
        if last[room]:
            config[int(last[room])] += 1
            room -= int(last[room])
        else:
            room -= 1
    return dict(config)


def _fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """A sequence from what is left: the longest piece that fits, again and again."""
    lengths = np.flatnonzero(left)
    config, room = {}, capacity
    while room > 0 and (i := int(np.searchsorted(lengths, room, side="right")) - 1) >= 0:
        length = int(lengths[i])
        config[length] = min(int(left[length]), room // length)
        room -= length * config[length]
        lengths = lengths[:i]
    return config


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(configuration, how often) that hold every piece of the histogram once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plans = [({capacity: 1}, int(left[capacity]))] if left[capacity] else []
    left[capacity] = 0
    # Lengths with few pieces are no use for multiples; the filling takes them.
    demand = np.where(left >= 4, left, 0).astype(float)
    if demand.sum() > 0:
        cover, chosen = np.zeros(capacity + 1), defaultdict(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            inverse = np.where(demand > 0, 1 / demand, 0.0)
        for _ in range(ROUNDS):
            weights = inverse * np.exp(-RATE * np.maximum(cover - cover[demand > 0].min(), 0))
            config = {k: n for k, n in _price(weights, capacity).items() if demand[k] > 0}
            if not config:
                break
            times = max(1.0, 0.5 * min(demand[k] / n for k, n in config.items()))
            chosen[tuple(sorted(config.items()))] += times
            for k, n in config.items():
                cover[k] += times * n * inverse[k]
        # A program's worth counts by how full its sequences are.
        for items, times in sorted(chosen.items(), key=lambda c: (-sum(k * n for k, n in c[0]), c[0])):
            if sum(k * n for k, n in items) < 0.98 * capacity:
                continue
            whole = min([int(times), *(int(left[k]) // n for k, n in items)])
            if whole > 0:
                plans.append((dict(items), whole))
                for k, n in items:
                    left[k] -= whole * n
    while left.any():
        config = _fill(left, capacity)
        whole = min(int(left[k]) // n for k, n in config.items())
        plans.append((config, whole))
        for k, n in config.items():
            left[k] -= whole * n
    return plans


class Places:
    """Where the i-th piece of each length goes."""

    def __init__(self, plans: list[tuple[dict[int, int], int]]):
        rows, first = defaultdict(list), 0
        for config, times in plans:
            offset = 0
            for length, n in sorted(config.items(), reverse=True):
                rows[length].append((times * n, n, first, offset))
                offset += length * n
            first += times
        self.rows = {}
        for length, entries in rows.items():
            counts, per, base, offset = map(np.array, zip(*entries))
            self.rows[length] = (np.cumsum(counts) - counts, per, base, offset)

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            begins, per, base, begin = self.rows[length]
            row = np.searchsorted(begins, numbers[at], side="right") - 1
            inside = numbers[at] - begins[row]
            sequence[at] = base[row] + inside // per[row]
            offset[at] = begin[row] + inside % per[row] * length
        return sequence, offset


def pieces(docs: DataFrame, doc_id: str, text: str, vocabulary: str, end_id: int, capacity: int, with_ids: bool) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, number[, ids]); ``number`` counts
    the earlier pieces of that length in the partition ``part``."""

    def run(batches):
        words, end, wide = folded_words(vocabulary), np.array([end_id], "<u4"), kind(vocabulary)
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out = []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.concatenate([np.frombuffer(words.ids(body or ""), wide).astype("<u4"), end])
                for i, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    raw = own.tobytes()
                    out.append((name, i, start, len(own), zlib.crc32(raw), int(seen[len(own)]), raw if with_ids else None))
                    seen[len(own)] += 1
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "number", "ids"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, number long, ids binary"
    found = chosen.mapInArrow(run, schema).withColumn("part", F.spark_partition_id())
    return found if with_ids else found.drop("ids")


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and with ``with_ids`` the ids themselves (little-endian 32-bit).

    Each document's ids end with ``end_id``; only a longer one than the capacity
    is cut. A null text is empty and still has its end id. Repeated rows are
    packed as often as they occur, also under a null id; no rows give no pieces.
    Other columns aren't read.
    """
    found = cut(pieces(docs, doc_id, text, vocabulary, end_id, capacity, with_ids))
    counts = cut(found.groupBy("length", "part").agg(F.count("*").alias("n")))
    # At most one row per length up to the capacity comes to the driver.
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan(histogram, capacity))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    numbered = found.join(bases, ["length", "part"]).select(*kept, (F.col("number") + F.col("base")).alias("number"))

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("number").to_numpy())
                columns = [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, " + ("ids binary, " if with_ids else "") + "sequence_id long, offset long"
    return numbered.mapInArrow(place, schema)

"""Removing repeated passages, found by recompression.

A text's words become 64-bit names. Rounds then name short runs of one symbol,
and pairs of symbols whose names fall into a left and a right class; a name is
a hash of what it stands for, so all tasks give equal pairs equal names with
nothing to look up. As a round looks at neighbours only, equal passages get
equal symbols but near their ends. Each symbol carries the span of words that
settled it, so it is known which symbols any other place with those words has
too, wherever it stands.

Every window of 35 words is filed under its first symbol border that its own
words settle, and the two symbols at that border are its key. Keys are counted
over the corpus by an exchange of coded hashes; only windows under a shared key
(or with no settled border at all) are compared by hashes of all their words,
96 bits, in a second exchange. Texts never leave
their partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm import exchange, golomb
from dockflow.llm.common import cut
from dockflow.llm.xxh64 import hash_slices

WINDOW = 35
#: Longest run that gets a name, and the longest symbol of each round of pairs.
RUN, ROUNDS = 3, (2, 4, 6, 8)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BASES = (0x2545F4914F6CDD1D, 0xD1342543DE82EF95)
_STEP = 1 << 21


_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A name for symbol a followed by b."""
    return _mixed(a * _A + ((b << np.uint64(23)) | (b >> np.uint64(41))) * _C)


class Symbols:
    """The symbols over words ``[0, n)`` of several texts on end: name, first
    word, span, and the first and last word that settled each."""

    def __init__(self, words: np.ndarray, firsts: np.ndarray):
        n = len(words)
        self.words, self.firsts = words, firsts  # firsts: where texts begin
        self.name, self.at, self.span = words, np.arange(n, dtype=np.int32), np.ones(n, np.int32)
        self.low = self.high = self.at

    def _opens(self) -> np.ndarray:
        """Whether a symbol is its text's first one."""
        opens = np.zeros(len(self.words) + 1, bool)
        opens[self.firsts] = True
        return opens[self.at]

    def _keep(self, name, span, low, high, keep) -> None:
        self.name, self.at, self.span, self.low, self.high = name[keep], self.at[keep], span[keep], low[keep], high[keep]

    def runs(self) -> None:
        """Name maximal runs of 2 to ``RUN`` equal words; words of longer runs stay."""
        n = len(self.name)
        new = self._opens()
        new[1:] |= self.name[1:] != self.name[:-1]
        i = np.arange(n, dtype=np.int32)
        low, high, name, span, keep = i - 1, i + 1, self.name, self.span, np.ones(n, bool)
        repeats = np.flatnonzero(~new)
        if len(repeats):
            first = np.flatnonzero(new)
            size = np.diff(first, append=n)
            # The words of runs alone: their run's first and last word.
            among = np.flatnonzero(np.repeat(size > 1, size))
            run = np.searchsorted(first, among, side="right") - 1
            a, b, k = first[run], first[run] + size[run] - 1, size[run]
            short = k <= RUN
            # A word is settled by its whole run and the words beside it, in a long run by so many equal neighbours.
            low[among] = np.where(short, a - 1, np.maximum(a - 1, among - RUN))
            high[among] = np.where(short, b + 1, np.minimum(b + 1, among + RUN))
            at = among[short & new[among]]
            name, span = name.copy(), span.copy()
            name[at] = _named(name[at], k[short & new[among]].astype(np.uint64) * _A)
            span[at] = k[short & new[among]]
            keep[among[short & ~new[among]]] = False
        self._keep(name, span, low, high, keep)

    def pairs(self, round_: int, longest: int) -> None:
        """Name pairs of a left and a right symbol up to ``longest`` words."""
        n = len(self.name)
        left = _mixed(self.name * _A + np.uint64(round_)) >> np.uint64(63) == 0
        opens = self._opens()
        joins = np.zeros(n, bool)  # with the next one
        joins[:-1] = left[:-1] & ~left[1:] & ~opens[1:] & (self.span[:-1] + self.span[1:] <= longest)
        joined = np.zeros(n, bool)
        joined[1:] = joins[:-1]
        # A left symbol is settled by the next one, a right one by the one before; a text's
        # ends are settled by what isn't there. Symbols of full length need no neighbour.
        open_ = self.span < longest
        low, high = self.low, self.high
        before_low, before_high = np.roll(self.low, 1), np.roll(self.high, 1)  # never asked for at a text's ends
        after_low, after_high = np.roll(self.low, -1), np.roll(self.high, -1)
        closes = np.append(opens[1:], True)
        look = left & open_
        low = np.where(look & ~closes, np.minimum(low, after_low), low)
        high = np.where(look, np.where(closes, np.maximum(high, self.at + self.span), np.maximum(high, after_high)), high)
        look = ~left & open_
        high = np.where(look & ~opens, np.maximum(high, before_high), high)
        low = np.where(look, np.where(opens, np.minimum(low, self.at - 1), np.minimum(low, before_low)), low)
        name, span = self.name.copy(), self.span.copy()
        at = np.flatnonzero(joins)
        name[at] = _named(self.name[at], self.name[at + 1])
        span[at] += self.span[at + 1]
        low[at] = np.minimum(self.low[at], self.low[at + 1])
        high[at] = np.maximum(self.high[at], self.high[at + 1])
        self._keep(name, span, low, high, ~joined)

    def borders(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, first, last settling word) of the borders inside texts."""
        inner = np.flatnonzero(~self._opens())
        key = _named(self.name[inner - 1], self.name[inner])
        return key, np.minimum(self.low[inner - 1], self.low[inner]), np.maximum(self.high[inner - 1], self.high[inner])


def parse(words: np.ndarray, firsts: np.ndarray) -> Symbols:
    symbols = Symbols(words, firsts)
    if len(words):
        with np.errstate(over="ignore"):
            symbols.runs()
            for round_, longest in enumerate(ROUNDS):
                symbols.pairs(round_, longest)
    return symbols


def windows(n_words: np.ndarray) -> np.ndarray:
    """First words of all windows of texts with so many words."""
    many = np.maximum(n_words - WINDOW + 1, 0)
    first = np.cumsum(n_words) - n_words
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - first, many)


def filed(starts: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each window the first border whose settling words all lie in it, or -1."""
    found = np.full(len(starts), -1)
    if not len(low):
        return found
    at = np.searchsorted(np.maximum.accumulate(low), starts)
    asked = np.arange(len(starts))
    while len(asked):
        inside = at < len(low)
        asked, at = asked[inside], at[inside]
        good = (low[at] >= starts[asked]) & (high[at] < starts[asked] + WINDOW)
        found[asked[good]] = at[good]
        # Further borders are no use once one begins to be settled behind the window.
        more = ~good & (low[at] < starts[asked] + WINDOW)
        asked, at = asked[more], at[more] + 1
    return found


@lru_cache(2)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2**bits powers of a base and of its inverse, modulo 2**64."""
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        row = np.full(1 << bits, factor, np.uint64)
        row[0] = 1
        out.append(np.cumprod(row, dtype=np.uint64))
    return out[0], out[1]


def hashes(words: np.ndarray, starts: np.ndarray, bases: tuple = _BASES) -> tuple[np.ndarray, np.ndarray]:
    """Independent hashes of the windows: 64 bits, and with two bases 32 bits as a tag."""
    out = []
    with np.errstate(over="ignore"):
        for base in bases:
            up, down = _powers(base, max(10, len(words).bit_length()))
            total = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * down[: len(words)], out=total[1:])
            out.append(_mixed((total[starts + WINDOW] - total[starts]) * up[starts]))
    return out[0], (out[-1] >> np.uint64(32)).astype(np.uint32)


def _groups(rows: Iterator, payloads: bool) -> Iterator[tuple[list, np.ndarray | None]]:
    """Rows of about ``_STEP`` bytes with the shared hashes of their partition."""
    waiting, size, shared = [], 0, None
    for row in rows:
        if payloads:
            row, mail = row
            if mail is not None:
                shared = np.sort(np.concatenate([golomb.decode(m) for m in mail])) if mail else np.zeros(0, np.uint64)
        waiting.append(row)
        size += len(row[1])
        if size >= _STEP:
            yield waiting, shared
            waiting, size = [], 0
    if waiting:
        yield waiting, shared


class _Group:
    """The words of some rows: name, first and last byte of each, and how many a row has."""

    def __init__(self, rows: list):
        self.data = b"\n".join([b"", *(body for _, body in rows), b""])
        white = _WHITE[np.frombuffer(self.data, np.uint8)]
        turns = np.flatnonzero(white[1:] != white[:-1]) + 1
        self.starts, self.ends = turns[::2], turns[1::2]
        sizes = np.array([len(body) + 1 for _, body in rows], np.int64)
        self.n_words = np.diff(np.searchsorted(self.starts, np.append(0, np.cumsum(sizes)) + 1))
        self.words = hash_slices(self.data, self.starts, self.ends)


def _in(values: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Which values are among the ascending ``shared``; a table of their low bits
    spares most of the searching."""
    found = np.zeros(len(values), bool)
    if len(shared):
        table = np.zeros(1 << 22, bool)
        table[(shared & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        maybe = np.flatnonzero(table[(values & np.uint64((1 << 22) - 1)).astype(np.int64)])
        asked = values[maybe]
        found[maybe] = shared[np.minimum(np.searchsorted(shared, asked), len(shared) - 1)] == asked
    return found


def _filed_windows(n_words: np.ndarray, words: np.ndarray):
    """(window starts, border of each, border keys)."""
    firsts = (np.cumsum(n_words) - n_words)[n_words > 0]
    key, low, high = parse(words, firsts).borders() if len(words) else (words, firsts, firsts)
    starts = windows(n_words)
    return starts, filed(starts, low, high), key


_SENT = "owner int, part int, codes binary, twice binary, tags binary"
_KINDS = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _messages(part: int, groups: Iterator, per_group, owners: int) -> Iterator[tuple]:
    """What a partition sends: its number of rows, and its hashes to their owners."""
    values, tags, n = [], [], 0
    for group, shared in groups:
        n += len(group)
        value, tag = per_group(group, shared)
        values.append(value)
        tags.append(tag)
    if n:
        yield -1, n, part.to_bytes(4, "little"), b"", b""
        value = np.concatenate(values)
        if len(value):
            yield from exchange.messages(part, value, None if tags[0] is None else np.concatenate(tags), owners)


def _with_shared(rows: RDD, sent: DataFrame, owners: int) -> RDD:
    """``rows`` with, beside each partition's first row, the coded hashes among
    those it sent that occur elsewhere too."""
    counts = {int.from_bytes(bytes(r.codes), "little"): r.part for r in sent.where("owner < 0").toLocalIterator()}
    replies = exchange.answers(sent.where("owner >= 0").rdd, owners)

    def lay(part, mail, n):
        yield [m[1] for m in mail]
        for _ in range(n - 1):
            yield None

    return exchange.align(rows, counts, replies, lay)


def _keys_of(group: list, shared) -> tuple[np.ndarray, None]:
    g = _Group(group)
    _, border, key = _filed_windows(g.n_words, g.words)
    used = np.zeros(len(key), bool)
    used[border[border >= 0]] = True
    return key[used], None


def _candidates_of(group: list, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g = _Group(group)
    starts, border, key = _filed_windows(g.n_words, g.words)
    suspect = border < 0
    suspect[~suspect] = _in(key, shared)[border[~suspect]]
    return hashes(g.words, starts[suspect])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (words joined by a space).

    Words are what ASCII white space parts, unchanged. A word goes if a window
    of 35 words that covers it also starts anywhere else in the corpus, in the
    same text included; all windows are judged on the texts as they came. A
    null text, or one of white space, has no words; one of fewer than 35 words
    keeps them all. Repeated rows lose their windows to each other. One row per
    row, no rows give no rows, other columns aren't read. The rows are read
    three times and must come in the same order, as from files.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body"))
    rows = own.rdd.map(lambda r: (r[0], bytes(r[1])))
    owners = max(rows.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def send_keys(batches):
        pairs = (pair for batch in batches for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for row in _messages(TaskContext.get().partitionId(), _groups(pairs, False), _keys_of, owners):
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, _KINDS)], names=_SENT.replace(",", "").split()[::2])

    def send_windows(part, of):
        return _messages(part, _groups(of, True), _candidates_of, owners)

    with_keys = _with_shared(rows, cut(own.mapInArrow(send_keys, _SENT)), owners)
    sent = spark.createDataFrame(with_keys.mapPartitionsWithIndex(send_windows), _SENT, verifySchema=False)
    with_windows = _with_shared(rows, cut(sent), owners)

    def clean(of):
        for group, shared in _groups(of, True):
            g = _Group(group)
            starts = windows(g.n_words)
            again = starts[_in(hashes(g.words, starts, _BASES[:1])[0], shared)]
            edge = np.zeros(len(g.words) + 1, np.int64)
            edge[again] += 1
            np.subtract.at(edge, again + WINDOW, 1)
            gone, first = np.cumsum(edge[:-1]) > 0, 0
            for (name, body), n in zip(group, g.n_words.tolist()):
                kept = first + np.flatnonzero(~gone[first : first + n])
                if len(kept) == n:
                    left = b" ".join(body.split())
                else:
                    left = b" ".join([g.data[a:b] for a, b in zip(g.starts[kept].tolist(), g.ends[kept].tolist())])
                yield name, n, n - len(kept), left
                first += n

    schema = "doc_id long, n_words long, n_removed long, kept binary"
    cleaned = spark.createDataFrame(with_windows.mapPartitions(clean), schema, verifySchema=False)
    return cleaned.withColumn("kept", F.decode("kept", "UTF-8"))

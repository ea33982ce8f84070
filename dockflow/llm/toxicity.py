"""Toxicity by class-conditional Kneser-Ney models.

Words are runs of letters in lower case. Each class has an interpolated bigram
model over its own unigrams, whose mass for rare words comes from continuation
counts (in how many contexts a word occurs) that both classes share. That mass is
the same for both, so that a word neither class knows speaks for none, and a pair's
probability leans on its second word's as if the first had been seen
``CONCENTRATION`` times more (Pitman-Yor's form of Kneser-Ney). A text's
evidence is the difference of its two log-likelihoods, per word.

Counting covers every labelled row that may be learnt from, and keeps every word
and every pair, also those seen once: the counts are tables that grow with the
input and are dealt to owners, so no task holds the model. To score texts, a
chunk of them asks the owners for the words and pairs that it holds, and the
answers are laid beside its rows; texts aren't shuffled. As in exact dedup, rows
must come in the same order each time, as from files; a checksum shows if not.

Words travel as themselves. Inside pairs they go by 63-bit names, which are
checked to be unique among all counted words. A pair is asked for by a 63-bit
mix of its two names; below 10**9 distinct pairs none are expected to share one.
A bounded number of common words has short codes: every worker holds these words'
figures, and a pair of two of them travels as a 32-bit key that stands for no other
pair. Which words have codes changes the size of messages and nothing else.
"""

from __future__ import annotations

import ctypes
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm import exchange
from dockflow.llm.common import held_out, over_texts
from dockflow.session import scratch_path, setting

#: Labelled rows, chosen by a hash of their id, on which scores are fitted to labels.
FITTED_ROWS = 20_000
THRESHOLD = 0.7
#: Of 50, 500, 3,000 and 20,000 the best on the learnable rows of sf0.1 (AUC 0.900 to 0.956).
CONCENTRATION = 20_000
_WORD = re.compile(r"[^\W\d_]+")
FEATURES = 3
#: How often a word or pair occurs in texts of either class, and in one half of these.
COUNTS = ["toxic", "plain", "half_toxic", "half_plain"]
#: Per word: its ``COUNTS``, how often it begins a pair, how many kinds of pairs
#: it begins (both by ``COUNTS``), and in how many contexts it occurs (all rows, the half).
FIGURES = 14
#: A sieve of one bit for each value of the names' highest bits keeps back
#: questions for words and pairs that surely don't occur. It has a fixed size and only saves
#: questions: the fuller it is, the more are asked.
SIEVE = 27
_LABEL_BITS = 1 << 20
_SIEVED = 63 - SIEVE
#: Bits of a common word's code, and the rows, chosen by a hash of their id, whose most frequent words get one.
CODE_BITS, CODED_ROWS = 16, 4_000
#: Keys of two codes have zeros in these low bits, keys of two names don't.
_LOW = 63 - 2 * CODE_BITS
#: Words that a counting task holds before it sends them on, words of the texts
#: that ask together, and characters of all texts per owner.
FLUSH, CHUNK, OWNED_CHARS = 250_000, 1 << 18, 8_000_000
#: Pairs of a chunk whose names or ratios are worked out at once.
BLOCK = 1 << 16
#: Texts ask in so many rounds, by partition: a round's questions leave the disk before the next one's come.
ROUNDS = 2
#: Rows in an Arrow batch: whole texts lie in it several times, on both sides of a worker.
BATCH_ROWS = 1_000


def _named(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w.encode()) >> 1 for w in words], np.int64)


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@lru_cache(1)
def _letters() -> np.ndarray:
    """True for the code points that words are made of."""
    table = np.zeros(0x110000, bool)
    for run in _WORD.finditer(np.arange(len(table), dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")):
        table[run.start() : run.end()] = True
    return table


def _word_array(text: str | None) -> pa.Array:
    """``_words`` without a Python string for each."""
    text = (text or "").lower()
    body, codes = np.frombuffer(text.encode(), np.uint8), np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = _letters()[codes]
    edges = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    if len(body) > len(codes):
        width = np.ones(len(codes), np.uint8)
        for bound in (0x7F, 0x7FF, 0xFFFF):
            width += codes > bound
        edges = np.concatenate([np.zeros(1, np.int32), np.cumsum(width, dtype=np.int32)])[edges]
        letter = np.repeat(letter, width)
    offsets = np.zeros(len(edges) // 2 + 1, np.int32)
    np.cumsum(edges[1::2] - edges[::2], out=offsets[1:])
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(body[letter]))


def _indices(array: pa.Array) -> np.ndarray:
    """32-bit numbers, -1 for nulls. Arrow's own ways to numpy import pandas, 27 MB in every worker of a core."""
    if not len(array):
        return np.zeros(0, np.int32)
    valid, data = array.buffers()
    numbers = np.frombuffer(data, np.int32, len(array), 4 * array.offset)
    if valid is not None:
        there = np.unpackbits(np.frombuffer(valid, np.uint8), bitorder="little")[array.offset : array.offset + len(array)]
        numbers = np.where(there, numbers, np.int32(-1))
    return numbers


def _pair_names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


#: Factors of a mix of 32 bits that can be taken back.
_FACTORS = (0x7FEB352D, 0x846CA68B)


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = codes.astype(np.uint32)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(_FACTORS[0])
    x = (x ^ (x >> np.uint32(15))) * np.uint32(_FACTORS[1])
    return (x ^ (x >> np.uint32(16))).astype(np.int64)


def _unmixed(mixed: np.ndarray) -> np.ndarray:
    first, second = (np.uint32(pow(f, -1, 1 << 32)) for f in _FACTORS)
    x = mixed.astype(np.uint32)
    x = (x ^ (x >> np.uint32(16))) * second
    x = (x ^ (x >> np.uint32(15)) ^ (x >> np.uint32(30))) * first
    return (x ^ (x >> np.uint32(16))).astype(np.int64)


def _pair_keys(a: np.ndarray, b: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Keys of pairs of words with names ``a`` and ``b`` and codes (or -1) ``first`` and ``second``."""
    keys = _pair_names(a, b)
    keys += (keys & ((1 << _LOW) - 1)) == 0
    both = np.flatnonzero((first >= 0) & (second >= 0))
    keys[both] = _mixed((first[both] << CODE_BITS) | second[both]) << _LOW
    return keys


def _short(keys: np.ndarray) -> np.ndarray:
    """True for the keys of two codes."""
    return (keys & ((1 << _LOW) - 1)) == 0


class Common:
    """The words that have codes, by code: in the order of their names."""

    def __init__(self, words: list[str]):
        names = _named(words)
        order = np.argsort(names, kind="stable")
        self.words, self.names = pa.array([words[i] for i in order], pa.string()), names[order]

    def codes(self, vocab: pa.Array) -> np.ndarray:
        """Their codes, -1 for words without one."""
        return _indices(pc.index_in(vocab, value_set=self.words)).astype(np.int64)

    def codes_of(self, names: np.ndarray) -> np.ndarray:
        """The same by the names of counted words."""
        if not len(self.names):
            return np.full(len(names), -1)
        at = np.minimum(np.searchsorted(self.names, names), len(self.names) - 1)
        return np.where(self.names[at] == names, at, -1)


class Guide:
    """What every worker holds: the sieve, and the common words with their figures."""

    def __init__(self, bits: np.ndarray, common: Common, figures: np.ndarray):
        self.bits, self.common, self.figures = bits, common, figures


def _owner(names: np.ndarray, owners: int) -> np.ndarray:
    """Owners hold ranges of names."""
    return ((names >> 32) * owners) >> 31


@lru_cache(1)
def _zstd() -> tuple:
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _squeezed(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes; their high planes are mostly zero."""
    if not numbers.size:
        return b""
    planes = np.ascontiguousarray(numbers, "<i8").reshape(-1).view(np.uint8).reshape(-1, 8).T
    return _zstd()[0].compress(np.ascontiguousarray(planes).tobytes())


def _opened(data: bytes | None, rows: int = 1) -> np.ndarray:
    if not data:
        return np.zeros((rows, 0), np.int64)
    planes = np.frombuffer(_zstd()[1].decompress(bytes(data)), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").reshape(rows, -1)


def _joined(words: list[str]) -> bytes:
    return _zstd()[0].compress("\n".join(words).encode()) if words else b""


def _split(data: bytes | None) -> list[str]:
    return _zstd()[1].decompress(bytes(data)).decode().split("\n") if data else []


def _split_array(data: bytes | None) -> pa.Array:
    """``_split`` without a Python string for each."""
    body = np.frombuffer(_zstd()[1].decompress(bytes(data)) if data else b"", np.uint8)
    ends = np.append(np.flatnonzero(body == 10), len(body)) if len(body) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(body[body != 10]))


def _two(first: bytes, second: bytes) -> bytes:
    return len(first).to_bytes(4, "little") + first + second if first or second else b""


def _both(data: bytes | None) -> tuple[bytes, bytes]:
    data = bytes(data or b"\0\0\0\0")
    end = 4 + int.from_bytes(data[:4], "little")
    return data[4:end], data[end:]


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys of pairs; those of two codes without their zeros."""
    short = _short(keys)
    return _two(_squeezed(np.diff(keys[short] >> _LOW, prepend=0)), _squeezed(np.diff(keys[~short], prepend=0)))


def _opened_keys(data: bytes | None) -> np.ndarray:
    short, names = (np.cumsum(_opened(x)[0]) for x in _both(data))
    return np.sort(np.concatenate([short << _LOW, names]), kind="stable")


def _written(table: DataFrame, name: str) -> str:
    """The path that the table is written to. The files of its shuffles go with the
    write, as what is read from here on is the table."""
    path = scratch_path(table.sparkSession, name)
    with setting(table.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        table.write.parquet(path)
    return path


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(name, toxic, n_words, words) of the labelled rows that aren't held out.

    Texts become packed words before they meet their labels, so that no text is
    shuffled; the join is the same at every size. The table is written, as both
    the counts and the fitting read it.
    """
    label = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    label = label.groupBy(F.col("doc_id").cast("long").alias("name")).agg((F.max("toxic") >= 1).alias("toxic"))
    learnt = docs.where(~held_out(doc_id) & F.col(doc_id).isNotNull())
    # A row without a label mostly stops here: its id's bit isn't set. With many labels all bits are, and the join alone decides.
    bits = np.zeros(_LABEL_BITS, bool)
    bits[[r[0] for r in label.select(F.pmod(F.xxhash64("name"), F.lit(_LABEL_BITS)).cast("int")).distinct().toLocalIterator()]] = True
    near = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batch):
        place = batch.column(2).to_numpy()
        batch = batch.filter(pa.array(near.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1, pa.uint8()).cast(pa.bool_()))
        # One text's words at a time: lists of all take many times the texts' memory.
        packed = [(len(w), _joined(w)) for w in map(_words, batch.column(1).to_pylist())]
        columns = [pa.array([p[i] for p in packed], k) for i, k in enumerate((pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["name", "n_words", "words"])

    name = F.col(doc_id).cast("long")
    place = F.pmod(F.xxhash64(name), F.lit(_LABEL_BITS)).cast("int").alias("place")
    read = over_texts(learnt, [name.alias("name"), F.col(text).alias("body"), place], run, "name long, n_words long, words binary")
    return docs.sparkSession.read.parquet(_written(read.join(label.hint("merge"), "name").select("name", "toxic", "n_words", "words"), "labelled"))


def _summed(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their columns in ``table``, and where each first stood."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(table[:, order], first, axis=1) if len(keys) else table, order[first]


def _slices(to: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(owner, start, end) of the runs in sorted owners."""
    starts = np.flatnonzero(np.diff(to, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], len(to)]):
        yield int(to[a]), a, b


def _as_batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


#: One owner's share of pairs (kind 1), words (2) or figures of words by name (0);
#: 3: counts of counts, 5: bits of the sieve; 6 and 7: as 1 and 0, by codes; 8: all figures of common words.
_SHARE, _SHARE_KINDS = ["kind", "owner", "packed", "words"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
_SHARE_DDL = "kind int, owner int, packed binary, words binary"


def _common(known: DataFrame) -> Common:
    """The most frequent words of a bounded number of rows."""
    rows = known.where("n_words > 0")
    n = rows.count()
    some = rows.where(F.pmod(F.xxhash64("name"), F.lit(1 << 20)) * F.lit(n) < F.lit(CODED_ROWS << 20))

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                counted = pc.value_counts(pa.array(_split(data), pa.string()))
                yield pa.RecordBatch.from_arrays(counted.flatten(), names=["word", "n"])

    counts = some.select("words").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return Common([r.word for r in counts.orderBy(F.desc("n"), "word").limit(1 << CODE_BITS).select("word").collect()])


def _partial_counts(known: DataFrame, owners: int, held: Broadcast) -> DataFrame:
    """Shares of pairs (names of both words or their key of codes, ``COUNTS``) and of words
    (``COUNTS`` alone and at the head of a pair), added up by each task first."""

    def run(batches):
        index, waiting, size = {}, {}, 0

        def flush():
            vocab = list(index)
            names, figures = _named(vocab), np.zeros((2 * len(COUNTS), len(vocab)), np.int64)
            codes, tables = [], []
            for (half, toxic), texts in waiting.items():
                at = [0 if toxic else 1] + ([2 if toxic else 3] if half else [])
                alone = np.bincount(np.concatenate(texts), minlength=len(vocab))
                found = np.concatenate([(t[:-1] << 32) | t[1:] for t in texts])
                found, n = np.unique(found, return_counts=True)
                table = np.zeros((len(COUNTS), len(found)), np.int64)
                for i in at:
                    figures[i] += alone
                    figures[4 + i] += np.bincount(found >> 32, weights=n, minlength=len(vocab)).astype(np.int64)
                    table[i] = n
                codes.append(found)
                tables.append(table)
            code, table, _ = _summed(np.concatenate(codes), np.concatenate(tables, axis=1))
            own = held.value.codes(pa.array(vocab, pa.string()))
            first, second, rows = code >> 32, code & 0xFFFFFFFF, []
            keys = _pair_keys(names[first], names[second], own[first], own[second])
            short, to = _short(keys), _owner(keys, owners)
            order = np.flatnonzero(short)
            order = order[np.argsort(keys[order])]
            for owner, i, j in _slices(to[order]):
                at = order[i:j]
                rows.append((6, owner, _squeezed(np.vstack([np.diff(keys[at] >> _LOW, prepend=0), table[:, at]])), None))
            a, b, order = names[first], names[second], np.flatnonzero(~short)
            order = order[np.lexsort((a[order], to[order]))]
            for owner, i, j in _slices(to[order]):
                at = order[i:j]
                rows.append((1, owner, _squeezed(np.vstack([np.diff(a[at], prepend=0), b[at], table[:, at]])), None))
            order = np.argsort(names)
            for owner, i, j in _slices(_owner(names[order], owners)):
                rows.append((2, owner, _squeezed(figures[:, order[i:j]]), _joined([vocab[x] for x in order[i:j]])))
            return _as_batch(rows, _SHARE, _SHARE_KINDS)

        for batch in batches:
            for half, toxic, data in zip(*(c.to_pylist() for c in batch.columns)):
                words = _split(data)
                waiting.setdefault((half, toxic), []).append(np.array([index.setdefault(w, len(index)) for w in words], np.int64))
                size += len(words)
                if size > FLUSH:
                    yield flush()
                    index, waiting, size = {}, {}, 0
        if size:
            yield flush()

    half = (F.crc32(F.col("name").cast("string").cast("binary")) % 3 == 0).alias("half")
    return known.where("n_words > 0").select(half, "toxic", "words").mapInArrow(run, _SHARE_DDL)


def _owned(group: pa.Table, owners: int, common: Common) -> pa.Table:
    """One owner's share of all pairs and words, the figures that its pairs give
    to words elsewhere, and its counts of counts."""
    rows, owner = [], group.column("owner")[0].as_py()
    parts = list(zip(*(group.column(c).to_pylist() for c in ("kind", "packed", "words"))))
    pairs = []
    for kind, packed, _ in parts:
        if kind == 1:
            table = _opened(packed, 2 + len(COUNTS))
            a, none = np.cumsum(table[0]), np.full(table.shape[1], -1)
            pairs.append((_pair_keys(a, table[1], none, none), a, table[1], table[2:]))
        elif kind == 6:
            table = _opened(packed, 1 + len(COUNTS))
            keys = np.cumsum(table[0])
            code = _unmixed(keys)
            pairs.append((keys << _LOW, common.names[code >> CODE_BITS], common.names[code & ((1 << CODE_BITS) - 1)], table[1:]))
    if pairs:
        keys, n, first = _summed(np.concatenate([p[0] for p in pairs]), np.concatenate([p[3] for p in pairs], axis=1))
        a, b = (np.concatenate([p[i] for p in pairs])[first] for i in (1, 2))
        rows.append((1, owner, _squeezed(n), _packed_keys(keys)))
        rows.append((5, owner, _squeezed(np.diff(np.unique(keys >> _SIEVED), prepend=0)), None))
        rows.append((3, owner, _squeezed(np.array([(c == times).sum() for c in n for times in (1, 2)])), None))
        seen, where = np.zeros((6, 2 * len(a)), np.int64), np.concatenate([a, b])
        seen[:4, : len(a)] = n > 0
        seen[4, len(a) :], seen[5, len(a) :] = (n[0] + n[1]) > 0, (n[2] + n[3]) > 0
        names, seen, _ = _summed(where, seen)
        codes = common.codes_of(names)
        for kind, by, at in ((0, names, np.flatnonzero(codes < 0)), (7, codes, np.flatnonzero(codes >= 0))):
            for to, i, j in _slices(_owner(names[at], owners)):
                rows.append((kind, to, _squeezed(np.vstack([np.diff(by[at[i:j]], prepend=0), seen[:, at[i:j]]])), None))
    index, tables = {}, []
    for kind, packed, words in parts:
        if kind == 2:
            tables.append((np.array([index.setdefault(w, len(index)) for w in _split(words)], np.int64), _opened(packed, 2 * len(COUNTS))))
    if index:
        total = np.zeros((2 * len(COUNTS), len(index)), np.int64)
        for at, table in tables:
            total[:, at] += table  # a share names a word once
        rows.append((2, owner, _squeezed(total), _joined(list(index))))
    return pa.Table.from_batches([_as_batch(rows, _SHARE, _SHARE_KINDS)])


def _figured(group: pa.Table, common: Common) -> pa.Table:
    """One owner's words, in the order of their names, with all ``FIGURES``; kind 4 holds what the driver adds up."""
    owner, figures, names, words = group.column("owner")[0].as_py(), None, None, []
    parts = list(zip(*(group.column(c).to_pylist() for c in ("kind", "packed", "words"))))
    for kind, packed, body in parts:
        if kind == 2:
            words = _split(body)
            names = _named(words)
            order = np.argsort(names)
            names, words = names[order], [words[i] for i in order]
            figures = np.zeros((FIGURES, len(words)), np.int64)
            figures[:8] = _opened(packed, 8)[:, order]
    if (np.diff(names) == 0).any():
        raise RuntimeError("two words share a name; name words by another hash")
    for kind, packed, _ in parts:
        if kind in (0, 7):
            table = _opened(packed, 7)
            by = np.cumsum(table[0])
            figures[8:, np.searchsorted(names, common.names[by] if kind == 7 else by)] += table[1:]
    sums = [len(words), *figures[12:].sum(axis=1)]
    for count in figures[: len(COUNTS)]:
        sums += [count.sum(), (count == 1).sum(), (count > 1).sum()]
    rows = [(5, owner, _squeezed(np.diff(np.unique(names >> _SIEVED), prepend=0)), None)]
    rows += [(2, owner, _squeezed(figures), _joined(words)), (4, owner, _squeezed(np.array(sums)), None)]
    codes = common.codes_of(names)
    own = np.flatnonzero(codes >= 0)
    rows.append((8, owner, _squeezed(np.vstack([np.diff(codes[own], prepend=0), figures[:, own]])), None))
    return pa.Table.from_batches([_as_batch(rows, _SHARE, _SHARE_KINDS)])


def _discount(once: int, twice: int) -> float:
    """A class's Kneser-Ney discount from how many of its pairs occur once and twice."""
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.75


class Model:
    """What both classes' models of all rows (``at`` 0) or of the half (2) need beside the tables."""

    def __init__(self, at: int, seldom: np.ndarray, sums: np.ndarray):
        self.at, self.discounts = at, [_discount(*seldom[2 * i : 2 * i + 2].tolist()) for i in (at, at + 1)]
        # A word that no row holds counts as one more word, without contexts.
        self.shared = float(sums[1 + at // 2]) + 0.5 * (int(sums[0]) + 1)
        self.totals, spare = [], []
        for i, d in zip((at, at + 1), self.discounts):
            count, once, more = (int(x) for x in sums[3 + 3 * i : 6 + 3 * i])
            total = max(count, 1)
            self.totals.append(total)
            # One count is little evidence in so open a vocabulary: it is discounted whole.
            spare.append(max((once + more * (1.0 + d)) / total, 1e-9))

        self.spare = min(spare)

    def ratios(self, words: np.ndarray, begins: np.ndarray, figures: np.ndarray, back: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """The log-ratio of every word in ``words`` (places in ``figures``: count,
        head of pairs, kinds by class, contexts). ``begins`` are the places in
        ``words`` where a pair starts, ``back`` that pair's column in ``pairs``."""
        alone, open_ = [], []
        for i, (d, total) in enumerate(zip(self.discounts, self.totals)):
            count, heads, kinds = figures[i], figures[2 + i], figures[4 + i]
            alone.append((count - np.minimum(count, 1.0 + d)) / total + self.spare * (figures[6] + 0.5) / self.shared)
            open_.append((CONCENTRATION + d * kinds) / (CONCENTRATION + heads))
        ratio = np.log(alone[0] / alone[1])[words]
        for start in range(0, len(begins), BLOCK):
            at, column, both = begins[start : start + BLOCK], back[start : start + BLOCK], []
            first, second = words[at], words[at + 1]
            for i, d in enumerate(self.discounts):
                both.append(np.maximum(pairs[i, column] - d, 0) / (CONCENTRATION + figures[2 + i][first]) + open_[i][first] * alone[i][second])
            ratio[at + 1] = np.log(both[0] / both[1])
        return ratio


def models(known: DataFrame, owners: int) -> tuple[DataFrame, Broadcast, Model, Model]:
    """The shares of pairs and words, the guide, and the models of one half of the
    learnable rows and of all of them. Only sums and the guide come to the driver,
    and the guide goes to each worker once, for both models."""
    spark = known.sparkSession
    common = _common(known)
    held = spark.sparkContext.broadcast(common)
    counts = _partial_counts(known, owners, held).groupBy("owner").applyInArrow(lambda g: _owned(g, owners, held.value), _SHARE_DDL)
    owned = spark.read.schema(_SHARE_DDL).parquet(_written(counts, "counts"))
    figures = owned.where("kind in (0, 2, 7)").groupBy("owner").applyInArrow(lambda g: _figured(g, held.value), _SHARE_DDL)
    figured = spark.read.schema(_SHARE_DDL).parquet(_written(figures, "figures"))
    seldom, sums = np.zeros(2 * len(COUNTS), np.int64), np.zeros(3 + 3 * len(COUNTS), np.int64)
    for r in owned.where("kind = 3").select("packed").toLocalIterator():
        seldom += _opened(r.packed)[0]
    for r in figured.where("kind = 4").select("packed").toLocalIterator():
        sums += _opened(r.packed)[0]
    bits = np.zeros(1 << SIEVE >> 3, np.uint8)
    for r in owned.union(figured).where("kind = 5").select("packed").toLocalIterator():
        at = np.cumsum(_opened(r.packed)[0])
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    head = np.zeros((FIGURES, len(common.names)), np.int64)
    for r in figured.where("kind = 8").select("packed").toLocalIterator():
        table = _opened(r.packed, 1 + FIGURES)
        head[:, np.cumsum(table[0])] = table[1:]
    shares = owned.where("kind = 1").union(figured.where("kind = 2"))
    return shares, spark.sparkContext.broadcast(Guide(bits, common, head.astype(np.min_scalar_type(head.max(initial=0))))), Model(2, seldom, sums), Model(0, seldom, sums)


class Chunk:
    """Consecutive texts and what they ask for: distinct words and pairs, in the
    order of their names."""

    def __init__(self):
        self.texts, self.size = [], 0

    def add(self, words: list[str] | pa.Array) -> None:
        self.texts.append(words if isinstance(words, pa.Array) else pa.array(words, pa.string()))
        self.size += len(words) + 1

    def close(self, common: Common | None = None) -> None:
        self.lengths = np.array([len(t) for t in self.texts])
        coded = pa.concat_arrays(self.texts).dictionary_encode()
        self.vocab, self.words, self.texts = coded.dictionary.to_pylist(), _indices(coded.indices), []
        names = _named(self.vocab)
        self.codes = common.codes(coded.dictionary) if common else np.full(len(names), -1)
        inside = np.ones(len(self.words), bool)
        ends = np.cumsum(self.lengths)
        inside[ends[self.lengths > 0] - 1] = False
        self.begins = np.flatnonzero(inside)
        keys = np.empty(len(self.begins), np.int64)
        for start in range(0, len(keys), BLOCK):
            at = self.begins[start : start + BLOCK]
            a, b = self.words[at], self.words[at + 1]
            keys[start : start + BLOCK] = _pair_keys(names[a], names[b], self.codes[a], self.codes[b])
        self.keys, self.back = np.unique(keys, return_inverse=True)
        self.word_order = np.argsort(names, kind="stable")
        self.names = names[self.word_order]
        self.check = zlib.crc32(self.words.tobytes(), len(self.lengths))


@lru_cache(1)
def _trim():
    """The C library's ``malloc_trim``, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda kept: 0)


def _give_back_arrow() -> None:
    """Unused memory of Arrow's pool goes back between two chunks."""
    pa.default_memory_pool().release_unused()


def _give_back() -> None:
    """As a task begins or ends, the C library's goes back, too: a core has several workers, which keep it
    while they wait. Between chunks that would cost a page fault for every page of the next."""
    _give_back_arrow()
    _trim()(0)


def _sifted(names: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Places of the names that the sieve lets through."""
    high = names >> _SIEVED
    return np.flatnonzero(sieve[high >> 3] >> (high & 7).astype(np.uint8) & 1)


def _asked(chunk: Chunk, guide: Guide) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs and, in the order of their names, of the words that a chunk asks for."""
    names = np.flatnonzero(chunk.codes[chunk.word_order] < 0)
    return _sifted(chunk.keys, guide.bits), names[_sifted(chunk.names[names], guide.bits)]


_ASK_DDL = "owner int, part int, chunk int, n_rows int, check long, keys binary, words binary"
_ASK = [c.split()[0] for c in _ASK_DDL.split(", ")]
_ASK_KINDS = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]


def _asks(rows: DataFrame, owners: int, guide: Broadcast, read) -> DataFrame:
    """Each chunk's questions, and one row with ``n_rows`` that every chunk has."""

    def run(batches):
        part, number, chunk = TaskContext.get().partitionId(), 0, Chunk()

        def asked():
            chunk.close(guide.value.common)
            out = [((part + number) % owners, part, number, len(chunk.lengths), chunk.check, None, None)]
            pairs, known = _asked(chunk, guide.value)
            keys = chunk.keys[pairs]
            for owner, a, b in _slices(_owner(keys, owners)):
                out.append((owner, part, number, 0, 0, _packed_keys(keys[a:b]), None))
            for owner, a, b in _slices(_owner(chunk.names[known], owners)):
                out.append((owner, part, number, 0, 0, None, _joined([chunk.vocab[i] for i in chunk.word_order[known[a:b]]])))
            return _as_batch(out, _ASK, _ASK_KINDS)

        for batch in batches:
            for body in batch.column("body").to_pylist():
                chunk.add(read(body))
                if chunk.size >= CHUNK:
                    yield asked()
                    number, chunk = number + 1, Chunk()
                    _give_back_arrow()
        if chunk.texts:
            yield asked()
        chunk = Chunk()
        _give_back()

    return rows.select("body").mapInArrow(run, _ASK_DDL)


def _rows_of(at: int) -> list[int]:
    """The ``FIGURES`` that the model of all rows (``at`` 0) or of the half (2) takes."""
    return [at, at + 1, 4 + at, 5 + at, 8 + at, 9 + at, 12 + at // 2]


def _answered(asks: pa.Table, shares: pa.Table, at: int) -> pa.Table:
    """Places of the words and pairs that occur, with their figures."""
    model = {k: (p, w) for k, p, w in zip(*(shares.column(c).to_pylist() for c in ("kind", "packed", "words")))}
    pairs, figures = _opened(model.get(1, (b"",))[0], len(COUNTS)), _opened(model.get(2, (b"",))[0], FIGURES)
    known = _opened_keys(model[1][1]) if 1 in model else np.zeros(0, np.int64)
    own = {w: i for i, w in enumerate(_split(model[2][1]))} if 2 in model else {}
    figures = figures[_rows_of(at)]
    out = []
    for owner, part, number, n_rows, check, keys, words in zip(*(asks.column(c).to_pylist() for c in _ASK)):
        if keys:
            wanted = _opened_keys(keys)
            place = np.searchsorted(known, wanted)
            place[place == len(known)] = 0
            hit = np.flatnonzero(known[place] == wanted) if len(known) else np.zeros(0, np.int64)
            counts = pairs[at : 2 + at, place[hit]]
            some = counts.any(axis=0)
            keys = _squeezed(np.vstack([np.diff(hit[some], prepend=0), counts[:, some]]))
        if words:
            place = np.array([own.get(w, -1) for w in _split(words)])
            hit = np.flatnonzero(place >= 0)
            words = _squeezed(np.vstack([np.diff(hit, prepend=0), figures[:, place[hit]]]))
        if n_rows or keys or words:
            out.append((owner, part, number, n_rows, check, keys, words))
    return pa.Table.from_batches([_as_batch(out, _ASK, _ASK_KINDS)])


def fit(features: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic weights (with a small ridge) and the features' scale."""
    scale = np.maximum(features.std(axis=0), 1e-9) if len(features) else np.ones(FEATURES)
    x = np.column_stack([features / scale, np.ones(len(features))])
    w = np.zeros(FEATURES + 1)
    if len(set(toxic.tolist())) < 2:
        w[-1] = 4.0 if len(toxic) and toxic.all() else -4.0
        return w, scale
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (toxic - p) - 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w, scale


def _features(rows: DataFrame, shares: DataFrame, guide: Broadcast, m: Model, owners: int, extra: str, read) -> DataFrame:
    """(name, extra, f0 …) of rows (name, body, extra): ratio per word, ratio per
    root of words, mean of the strongest fiftieth. ``read`` makes words of a body."""
    spark, at = rows.sparkSession, m.at
    own = rows.select("name", extra, "body")
    written = []

    def answer(asked, held):
        out = _answered(asked, held, at)
        _give_back()
        return out

    def plain(texts):
        # Spark hands tasks to whichever worker waits: this one may have held the guide and a chunk just before.
        _give_back()
        return map(tuple, texts)

    for turn in range(ROUNDS):
        asks = _asks(own.where(F.spark_partition_id() % ROUNDS == turn), owners, guide, read)
        replies = asks.groupBy("owner").cogroup(shares.groupBy("owner")).applyInArrow(answer, _ASK_DDL)
        # Written, so that the questions and the shares beside them leave the disk before the answers are dealt out.
        written.append(_written(replies, "replies"))
    replies = spark.read.schema(_ASK_DDL).parquet(*written)
    mail = replies.rdd.map(lambda r: (r[1], (r[2], r[0], r[3], r[4], r[5] and bytes(r[5]), r[6] and bytes(r[6]))))
    lines = own.rdd.mapPartitions(plain)

    def lay(own_mail):
        """Beside the first row of each chunk all answers to it, beside the others nothing."""
        _give_back()
        chunks: dict[int, list] = {}
        for _, message in own_mail:
            chunks.setdefault(message[0], []).append(message[1:])
        for number in sorted(chunks):
            yield chunks[number]
            for _ in range(sum(x[1] for x in chunks[number]) - 1):
                yield None

    def scored(waiting, answers):
        chunk = Chunk()
        for _, _, body in waiting:
            chunk.add(read(body))
        chunk.close(guide.value.common)
        if sum(x[2] for x in answers) != chunk.check:
            raise RuntimeError("the rows of a partition changed between two reads; write the table first")
        figures, pairs = np.zeros((7, len(chunk.vocab)), np.int64), np.zeros((2, len(chunk.keys)), np.int64)
        own = np.flatnonzero(chunk.codes >= 0)
        figures[:, own] = guide.value.figures[np.ix_(_rows_of(at), chunk.codes[own])]
        asked, known = _asked(chunk, guide.value)
        pair_owner, word_owner = _owner(chunk.keys[asked], owners), _owner(chunk.names[known], owners)
        for owner, _, _, keys, words in answers:
            if keys:
                table = _opened(keys, 3)
                start = np.searchsorted(pair_owner, owner)
                pairs[:, asked[start + np.cumsum(table[0])]] = table[1:]
            if words:
                table = _opened(words, 8)
                start = np.searchsorted(word_owner, owner)
                figures[:, chunk.word_order[known[start + np.cumsum(table[0])]]] = table[1:]
        ratio, lengths = m.ratios(chunk.words, chunk.begins, figures, chunk.back, pairs), chunk.lengths.tolist()
        del chunk, figures, pairs
        _give_back_arrow()
        end = 0
        for (name, flag, _), n in zip(waiting, lengths):
            r, end = ratio[end : end + n], end + n
            if not n:
                yield name, flag, 0.0, 0.0, 0.0
                continue
            lead = np.sort(r)[-max(1, n // 50) :]
            yield name, flag, float(r.mean()), float(r.sum() / np.sqrt(n)), float(lead.mean())

    def run(both):
        waiting, answers = [], []
        for row, mark in both:
            if mark is not None and waiting:
                yield from scored(waiting, answers)
                waiting = []
                _give_back_arrow()
            if mark is not None:
                answers = mark
            waiting.append(row)
        if waiting:
            yield from scored(waiting, answers)
        _give_back()

    laid = mail.partitionBy(max(lines.getNumPartitions(), 1), int).mapPartitions(lay)
    schema = f"name long, {extra} boolean, " + ", ".join(f"f{i} double" for i in range(FEATURES))
    return spark.createDataFrame(exchange._zip(lines, laid).mapPartitions(run), schema, verifySchema=False)


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted.

    Weights that turn evidence into a score are fitted on a bounded sample of
    one half of the learnable rows, scored by a model of the other half, so
    that no text's own counts speak for it. A null text, and one without words,
    has no evidence and gets the score of none. Labels for unknown ids, null
    labels and null ids teach nothing; with labels of one kind only, or none,
    every score is near that kind's end. One row per row.
    """
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)):
        return _scored(docs, labels, doc_id, text)


def _scored(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    # Owners grow in number with the texts, which all ask them.
    chars = docs.agg(F.sum(F.length(F.col(text)))).first()[0] or 0
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // OWNED_CHARS + 1)
    known = labelled(docs, labels, doc_id, text)
    shares, guide, first, whole = models(known, owners)
    # Ids alone are ordered; the rows themselves are then found where they lie.
    other = known.where(F.crc32(F.col("name").cast("string").cast("binary")) % 3 == 2).withColumn("place", F.struct(F.xxhash64("name").alias("h"), "name"))
    last = other.select("place").distinct().orderBy("place").limit(FITTED_ROWS).agg(F.max("place").alias("last")).first()["last"]
    h, name = (last.h, last.name) if last else (0, 0)
    inside = (F.col("place.h") < h) | ((F.col("place.h") == h) & (F.col("name") <= name))
    sample = other.where(inside).groupBy("name").agg(F.min("words").alias("body"), F.max("toxic").alias("toxic"))
    fitted = _features(spark.read.parquet(_written(sample, "sample")), shares, guide, first, owners, "toxic", _split_array).toPandas()
    # A fixed order of rows, so that sums don't depend on their arrival.
    fitted = fitted.sort_values("name")
    weights, scale = fit(fitted[[f"f{i}" for i in range(FEATURES)]].to_numpy(float), fitted["toxic"].to_numpy(float))
    rows = docs.select(F.col(doc_id).cast("long").alias("name"), F.col(text).alias("body"), held_out(doc_id).alias("held"))
    logit = sum((F.col(f"f{i}") * F.lit(float(weights[i] / scale[i])) for i in range(FEATURES)), F.lit(float(weights[-1])))
    value = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return _features(rows, shares, guide, whole, owners, "held", _word_array).select(
        F.col("name").alias("doc_id"), F.col("held").alias("held_out"), value.alias("score"), (value >= THRESHOLD).cast("int").alias("predicted")
    )

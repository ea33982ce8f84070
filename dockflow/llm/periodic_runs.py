"""Maximal periodic runs of words, found by Baier's suffix grouping.

The first phase of Baier's suffix sorter gathers suffixes into groups that share
their longest Lyndon prefix, so it yields the Lyndon array with no sorting to
follow. Grouping under an order of the words and under its reverse gives each
run's Lyndon root: a root that is followed by its equal is two neighbours of one
group. Chains of such neighbours are extended to both sides by the longest
common extension of a word and the one a period later.

Only stretches that can hold a run are grouped: in a run of 24 words and three
periods or more, every sequence of eight words recurs a period earlier or later,
so words that no recurring sequence of eight covers are in no run. This is
decided for many texts at once; hashes serve there, whose collisions only let
more stretches through. Words themselves are compared by exact numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import over_texts, text_groups

#: Fewest words and fewest periods of a run.
LEAST, PERIODS = 24, 3
_GRAM = LEAST // 3
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lyndon_groups(ranks: list[int]) -> tuple[list[int], list[int]]:
    """(length of the longest Lyndon word that starts there, group) for each
    place of a sequence of dense ranks; equal groups have equal Lyndon words.

    Groups stand in a list by the order of their words. The highest goes first:
    for each of its places the nearest earlier place of a lower group is found,
    and places that were found equally often by it leave their groups for new
    ones just above, longer by as many copies of its word.
    """
    n, m = len(ranks), max(ranks, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(m)]
    group = [-1, *ranks]  # places count from 1, 0 is before the text
    for i in range(1, n + 1):
        members[group[i]].append(i)
    size, below, above = [1] * m, list(range(-1, m - 1)), list(range(1, m + 1))
    near = list(range(n + 1))  # towards the nearest place to the left that is in no treated group
    g = m - 1
    while g >= 0:
        found: list[int] = []
        often: list[int] = []
        for i in members[g]:
            if group[i] != g:
                continue
            j = i - 1
            while near[j] != j:
                near[j] = near[near[j]]
                j = near[j]
            near[i] = j
            if j:
                if found and found[-1] == j:
                    often[-1] += 1
                else:
                    found.append(j)
                    often.append(1)
        for times in sorted(set(often), reverse=True):
            fresh: dict[int, int] = {}
            for j, k in zip(found, often):
                if k == times:
                    old = group[j]
                    new = fresh.get(old)
                    if new is None:
                        new = fresh[old] = len(size)
                        size.append(size[old] + times * size[g])
                        members.append([])
                        upper = above[old]
                        below.append(old)
                        above.append(upper)
                        above[old] = new
                        if upper < len(below) and below[upper] == old:
                            below[upper] = new
                    members[new].append(j)
                    group[j] = new
        g = below[g]
    return [size[g] for g in group[1:]], group[1:]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal leading elements."""
    n, done, step = min(len(a), len(b)), 0, 32
    while done < n:
        differ = np.flatnonzero(a[done : min(done + step, n)] != b[done : min(done + step, n)])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, step * 4
    return n


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbers, by start and period."""
    found = set()
    _, ranks = np.unique(words, return_inverse=True)
    n, backwards = len(words), words[::-1]
    for order in (ranks, ranks.max(initial=0) - ranks):
        length, group = (np.array(x, np.int64) for x in lyndon_groups(order.tolist()))
        place = np.arange(n)
        after, before = place + length, place - length
        again = after < n
        again[again] = group[after[again]] == group[again]
        follows = before >= 0
        follows[follows] = group[before[follows]] == group[follows]
        for i in np.flatnonzero(again & ~follows).tolist():
            p = int(length[i])
            if 3 * p > n:
                continue
            right = p + _common(words[i:], words[i + p :])
            left = _common(backwards[n - i :], backwards[n - i - p :])
            if left + right >= max(LEAST, PERIODS * p):
                found.add((i - left, left + right, p))
    return sorted(found)


def _stretches(words: np.ndarray, n_words: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, first, end) of the stretches of words that can hold a run."""
    if len(words) < LEAST:
        return []
    text = np.repeat(np.arange(len(n_words)), n_words)
    firsts = np.cumsum(n_words) - n_words
    n = len(words) - _GRAM + 1
    own = words.astype(np.uint64)
    with np.errstate(over="ignore"):
        key = text[:n].astype(np.uint64) * _MULTIPLIER
        for j in range(_GRAM):
            key = (key ^ own[j : j + n]) * _MULTIPLIER
            key ^= key >> np.uint64(29)
    inside = np.flatnonzero(text[:n] == text[_GRAM - 1 :])
    key = key[inside]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int64)
    edge[inside[again]] += 1
    edge[inside[again] + _GRAM] -= 1
    covered = np.cumsum(edge[:-1]) > 0
    opens = covered.copy()
    begins = np.zeros(len(words) + 1, bool)
    begins[firsts] = True
    opens[1:] &= ~covered[:-1] | begins[1 : len(words)]
    closes = covered.copy()
    closes[:-1] &= ~covered[1:] | begins[1 : len(words)]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = b - a >= LEAST
    return [(int(text[x]), int(x - firsts[text[x]]), int(y - firsts[text[x]])) for x, y in zip(a[long], b[long])]


def _treat(bodies: list[bytes]) -> tuple[list[int], list[list[tuple]], list[bytes]]:
    """Number of words, runs and kept words of each text."""
    texts = [b" ".join(body.split()) for body in bodies]
    n_words = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
    raw = b" ".join([t for t in texts if t]) + b" "
    runs: list[list[tuple]] = [[] for _ in texts]
    if n_words.sum():
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32) + 1
        offsets = np.append(0, ends).astype(np.int64)
        # A word and the space behind it, so that the slices lie on end.
        coded = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        words, firsts = coded.indices.to_numpy(), np.cumsum(n_words) - n_words
        for t, a, b in _stretches(words, n_words):
            runs[t] += [(a + s, n, p) for s, n, p in runs_of(words[firsts[t] + a : firsts[t] + b])]
    for t, found in enumerate(runs):
        if found:
            gone = np.zeros(n_words[t], bool)
            for start, length, period in found:
                gone[start + period : start + length] = True
            texts[t] = b" ".join([w for w, g in zip(texts[t].split(b" "), gone.tolist()) if not g])
    return n_words.tolist(), runs, texts


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs, kept.

    Words are what ASCII white space parts, unchanged and numbered from 0.
    ``runs`` holds (start, length, period) of every run by start, then period: a
    stretch with smallest period p, of 24 words and 3p words or more, that
    neither neighbour continues. ``kept`` joins by one space the words that no
    run contains beyond its first p words. A null or blank text has no words, no
    runs and keeps ''. Repeated rows and ids are rows of their own, no rows give
    none, and other columns aren't read. Texts are treated whole, each in one
    task.
    """

    def run(batch):
        names, bodies = batch.column(0), [b or b"" for b in batch.column(1).to_pylist()]
        for a, b in text_groups([len(x) for x in bodies]):
            n_words, runs, kept = _treat(bodies[a:b])
            rows = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
            arrays = [names.slice(a, b - a), pa.array(n_words, pa.int64()), pa.array(rows, pa.list_(_RUN)), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "kept"])

    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body")]
    return over_texts(docs, columns, run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept string")

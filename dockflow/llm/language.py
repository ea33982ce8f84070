"""Language identification by rank-order profiles of character n-grams.

A text's one- to three-letter n-grams, with word edges as a sign of their own,
are ranked by frequency. Its distance from a language is how far each of its
leading n-grams is out of place in that language's profile.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.llm.common import held_out, text_groups

LONGEST = 3
#: n-grams in a profile, of a language and of a text.
PROFILE = 400
#: Characters whose n-grams are made at once: each takes up to 200 bytes while they are.
STEP = 1 << 18
#: Distinct n-grams of a language that wait to be added up, and those of all languages that a task holds.
WAITING, HELD = 400_000, 1_000_000
_BITS = 21  # a code point
_SALTS = 64
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """The lower-case letter for each code point; 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if unicodedata.category(chr(c))[0] == "L":
            low = chr(c).lower()
            table[c] = ord(low[0])
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of the distinct n-grams, index into them of every n-gram, its text).

    Runs of other signs between letters count as one edge. No text's n-grams
    depend on its neighbours.
    """
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    points = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le"), "<u4")
    letter = _letters()[points]
    owner = np.repeat(np.arange(len(texts)), lengths)
    edge = letter == 0
    keep = np.ones(len(letter), bool)
    keep[1:] = ~(edge[1:] & edge[:-1] & (owner[1:] == owner[:-1]))
    letter, owner = letter[keep], owner[keep]
    # Few distinct letters: small numbers make small codes.
    alphabet, dense = np.unique(letter, return_inverse=True)
    base, dense = len(alphabet), dense.astype(np.int64)
    spelt = np.maximum(alphabet, 1).astype(np.uint64)  # an edge is 1, so that codes of different length differ
    codes, at, whose = [], [], []
    known = 0
    for n in range(1, LONGEST + 1):
        code = dense[: len(dense) - n + 1] if n <= len(dense) else dense[:0]
        for k in range(1, n):
            code = code * base + dense[k : len(dense) - n + 1 + k]
        whole = owner[: len(code)] == owner[n - 1 :][: len(code)]
        if n == 1:
            whole &= letter[: len(code)] != 0
        else:  # an edge may only begin or end an n-gram
            for k in range(1, n - 1):
                whole &= letter[k : k + len(code)] != 0
        code, mine = code[whole], owner[: len(whole)][whole]
        if base**n <= 4 * len(code) + 1024:
            seen = np.bincount(code, minlength=base**n) > 0
            distinct, place = np.flatnonzero(seen), (np.cumsum(seen) - 1)[code]
        else:
            distinct, place = np.unique(code, return_inverse=True)
        full = np.zeros(len(distinct), np.uint64)
        for k in range(n):
            full |= spelt[(distinct // base**k) % base] << np.uint64(_BITS * k)
        codes.append(full.astype(np.int64))
        at.append(place + known)
        whose.append(mine)
        known += len(distinct)
    return np.concatenate(codes), np.concatenate(at), np.concatenate(whose)


def pieces(text: str) -> Iterator[str]:
    """Pieces of about ``STEP`` characters that hold the text's n-grams: cut at a
    sign that is no letter, which ends one piece and begins the next."""
    start = 0
    while len(text) - start > STEP:
        end = start + STEP
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct codes and their counts over all parts."""
    distinct, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return distinct, np.bincount(back, weights=np.concatenate([n for _, n in parts]), minlength=len(distinct)).astype(np.int64)


def _counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its n-gram codes, ascending, and their counts."""
    codes, at, whose = grams(texts)
    order = np.argsort(codes, kind="stable")
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.arange(len(codes))
    codes, at = codes[order], rank[at]
    by_text = np.argsort(whose, kind="stable")
    at, bounds = at[by_text], np.searchsorted(whose[by_text], np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > len(codes) // 8:
            counts = np.bincount(at[a:b], minlength=len(codes))
            found = np.flatnonzero(counts)
            counts = counts[found]
        else:
            found, counts = np.unique(at[a:b], return_counts=True)
        yield codes[found], counts


def ranked(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its leading n-gram codes, most frequent first (ties by code), and their counts."""
    for a, b in text_groups([len(t) for t in texts], STEP):
        if len(texts[a]) > STEP:  # a group of its own
            counted = iter([_added([x for p in pieces(texts[a]) for x in _counts([p])])])
        else:
            counted = _counts(texts[a:b])
        for codes, counts in counted:
            lead = np.lexsort((codes, -counts))[:PROFILE]
            yield codes[lead], counts[lead]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1_000):
            yield batch.slice(start, 1_000)


def profiles(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Each language's leading n-grams over all documents that may be learnt from.

    Partitions add up their own counts first. The result has ``PROFILE`` codes a
    language, however many documents there are.
    """
    spark = docs.sparkSession
    learnt = docs.where(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull())

    def count(batches):
        total: dict[str, list[tuple]] = {}

        def flush():
            for name, parts in total.items():
                distinct, sums = _added(parts)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(distinct), pa.string()), pa.array(distinct), pa.array(sums)], names=["lang", "gram", "n"])

        for batch in _slices(batches):
            texts, names = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for name in sorted(set(names.tolist())):
                own = [p for i in np.flatnonzero(names == name) for p in pieces(texts[i])]
                for a, b in text_groups([len(t) for t in own], STEP):
                    codes, at, _ = grams(own[a:b])
                    parts = total.setdefault(name, [(codes[:0], codes[:0])])
                    parts.append((codes, np.bincount(at, minlength=len(codes)).astype(np.int64)))
                    if sum(len(c) for c, _ in parts[1:]) > max(WAITING, len(parts[0][0])):
                        parts[:] = [_added(parts)]
            if sum(len(c) for parts in total.values() for c, _ in parts) > HELD:
                total = {name: [_added(parts)] for name, parts in total.items()}
                if sum(len(parts[0][0]) for parts in total.values()) > HELD // 2:
                    yield from flush()
                    total = {}
        yield from flush()

    counted = learnt.select(F.col(text).alias("body"), F.col(lang).alias("name")).mapInArrow(count, "lang string, gram long, n long")
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = [F.col("n").desc(), F.col("gram")]
    # Leaders of salted shares first, so that no task ranks all of a language's n-grams.
    salted = summed.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(_SALTS)))
    salted = salted.withColumn("r", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*best))).where(F.col("r") <= PROFILE)
    lead = salted.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(*best))).where(F.col("r") <= PROFILE)
    found: dict[str, list] = {}
    for row in lead.select("lang", "gram", "r").orderBy("lang", "r").collect():
        found.setdefault(row.lang, []).append(row.gram)
    return {name: np.array(codes, np.int64) for name, codes in found.items()}


class Identifier:
    """Profiles laid out for comparing texts with all languages at once."""

    def __init__(self, learnt: dict[str, np.ndarray]):
        self.names = sorted(learnt)
        codes = [learnt[n] for n in self.names] or [np.zeros(0, np.int64)]
        self.codes = np.unique(np.concatenate(codes))
        # One more column for n-grams in no profile.
        self.places = np.full((len(self.names), len(self.codes) + 1), PROFILE, np.int64)
        for row, own in zip(self.places, codes):
            row[np.searchsorted(self.codes, own)] = np.arange(len(own))

    def predict(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        """(language, score): the score is 0 where the nearest profile holds none
        of the text's n-grams and 1 where each is in its place."""
        for codes, _ in ranked(texts):
            if not len(codes) or not self.names:
                yield UNKNOWN, 0.0
                continue
            at = np.searchsorted(self.codes, codes)
            known = at < len(self.codes)
            known[known] = self.codes[at[known]] == codes[known]
            at[~known] = len(self.codes)
            place = self.places[:, at]
            out = np.where(place < PROFILE, np.abs(place - np.arange(len(codes))), PROFILE).sum(axis=1)
            best = int(out.argmin())
            yield self.names[best], float(1 - out[best] / (PROFILE * len(codes)))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1).

    Learns from rows that are not held out and have a text and a language. The
    prediction reads the text alone; equally near languages go to the first
    name. A null text, or one without a letter, is ``und`` with score 0, and so
    is every text if there was nothing to learn from. One row per row.
    """
    learnt = profiles(docs, doc_id, text, lang)

    def run(batches):
        model = Identifier(learnt)
        for batch in _slices(batches):
            found = list(model.predict([t or "" for t in batch.column(1).to_pylist()]))
            columns = [batch.column(0), batch.column(2), pa.array([p[0] for p in found], pa.string()), pa.array([p[1] for p in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body"), held_out(doc_id).alias("held"))
    return chosen.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")

"""SimHash fingerprints and their near duplicates by pigeonhole blocks.

A fingerprint is cut into five blocks. Two that differ in at most two bits
agree in at least three blocks, so each is filed under its ten choices of three
blocks (about 38 bits), and only fingerprints under one key are compared.

Equal fingerprints are one before anything is joined. A key with many
fingerprints is not compared pair by pair: its members are filed anew with each
pair of the bits outside the key cleared. Two members within two bits agree
under one of these, and under one of them there are at most four, so links stay
in proportion and none is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import cut, over_texts, text_groups
from dockflow.llm.components import components
from dockflow.llm.xxh64 import hash_slices

SHINGLE, SEED, DISTANCE = 3, 42, 2
BLOCKS = [(0, 13), (13, 26), (26, 39), (39, 52), (52, 64)]
#: Members of a key up to which pairs are compared directly; beyond it, cleared bits.
DIRECT = 64
_SLICE = 1 << 18


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """SimHash of each text: words by ASCII white space, A-Z in lower case."""
    words = [t.lower().split() for t in texts]
    lengths = np.fromiter((len(w) for ws in words for w in ws), np.int64)
    n_words = np.array([len(w) for w in words], np.int64)
    data = b" ".join(b" ".join(w) for w in words if w)
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    first = np.cumsum(n_words) - n_words
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - SHINGLE + 1, 1))
    owner = np.repeat(np.arange(len(texts)), n_shingles)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + first[owner]
    last = np.minimum(at + SHINGLE, first[owner] + n_words[owner]) - 1
    ones = np.zeros((len(texts), 64), np.int64)
    for a in range(0, len(owner), _SLICE):
        b = min(a + _SLICE, len(owner))
        hashes = hash_slices(data, starts[at[a:b]], ends[last[a:b]], SEED)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own, begin = np.unique(owner[a:b], return_index=True)
        ones[own] += np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
    majority = (2 * ones > n_shingles[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").ravel()


def simhash(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """(doc_id, fp): the signed 64-bit form of each document's fingerprint; with
    ``row`` that column, too, as ``row_key``."""
    keys = [F.col(row).cast("long").alias("row_key")] if row else []

    def run(batch):
        ids, texts, *more = batch.columns
        raw = [b"" if t is None else t for t in texts.to_pylist()]
        prints = [fingerprints(raw[a:b]) for a, b in text_groups([len(t) for t in raw])]
        made = pa.array(np.concatenate(prints).astype(np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([ids, made, *more], names=["doc_id", "fp", "row_key"][: 2 + len(more)])

    columns = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body"), *keys]
    return over_texts(docs, columns, run, "doc_id long, fp long" + ", row_key long" * len(keys))


def _mask(blocks) -> int:
    bits = sum(((1 << b) - (1 << a)) for a, b in blocks)
    return bits - (1 << 64) if bits >> 63 else bits


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints in column ``fp``: enough of
    the pairs within two bits to connect all that are connected."""
    tables = list(combinations(range(len(BLOCKS)), len(BLOCKS) - DISTANCE))
    masks = [_mask([BLOCKS[i] for i in t]) for t in tables]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)]))
    filed = prints.select("fp", keys.alias("key")).select("fp", "key.t", "key.k")
    sizes = filed.groupBy("t", "k").agg(F.count("*").alias("n"), F.min("fp").alias("least")).where("n > 1")
    filed = cut(filed.join(sizes, ["t", "k"]).select("t", "k", "fp", "n"))

    few = filed.where(F.col("n") <= DIRECT).select("t", "k", "fp")
    pairs = few.alias("x").join(few.alias("y"), ["t", "k"]).where("x.fp < y.fp and bit_count(x.fp ^ y.fp) <= 2")
    direct = pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    free = []
    for t in tables:
        bits = [p for i, (a, b) in enumerate(BLOCKS) if i not in t for p in range(a, b)]
        free.append([_signed((1 << i) | (1 << j)) for i, j in combinations(bits, 2)])
    cleared = F.explode(F.element_at(F.array(*[F.array(*[F.lit(m) for m in f]) for f in free]), F.col("t") + 1))
    many = filed.where(F.col("n") > DIRECT).select("t", "fp", cleared.alias("bits"))
    many = many.select("t", "fp", "bits", F.col("fp").bitwiseAND(F.bitwise_not("bits")).alias("rest"))
    stars = many.groupBy("t", "bits", "rest").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    stars = stars.select("a", F.explode("all").alias("b")).where("a <> b")
    return direct.union(stars).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents link if their fingerprints differ in at most two bits; the
    component is the smallest id reachable. A null text has no words, and
    without words the fingerprint is zero and links like any other; fewer than
    three words are one shingle. Null ids take no part in the minimum. Repeated
    rows come out repeated, no rows give no rows, other columns aren't read.

    With ``row``, a column whose values are different in every row, also row_key
    and kept: true for one row of each component, that with the smallest id (a
    null id comes last) and then the smallest key.
    """
    marked = cut(simhash(docs, doc_id, text, row))
    first = [F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")] if row else []
    prints = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), *first))
    found = components(links(prints.select("fp")))
    labelled = prints.join(found, prints.fp == found.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"), *["first"] * len(first))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"), *([F.min("first").alias("keep")] if row else []))
    labels = cut(labelled.join(smallest, "component").select("fp", "component_id", *([F.col("keep.row_key").alias("keep_row")] if row else [])))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    kept = ["row_key", (F.col("row_key") == F.col("keep_row")).alias("kept")] if row else []
    return marked.join(labels, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id", *kept)

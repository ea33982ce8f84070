import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from texts import DOCS, documents, odd_texts

from dockflow.llm import golomb, simhash
from dockflow.llm.components import components
from dockflow.llm.exact_dedup import exact_duplicates
from dockflow.llm.xxh64 import hash_slices


RNG = random.Random(1)
MANY = sorted(RNG.getrandbits(64) for _ in range(500))


@pytest.mark.parametrize("values", [[], [0], [2**64 - 1], [5, 5, 5], [0, 1, 2**63, 2**64 - 1], MANY])
def test_golomb_round_trip(values):
    got = golomb.decode(golomb.encode(np.array(values, np.uint64)))
    assert got.tolist() == values


def test_golomb_is_small():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 100_000).astype(np.uint64))
    assert len(golomb.encode(values)) < len(values) * 6.2


def test_xxh64_of_every_length():
    data = random.Random(2).randbytes(700)
    starts = np.array([i % 300 for i in range(400)])
    ends = np.minimum(starts + np.arange(400), 700)
    want = [xxhash.xxh64_intdigest(data[a:b], seed=42) for a, b in zip(starts, ends)]
    assert hash_slices(data, starts, ends).tolist() == want


def exact_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return sorted((d, max(g), len(g), d == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g)


@pytest.mark.parametrize("parts", [1, 5])
def test_exact_duplicates(spark, parts):
    docs = documents(spark, odd_texts(), clashing=True, parts=parts).cache()
    got = exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got)) == exact_by_hand([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])


def test_exact_duplicates_of_nothing_and_of_repeated_rows(spark):
    assert exact_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(1, "x", None, None, 1)] * 3 + [(None, "x", None, None, 1), (None, None, None, None, None)]
    got = exact_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert sum(r.kept for r in got) == 2
    assert sorted(r.group_size for r in got) == [1, 4, 4, 4, 4]


def print_by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(prints):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_near_duplicates(spark):
    docs = documents(spark, odd_texts(), clashing=True)
    prints = {r[0]: print_by_hand(r[1]) for r in docs.select("doc_id", "text").collect()}
    labels = components_by_hand(prints)
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()))
    assert got == sorted((d, f"{p:016x}", labels[d]) for d, p in prints.items())
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("direct", [64, 2])
def test_links_keep_every_connection(spark, monkeypatch, direct):
    monkeypatch.setattr(simhash, "DIRECT", direct)
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(3)]
    prints = {0, (1 << 64) - 1}
    for b in base:
        for _ in range(120):
            x = b
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    found = components(simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long")))
    got = {r.node: r.component for r in found.collect()}
    want = components_by_hand({s: p for s, p in signed.items()})
    assert {s: got.get(s, s) for s in signed} == want


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{i: 1000 for i in range(1000, 1200)}}

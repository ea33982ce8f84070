import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import DOCS, documents, odd_texts

from dockflow.llm import periodic_runs as P


def runs_by_hand(w):
    """Stretches of equal words p apart, for every p; the smallest period of each."""
    n, found = len(w), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(24, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted((s, k, p) for (s, k), p in found.items())


def kept_by_hand(w, runs):
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def lyndon_by_hand(s):
    out = []
    for i in range(len(s)):
        longest = 1
        for j in range(i + 1, len(s) + 1):
            w = s[i:j]
            if all(w < w[k:] for k in range(1, len(w))):
                longest = j - i
        out.append(longest)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=22))
def test_groups_are_lyndon_words(values):
    _, ranks = np.unique(values, return_inverse=True)
    for s in (ranks.tolist(), (ranks.max() - ranks).tolist()):
        length, group = P.lyndon_groups(s)
        assert length == lyndon_by_hand(s)
        word = {}
        for i, (n, g) in enumerate(zip(length, group)):
            assert word.setdefault(g, s[i : i + n]) == s[i : i + n]


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_numbers(seed):
    rng = random.Random(seed)
    for _ in range(60):
        s = []
        while len(s) < rng.randint(1, 220):
            root = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(1, 14))]
            s += (root * rng.randint(1, 12))[: rng.randint(1, 60)]
        assert P.runs_of(np.array(s)) == runs_by_hand(s)


def periodic_texts(seed=4):
    rng = random.Random(seed)
    word = lambda: rng.choice(["la", "ho", "été", "中", "x" * 90, "b", "c", "d"])
    out = []
    for _ in range(40):
        w = [word() for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(1, 3)):
            root = [word() for _ in range(rng.randint(1, 20))]
            w += (root * 9)[: rng.randint(1, 90)] + [word() for _ in range(rng.randint(0, 9))]
        out.append(rng.choice([" ", "\n", " \t\x0b\x0c\r "]).join(w))
    return out


def test_documents(spark):
    texts = odd_texts() + periodic_texts() + ["la " * 50_000, "no break space " * 30]
    docs = documents(spark, texts, clashing=True)
    got = {r.doc_id: r for r in P.periodic_runs(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r, w = got[3 * i + 1], words(t)
        want = [(0, 50_000, 1)] if len(w) == 50_000 else runs_by_hand(w) if len(w) < 3000 else []
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(w) and r.kept == kept_by_hand(w, want)


def test_stretches_lose_no_run():
    """Many texts at once, over texts that begin and end with the same words."""
    texts = [t.encode() for t in periodic_texts(9)] + [b"a b c " * 9, b"a b c " * 9, b"", b"c a b " * 7]
    n_words, runs, kept = P._treat(texts)
    for t, n, own, left in zip(texts, n_words, runs, kept):
        w = words(t.decode())
        assert n == len(w) and own == runs_by_hand(w) and left.decode() == kept_by_hand(w, own)


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "a b " * 20, "en", "s", 1), (None, None, None, None, None), (5, "a b " * 20, "en", "s", 1), (5, "", "en", "s", 0)]
    got = P.periodic_runs(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.n_words, len(r.runs), r.kept) for r in got) == [(0, 0, 0, ""), (0, 40, 1, "a b"), (5, 0, 0, ""), (5, 40, 1, "a b")]
    assert P.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import DOCS, documents, odd_texts

from dockflow.llm import substring_dedup as S


def by_hand(rows):
    split = [(d, (t or "").encode().split()) for d, t in rows]
    seen = Counter(tuple(w[i : i + 35]) for _, w in split for i in range(len(w) - 34))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out)


def key_of(words, at):
    """The key under which the window at ``at`` is filed."""
    starts, border, key = S._filed_windows(np.array([len(words)]), words)
    b = border[at]
    return None if b < 0 else int(key[b])


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 6), st.integers(0, 10**6), st.integers(0, 40), st.integers(0, 40), st.integers(0, 40), st.integers(0, 40))
def test_equal_windows_are_filed_alike(letters, seed, a, b, c, d):
    rng = np.random.default_rng(seed)
    word = lambda n: S._mixed(rng.integers(0, letters, n).astype(np.uint64) * S._A + S._C)
    window = word(35)
    assert key_of(np.concatenate([word(a), window, word(b)]), a) == key_of(np.concatenate([word(c), window, word(d)]), c)


def test_most_windows_are_filed():
    words = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    starts, border, key = S._filed_windows(np.array([20_000]), words)
    assert (border >= 0).mean() > 0.99
    assert len(np.unique(border)) < 0.5 * len(words)


@pytest.mark.parametrize("parts", [1, 4])
def test_remove_repeats(spark, parts):
    docs = documents(spark, odd_texts(), clashing=True, parts=parts).cache()
    want = by_hand([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, S.remove_repeats(docs).collect())) == want


def test_small_alphabets(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 400))) for _ in range(30)]
    texts += ["x " * 200, "x y " * 100, "x y z " * 60, ("x " * 40 + "y ") * 5]
    docs = documents(spark, texts, parts=3).cache()
    want = by_hand([(r[0], r[1]) for r in docs.select("doc_id", "text").collect()])
    assert sorted(map(tuple, S.remove_repeats(docs).collect())) == want


def test_no_rows(spark):
    assert S.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0

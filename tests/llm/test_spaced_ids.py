import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dockflow.llm.spaced_ids import SpacedEncoder, cuts
from dockflow.llm.token_files import VOCABULARY
from dockflow.llm.word_ids import tokenizer

ALPHABET = list("ab Z.,'!?;:\n\t\r19_-") + ["\u00a0", "\u2003", "\u3000", "\u0085", "\u1680", "\u2028", "\u205f", "\u200b", "é", "É", "中", "ß", "\U0001f600", "\x1c", "\u0301", "'s", "'ll", " the", "word", "ing"]


def by_library(texts):
    library = tokenizer(VOCABULARY)
    return [library.encode(t, add_special_tokens=False).ids for t in texts]


def by_batch(encoder, texts):
    ids, counts = encoder.encode([t.encode() for t in texts])
    upto = np.cumsum(counts).tolist()
    return [ids[a:b].tolist() for a, b in zip([0, *upto], upto)]


def test_odd_texts_in_one_batch():
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 24))) for _ in range(6000)] + ["", " ", "\n", "a" * 3000, " b" * 900, "<|endoftext|>"]
    encoder = SpacedEncoder(VOCABULARY)
    for part in (texts[:10], texts, texts[::-1]):
        assert by_batch(encoder, part) == by_library(part)
    assert by_batch(encoder, []) == [] and by_batch(encoder, ["", ""]) == [[], []]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=20), max_size=6))
def test_any_texts(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert by_batch(SpacedEncoder(VOCABULARY), texts) == by_library(texts)


def test_cache_starts_anew(monkeypatch):
    import dockflow.llm.spaced_ids as S

    monkeypatch.setattr(S, "CACHED", 5)
    encoder = SpacedEncoder(VOCABULARY)
    texts = [f"w{i} x y{i}." for i in range(40)]
    for t in texts:
        assert by_batch(encoder, [t]) == by_library([t])
    assert encoder.count < 12


def test_cuts():
    text = "a b  c.d\ne é f\u2003 g"
    raw = np.frombuffer(text.encode(), np.uint8)
    found = [text.encode()[i:].decode()[:2] for i in np.flatnonzero(cuts(raw))]
    assert found == [" b", "  ", ".d", "\ne", "e ", " é", " f"]

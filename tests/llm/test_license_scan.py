import random
import re

import pytest
from texts import DOCS, documents, odd_texts

from dockflow.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(text, templates=L.TEMPLATES):
    w = words(text)
    width = max(len(words(t.text)) for t in templates)
    places, base, labels, score = [], set(), set(), 0.0
    for t in templates:
        own = words(t.text)
        if t.phrase:
            at = [i for i in range(len(w)) if w[i : i + len(own)] == own]
            places += at
            shares = [1.0] if at else []
            base |= {t.label} if at else set()
        else:
            shares = [len(set(w[b : b + 2 * width]) & set(own)) / len(set(own)) for b in range(0, len(w), width)]
            shares = [s for s in shares if s * 10 >= t.tenths - 1e-9]
        if shares:
            labels.add(t.label)
            score = max([score, *shares])
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def license_texts(seed=3):
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice(["ba", "ko", "the", "of", "License", "under", "version", "a"]) for _ in range(n))
    out = []
    for t in L.TEMPLATES:
        for share in (0.0, 0.1, 0.2, 0.35):
            kept = [w for w in t.text.split() if rng.random() >= share]
            for before in (0, rng.randint(1, 50), rng.randint(50, 300)):
                out.append(f"{say(before)} {' '.join(kept)}{rng.choice(['. ', chr(10), ' -- '])}{say(rng.randint(0, 80))}")
    out += ["Licensed under CC BY-NC 4.0. Under the MIT license; under THE mit licensé", "apache license version 2.0\n" * 50, "cc by\nnc", "cc by ncé", "under the mit licensed"]
    return out


def test_documents(spark):
    texts = odd_texts() + license_texts() + [" ".join(license_texts(8)) * 20]
    docs = documents(spark, texts, clashing=True).selectExpr("*", "1 AS row", "'x' AS labels", "2 AS n_words", "3 AS blocks")
    got = {r.doc_id: tuple(r)[1:] for r in L.scan_licenses(docs).collect()}
    assert got == {3 * i + 1: by_hand(t) for i, t in enumerate(texts)}
    assert {"gpl-3", "isc", "mpl-2", "bsd"} <= {x for r in got.values() for x in r[5].split(",")}


@pytest.mark.parametrize("tenths", [3, 5, 10])
def test_every_threshold(spark, tenths):
    """Low thresholds let frequent words into the prefixes; no pair is lost."""
    templates = [t if t.phrase else t._replace(tenths=tenths) for t in L.TEMPLATES]
    texts = license_texts(5)
    got = {r.doc_id: tuple(r)[1:] for r in L.scan_licenses(documents(spark, texts), templates).collect()}
    assert got == {3 * i + 1: by_hand(t, templates) for i, t in enumerate(texts)}


def test_null_and_repeated_ids_and_no_rows(spark):
    rows = [(None, "x cc by nc", "en", "s", 1), (None, None, None, None, None), (5, "cc by nc cc by nc", "en", "s", 1), (5, "", "en", "s", 0)]
    got = L.scan_licenses(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id or 0, r.n_base, r.first_word or 0, r.last_word or 0, r.base_labels) for r in got) == [(0, 0, 0, 0, ""), (0, 1, 1, 1, "cc-by-nc"), (5, 0, 0, 0, ""), (5, 2, 0, 3, "cc-by-nc")]
    assert L.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0

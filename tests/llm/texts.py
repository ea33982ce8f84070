"""Small document tables with every odd case, and plain-Python helpers."""

import random
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with those that operators make for themselves.
CLASHING = ["part", "fp", "k", "t", "n", "sha", "body", "row_no", "length", "component_id", "held_out", "score", "start", "sequence_id"]


def odd_texts(seed=7):
    """Plain, empty, null, repeated, punctuated and very long texts."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, long = say(60), say(20_000)
    texts = [None, "", " ", "\n\t ", "a", "a b", "a  b", "A B", "x" * 5000, "la " * 300, "ha ho " * 90, long, long + " end"]
    texts += [say(rng.randint(1, 80)) for _ in range(40)]
    texts += [say(5) + " " + shared + " " + say(5) for _ in range(4)] + [shared, shared, say(30) * 2]
    texts += ["don't  we'll\n\n I'VE 12345 x1y2 ... ''s 's't 're'", "été 中文 \U0001f600\U0001f600 абв  x\r\n", "tail  "]
    return texts + texts[:6] + [texts[20]] * 30


def documents(spark, texts, langs=None, clashing=False, parts=3):
    langs = langs or ["en"] * len(texts)
    rows = [(i * 3 + 1, t, lang, "src", None if t is None else len(t)) for i, (t, lang) in enumerate(zip(texts, langs))]
    docs = spark.createDataFrame(rows, DOCS).repartition(parts, "doc_id") if parts > 1 else spark.createDataFrame(rows, DOCS)
    if clashing:
        from pyspark.sql import functions as F

        docs = docs.withColumns({c: F.lit(None).cast("string") for c in CLASHING})
    return docs


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1

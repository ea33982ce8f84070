import os
import random
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
from texts import DOCS, documents, is_held_out, odd_texts

from dockflow.llm import language, toxicity

SYLLABLES = {"en": "the ing er on an re at en nd".split(), "de": "ein sch ung keit der ver zu ich".split(), "fr": "eau oi eux ai ch que le re".split()}


def _say(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_language(spark):
    rng = random.Random(1)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(240)]
    texts = [_say(rng, lang, rng.randint(20, 60)) for lang in langs] + [None, "", "123 !?", "x" * 40_000, texts0 := "the then", texts0]
    docs = documents(spark, texts, langs + [None] * 6, clashing=True)
    truth = {i * 3 + 1: lang for i, lang in enumerate(langs)}
    got = {r.doc_id: r for r in language.identify(docs).collect()}
    assert len(got) == len(texts)
    held = [d for d in truth if is_held_out(d)]
    assert all(got[d].held_out == is_held_out(d) for d in got)
    assert np.mean([got[d].lang_pred == truth[d] for d in held]) > 0.97
    assert [got[(240 + i) * 3 + 1].lang_pred for i in range(3)] == ["und"] * 3
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language.identify(spark.createDataFrame([], DOCS)).count() == 0


def test_profiles_count_every_learnable_text(spark):
    texts = [t for t in odd_texts() if t]
    docs = documents(spark, texts)
    learnt = [t for i, t in enumerate(texts) if not is_held_out(i * 3 + 1)]
    counts = {}
    for t in learnt:
        codes, at, _ = language.grams([t])
        for c, n in zip(codes.tolist(), np.bincount(at, minlength=len(codes)).tolist()):
            counts[c] = counts.get(c, 0) + n
    want = sorted(counts, key=lambda c: (-counts[c], c))[: language.PROFILE]
    assert language.profiles(docs)["en"].tolist() == want


def test_toxicity(spark):
    rng = random.Random(2)
    rude = "idiot moron scum loser".split()
    texts, toxic = [], []
    for i in range(400):
        words = _say(rng, "en", 60).split()
        toxic.append(i % 5 == 0)
        if toxic[-1]:
            for _ in range(6):
                words[rng.randrange(60)] = rng.choice(rude)
        texts.append(" ".join(words))
    docs = documents(spark, texts + [None, "", "..."], clashing=True)
    labels = spark.createDataFrame([(i * 3 + 1, 1, int(t)) for i, t in enumerate(toxic)] + [(None, 1, 1), (1, None, None), (10**6, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert len(got) == len(texts) + 3
    held = [i for i in range(400) if is_held_out(i * 3 + 1)]
    assert np.mean([got[i * 3 + 1].predicted == int(toxic[i]) for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    none = labels.limit(0)
    assert toxicity.score(docs, none).where("predicted = 1").count() == 0
    assert toxicity.score(spark.createDataFrame([], DOCS), labels).count() == 0


def test_toxicity_keeps_every_word_and_pair(spark):
    """Single pairs and a vocabulary beyond any fixed table, against plain Python."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    some = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(400)]
    texts = [" ".join(rng.choice(some) for _ in range(40)) for _ in range(60)]
    docs = documents(spark, texts).selectExpr("doc_id AS name", "doc_id % 2 = 1 AS toxic", "text AS body")
    known = docs.selectExpr("name", "toxic", "40L AS n_words", "body AS words").rdd.map(lambda r: (r[0], r[1], r[2], toxicity._joined(r[3].split(" "))))
    known = spark.createDataFrame(known, "name long, toxic boolean, n_words long, words binary")
    shares, bits, _, whole = toxicity.models(known, 7)
    words, pairs, heads, kinds, contexts = ({}, {}), ({}, {}), ({}, {}), ({}, {}), {}
    for i, t in enumerate(texts):
        c, w = (0 if (i * 3 + 1) % 2 else 1), t.split(" ")
        for x in w:
            words[c][x] = words[c].get(x, 0) + 1
        for p in zip(w, w[1:]):
            heads[c][p[0]] = heads[c].get(p[0], 0) + 1
            kinds[c].setdefault(p[0], set()).add(p)
            contexts.setdefault(p[1], set()).add(p)
            pairs[c][p] = pairs[c].get(p, 0) + 1
    assert sum(n == 1 for p in pairs for n in p.values()) > 1000
    vocab, shared = {*words[0], *words[1]}, 0.5 + sum(len(contexts.get(x, ())) + 0.5 for x in {*words[0], *words[1]})
    assert len(vocab) == int(round((whole.shared - sum(map(len, contexts.values()))) * 2)) - 1

    def discount(c):
        n = list(pairs[c].values())
        return min(0.95, max(0.1, n.count(1) / (n.count(1) + 2 * n.count(2))))

    spare = min(sum(min(k, 1 + discount(c)) for k in words[c].values()) / sum(words[c].values()) for c in (0, 1))

    def chance(c, word, before=None):
        k, d = words[c].get(word, 0), discount(c)
        p = (k - min(k, 1 + d)) / sum(words[c].values()) + spare * (len(contexts.get(word, ())) + 0.5) / shared
        if before is None:
            return p
        lean = toxicity.CONCENTRATION + d * len(kinds[c].get(before, ()))
        return (max(pairs[c].get((before, word), 0) - d, 0) + lean * p) / (toxicity.CONCENTRATION + heads[c].get(before, 0))

    asked = texts[:5] + ["unseen words here", f"{some[0]} unseen {some[1]} {some[2]}", "", None]
    rows = documents(spark, asked).selectExpr("doc_id AS name", "true AS held", "text AS body")
    got = {r.name: r for r in toxicity._features(rows, shares, bits, whole, 7, "held", toxicity._words).collect()}
    assert len(got) == len(asked)
    for i, t in enumerate(asked):
        w = (t or "").split()
        want = np.mean([np.log(chance(0, x, b) / chance(1, x, b)) for x, b in zip(w, [None, *w])]) if w else 0
        assert abs(got[i * 3 + 1].f0 - want) < 1e-9


def test_language_takes_bounded_memory():
    """Many texts at once, and one long text, don't take many times their size."""
    rng = random.Random(5)
    texts = [_say(rng, "en", 400) for _ in range(800)]
    model = language.Identifier({"en": np.arange(400, dtype=np.int64)})
    language.grams(["a"])  # the table of letters stays
    for held in (texts, ["\n".join(texts)]):
        assert sum(map(len, held)) > 1_400_000
        tracemalloc.start()
        list(model.predict(held))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 80 << 20


def test_ngrams_do_not_depend_on_neighbours(monkeypatch):
    texts = [t or "" for t in odd_texts()] + [" leading", "(x", "été été", "中文。中文"]
    alone = [next(language.ranked([t])) for t in texts]
    for step in (None, 50):
        if step:
            monkeypatch.setattr(language, "STEP", step)
        for some, want in ((texts, alone), (texts[1:], alone[1:]), (texts[::-1], alone[::-1])):
            got = list(language.ranked(some))
            assert all(a.tolist() == c.tolist() and b.tolist() == d.tolist() for (a, b), (c, d) in zip(got, want, strict=True))


def test_toxicity_ratios_take_bounded_memory():
    """What a chunk's words and pairs need is few columns of them."""
    rng = np.random.default_rng(6)
    chunk = toxicity.Chunk()
    for _ in range(500):
        chunk.add([f"w{i}" for i in rng.integers(0, 3_000, 1_000).tolist()])
    model = toxicity.Model(0, np.array([5, 2] * 4), np.array([3_000, 9e5, 9e5] + [5e5, 10, 2_990] * 4))
    tracemalloc.start()
    chunk.close()
    figures, pairs = np.ones((7, len(chunk.vocab)), np.int64), np.ones((2, len(chunk.keys)), np.int64)
    ratio = model.ratios(chunk.words, chunk.begins, figures, chunk.back, pairs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ratio) == 500_000 and not ratio.any()
    assert peak < 36 << 20


def test_written_tables_leave_no_shuffle_files(spark):
    def files():
        folders = [b.getAbsolutePath() for b in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
        return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before = files()
    table = spark.range(1_000).selectExpr("id % 7 AS k").groupBy("k").count()
    path = toxicity._written(table, "counted")
    assert not files() - before
    assert spark.read.parquet(path).count() == 7 and table.count() == 7


def test_toxicity_word_arrays_are_the_words():
    texts = odd_texts() + ["\u0130x \u039f\u0394\u039f\u03a3 \u00df1_\u00e9 \u0660a\u0661", "\U0001d4d0\u4e2d a\u0301b \u00b2\u2167x", "_", "0", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)]))]
    for text in texts:
        assert toxicity._word_array(text).to_pylist() == toxicity._words(text)


def test_toxicity_keys_of_two_codes_are_distinct():
    codes = np.concatenate([np.arange(1 << 16), np.random.default_rng(1).integers(0, 1 << 32, 100_000)])
    assert (toxicity._unmixed(toxicity._mixed(codes)) == codes).all()
    common = toxicity.Common([f"w{i}" for i in range(50)])
    names = toxicity._named([f"w{i}" for i in range(100)])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(100), np.arange(100)))
    own = common.codes_of(names)
    assert (own >= 0).sum() == 50
    keys = toxicity._pair_keys(names[a], names[b], own[a], own[b])
    assert len(set(keys.tolist())) == 10_000 and (toxicity._short(keys) == ((a < 50) & (b < 50))).all()
    keys.sort()
    assert (toxicity._opened_keys(toxicity._packed_keys(keys)) == keys).all()


def _counted(spark, known, owners=3):
    known = known.rdd.map(lambda r: (r[0], r[1], len(r[2].split(" ")), toxicity._joined(r[2].split(" "))))
    return toxicity.models(spark.createDataFrame(known, "name long, toxic boolean, n_words long, words binary"), owners)


def test_toxicity_questions_are_small(spark):
    """A known pair of common words takes less than the 5 bytes and more that its 63-bit name took."""
    rng = random.Random(8)
    texts = [" ".join(f"{'abcdefgh'[rng.randrange(8)]}{'abcdefgh'[rng.randrange(8)]}{'xyz'[rng.randrange(3)]}" for _ in range(1_000)) for _ in range(30)]
    docs = documents(spark, texts).selectExpr("doc_id AS name", "doc_id % 2 = 1 AS toxic", "text AS body")
    _, guide, _, _ = _counted(spark, docs)
    asked = toxicity._asks(docs.coalesce(1), 3, guide, toxicity._words).select("keys").toPandas()["keys"].dropna()
    pairs = {p for t in texts for p in zip(t.split(), t.split()[1:])}
    assert sum(map(len, asked)) < 3.5 * len(pairs)


def test_toxicity_does_not_depend_on_codes_or_rounds(spark, monkeypatch):
    rng = random.Random(9)
    some = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    docs = documents(spark, [" ".join(rng.choice(some) for _ in range(50)) for _ in range(40)])
    docs = docs.selectExpr("doc_id AS name", "doc_id % 2 = 1 AS toxic", "text AS body")
    got = []
    for words, rounds in ((some, 2), ([], 1), (some[:90], 5)):
        monkeypatch.setattr(toxicity, "_common", lambda known, words=words: toxicity.Common(sorted(set(words))))
        monkeypatch.setattr(toxicity, "ROUNDS", rounds)
        shares, guide, half, whole = _counted(spark, docs)
        for m in (half, whole):
            got.append(sorted(map(tuple, toxicity._features(docs, shares, guide, m, 3, "toxic", toxicity._word_array).collect())))
    assert got[:2] == got[2:4] == got[4:] and len(got[0]) == 40 and got[0] != got[1]


def test_toxicity_idle_workers_are_small():
    """A core has several workers that wait: after a chunk they hold neither its memory nor pandas."""
    code = """
import os, pickle, sys
import numpy as np
from dockflow.llm import toxicity

def held():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20

def use(n):
    guide = pickle.loads(sent)
    chunk, rng = toxicity.Chunk(), np.random.default_rng(6)
    for _ in range(n):
        words = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}x{'uvwxyz'[i // 100 % 6]}" * (1 + i // 600) for i in rng.integers(0, 6_000, 1_000).tolist()]
        chunk.add(toxicity._word_array(" ".join(words)))
    chunk.close(guide.common)
    figures, pairs = np.ones((7, len(chunk.vocab)), np.int64), np.ones((2, len(chunk.keys)), np.int64)
    model.ratios(chunk.words, chunk.begins, figures, chunk.back, pairs)

common = toxicity.Common.__new__(toxicity.Common)
common.words, common.names = toxicity._word_array("akxu blxu"), np.arange(2)
sent = pickle.dumps(toxicity.Guide(np.ones(1 << toxicity.SIEVE >> 3, np.uint8), common, np.ones((14, 65_536), np.uint32)))
model = toxicity.Model(0, np.array([5, 2] * 4), np.array([3_000, 9e5, 9e5] + [5e5, 10, 2_990] * 4))
use(2)
toxicity._give_back()
before = held()
for _ in range(3):
    use(300)
    toxicity._give_back()
print(held() - before, "pandas" in sys.modules)
"""
    root = os.path.dirname(os.path.dirname(toxicity.__file__))
    run = subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": os.path.dirname(root)}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    more, pandas = run.stdout.split()
    assert int(more) < 8 and pandas == "False"


def test_toxicity_arrays_of_packed_words():
    for words in ([], ["a"], ["a", "\u00e9\u4e2d", "b", "a"], ["x" * 70_000, "y"]):
        assert toxicity._split_array(toxicity._joined(words)).to_pylist() == words == toxicity._split(toxicity._joined(words))
    assert toxicity._split_array(None).to_pylist() == []
    array = pa.array([None, 3, None, 5, 0, None, 7, 8, 9, None, 1], pa.int32())
    for start in range(12):
        assert toxicity._indices(array[start:]).tolist() == [-1 if x is None else x for x in array[start:].to_pylist()]
    assert toxicity._indices(array[1:2]).tolist() == [3] and toxicity._indices(pa.array([4, 2], pa.int32())).tolist() == [4, 2]

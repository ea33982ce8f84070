import random
from collections import defaultdict

from test_duplicates import components_by_hand, print_by_hand
from texts import documents, odd_texts

import corpus_pipeline
from dockflow.llm import packing, surrogates, word_ids


def test_pipeline(spark, tmp_path):
    texts = odd_texts() + ["12 34 !", "mail to some.one@mail.example.com about the usual thing"] * 2
    docs = documents(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    # The one text of mixed scripts is near no learnt language.
    left = {d: t for d, t in rows.items() if t and any(c.isalpha() for c in t) and "中文" not in t}
    groups = defaultdict(list)
    for d, t in left.items():
        groups[t].append(d)
    left = {max(ds): t for t, ds in groups.items()}
    labels = components_by_hand({d: print_by_hand(t) for d, t in left.items()})
    left = {d: surrogates.replaced(t, surrogates.KEY, {}, 4)[0] for d, t in left.items() if labels[d] == d}
    tokens = word_ids.tokenizer(packing.VOCABULARY)
    want = {d: len(tokens.encode(t, add_special_tokens=False).ids) + 1 for d, t in left.items()}
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert got == want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "pii_surrogates", "best_fit_packing"]


def test_rows_with_null_or_shared_ids_stay(spark, tmp_path):
    """Only rows with equal or near texts go, whatever their ids."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30)) for _ in range(12)]
    ids = [None] * 5 + [7] * 4 + [1, 2, 3]
    rows = [*zip(ids, texts), (None, texts[0]), (None, texts[11]), (7, texts[5]), (7, texts[9])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/rows")
    docs = spark.read.parquet(f"{tmp_path}/rows")
    exact = corpus_pipeline._distinct(spark, docs, "")
    want = sorted([(-1 if d is None else d, t) for d, t in zip(ids, texts) if t != texts[9]] + [(7, texts[9])])
    assert exact.columns == docs.columns and sorted((-1 if r[0] is None else r[0], r[1]) for r in exact.collect()) == want
    near = corpus_pipeline._far_apart(spark, docs, "")
    labels = components_by_hand({i: print_by_hand(t) for i, t in enumerate(texts)})
    assert len(set(labels.values())) == len(texts)
    assert near.columns == docs.columns and sorted((-1 if r[0] is None else r[0], r[1]) for r in near.collect()) == sorted((-1 if d is None else d, t) for d, t in zip(ids, texts))

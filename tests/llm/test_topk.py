import numpy as np
import pytest

from dockflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, every=5, k=5):
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    whole = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in fine]
    out = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        own = [v for i, v in whole if i == q][0]
        scored = sorted({(-int(np.dot(np.pad(v, (0, 99 - len(v))), np.pad(own, (0, 99 - len(own))))), i) for i, v in whole if i != q})[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


def odd_rows(n, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 0.2, 8).astype(np.float32).tolist()) for i in range(n)]
    same = rng.normal(0, 0.2, 8).astype(np.float32).tolist()
    rows += [(n + i, same) for i in range(n // 3)]
    rows += [(5000, None), (5005, [1.0, None]), (5010, [float("nan")] * 8), (5015, [float("inf")] * 8), (5020, [0.5] * 3), (5025, []), (None, same)]
    return rows + [(7, rows[7][1])]


@pytest.mark.parametrize("n, shard, leaf", [(300, 60, 8), (40, 8192, 128), (3, 2, 1)])
def test_top_k(spark, monkeypatch, n, shard, leaf):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    rows = odd_rows(n)
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = topk.top_k(table, every=5).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == by_hand(rows)


def test_top_k_of_nothing(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_trees_prune():
    rng = np.random.default_rng(2)
    centres = rng.integers(-500, 500, (8, 6))
    vectors = centres[rng.integers(0, 8, 4000)] + rng.integers(-5, 5, (4000, 6))
    tree = topk._open(topk.build(np.arange(4000), vectors))
    found = topk.search(tree, np.array([10_000]), vectors[:1], np.array([-np.inf]), 5)
    want = sorted((-(vectors @ vectors[0])).tolist())[:5]
    assert sorted(-s for _, _, s in found) == want

import hashlib

import numpy as np
import pytest

from dockflow.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, label int"


def by_hand(rows, k, rounds, dims):
    kept = [(i, np.floor(1024 * np.array(v, np.float32).astype(float)).astype(int).tolist()) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=key)[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min(range(len(centres)), key=lambda c: (far(v, centres[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v), []).append(v)
        for c, vs in groups.items():
            centres[c] = [sum(x) // len(vs) for x in zip(*vs)]
    out = [(i, nearest(v), far(v, centres[nearest(v)])) for i, v in kept]
    name = lambda c: hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()
    whole = sum(d for _, _, d in out)
    return sorted(((i is None, i or 0), c, d, sum(e for _, b, e in out if b == c), whole, name(c)) for i, c, d in out)


def odd_rows(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 0.3, dims).astype(np.float32).tolist()) for i in range(n)]
    same = rng.normal(0, 0.3, dims).astype(np.float32).tolist()
    rows += [(n + i, same) for i in range(n // 3)]
    rows += [(9000, None), (9001, [None] * dims), (9002, [float("nan")] * dims), (9003, [float("-inf")] * dims), (9004, [0.5] * (dims + 1)), (9005, [])]
    return rows + [(None, same), (None, rows[0][1]), (7 % n, rows[0][1])] + rows[:2]


@pytest.mark.parametrize("n, k, rounds, dims", [(120, 8, 10, 5), (40, 4, 7, 64), (3, 8, 10, 4)])
def test_clusters(spark, n, k, rounds, dims):
    rows = odd_rows(n, dims)
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    table = table.withColumnRenamed("label", "cluster").selectExpr("*", "'x' AS distance", "1 AS v", "2 AS dots")
    got = C.cluster_vectors(table, k=k, rounds=rounds, dimensions=dims).collect()
    assert sorted(((r[0] is None, r[0] or 0), *r[1:]) for r in got) == by_hand(rows, k, rounds, dims)


def test_empty_clusters_keep_their_centroid(spark):
    """Two first centroids are equal, so the second stays empty."""
    rows = [(i, [0.5, 0.25]) for i in range(4)] + [(i, [float(i), -1.0]) for i in range(4, 9)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = C.cluster_vectors(table, k=9, rounds=3, dimensions=2).collect()
    assert sorted(((False, r[0]), *r[1:]) for r in got) == by_hand(rows, 9, 3, 2)


def test_no_vectors_and_large_components(spark):
    none = C.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="would not fit a long"):
        C.cluster_vectors(spark.createDataFrame([(1, [1e9], 0)], SCHEMA), dimensions=1).count()


def test_products_follow_changes():
    """Products after changes equal those made anew, and untouched centroids cost nothing."""
    rng = np.random.default_rng(3)
    v, before = rng.integers(-99, 99, (50, 6)), rng.integers(-99, 99, (4, 6))
    after = before.copy()
    after[1, 2] += 7
    after[3] -= rng.integers(0, 2, 6)
    import pyarrow as pa

    (start,) = C._begin(before)([pa.RecordBatch.from_arrays([pa.array(range(50)), C._rows(v, pa.int64())], names=["vec_id", "v"])])
    (moved,) = C._moved(after, after - before)([start])
    assert (C._matrix(moved.column(2), 4) == v @ after.T).all()
    assert moved.column(5).to_pylist() == ((v[:, None] - after) ** 2).sum(axis=2).argmin(axis=1).tolist()

"""Centroid clustering of integer vectors over an incremental distance matrix.

Each vector keeps its exact integer inner product with every centroid. When a
centroid moves, only its components that changed are multiplied in; the nearest
centroid then follows from |v|^2 - 2 v.c + |c|^2 in integers. Sums of clusters
are kept too: a round adds and takes away only the vectors that changed their
cluster, summed by task before they travel.

A round is one job: the state (components, products, cluster) is made from the
one before by a narrow step and kept, and at most ``k`` rows of sums come to the
driver. A lost task redoes narrow steps only; every ``WRITTEN`` rounds the state
is written to the shared folder, so that these stay few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.session import scratch_path

K, ROUNDS, DIMENSIONS, SCALE = 8, 10, 64, 1024
#: Rounds between two written states.
WRITTEN = 5
#: Components must stay below: 64 squared differences then fit a long.
BOUND = 1 << 26
_KEPT = "v array<int>, dots array<long>, norm long, before int, cluster int, distance long"


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _rows(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), kind))


def _state(names: pa.Array, v: np.ndarray, dots: np.ndarray, norm: np.ndarray, before: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    """Rows with their nearest centroid; of equally near ones the smaller number."""
    far = (centroids * centroids).sum(axis=1) - 2 * dots
    cluster = far.argmin(axis=1)
    distance = norm + far[np.arange(len(far)), cluster]
    arrays = [names, _rows(v, pa.int32()), _rows(dots, pa.int64()), pa.array(norm), pa.array(before.astype(np.int32)), pa.array(cluster.astype(np.int32)), pa.array(distance)]
    return pa.RecordBatch.from_arrays(arrays, names=["vec_id", "v", "dots", "norm", "before", "cluster", "distance"])


def _begin(centroids: np.ndarray) -> Callable:
    """Products with the first centroids, in full."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column(1), centroids.shape[1])
                if v.size and np.abs(v).max() >= BOUND:
                    raise ValueError(f"components of {BOUND} and more: squared distances would not fit a long")
                yield _state(batch.column(0), v, v @ centroids.T, (v * v).sum(axis=1), np.full(len(v), -1), centroids)

    return run


def _moved(centroids: np.ndarray, change: np.ndarray) -> Callable:
    """Products brought up to date by the components that changed."""
    moved = [(k, np.flatnonzero(change[k])) for k in range(len(change)) if change[k].any()]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v, dots = _matrix(batch.column(1), centroids.shape[1]), _matrix(batch.column(2), len(centroids))
                for k, at in moved:
                    dots[:, k] += v[:, at] @ change[k, at]
                yield _state(batch.column(0), v, dots, batch.column(3).to_numpy(), batch.column(5).to_numpy(), centroids)

    return run


def _sums_moved(k: int, width: int) -> Callable:
    """What a task's vectors add to the sums of clusters; the last component counts them."""

    def run(batches):
        total = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                v = np.column_stack([_matrix(batch.column(0), width), np.ones(batch.num_rows, np.int64)])
                before, after = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                for c in range(k):
                    total[c] += v[after == c].sum(axis=0) - v[before == c].sum(axis=0)
        touched = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(touched.astype(np.int32)), _rows(total[touched], pa.int64())], names=["cluster", "sums"])

    return run


def _changes(state: DataFrame, k: int, width: int) -> np.ndarray:
    """(k, width + 1) exact integers by which sums and counts of clusters change; this also makes the state."""
    moved = state.where("cluster <> before").select("v", "before", "cluster").mapInArrow(_sums_moved(k, width), "cluster int, sums array<long>")
    total = moved.select("cluster", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))
    change = np.full((k, width + 1), 0, object)
    for row in total.collect():  # k * (width + 1) at most
        change[row["cluster"], row["at"]] = int(row["x"])
    return change


def cluster_vectors(
    table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = 3
) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A component x becomes floor(scale * x), x as double. The ``k`` vectors with
    the smallest sha256 of ``seed:vec_id`` are the first centroids, in that order;
    ties (one id several times, null ids, which count as '') go by components.
    Vectors that are null, have another length, or a null or non-finite component
    take no part and have no row. Repeated rows are vectors of their own. Fewer
    than ``k`` vectors make fewer clusters, none an empty table. An empty cluster
    keeps its centroid. Components of 2^26 and more are refused, as distances
    would not fit a long. Other columns aren't read.
    """
    spark = table.sparkSession
    x = F.col("x")
    fine = (F.size(x) == dimensions) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    given = table.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("x")).where(F.coalesce(fine, F.lit(False)))
    base = given.select("vec_id", F.transform(x, lambda c: F.floor(c * float(scale))).alias("v"))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = base.orderBy(order, "v").limit(k).collect()
    id_type = base.schema["vec_id"].dataType.simpleString()
    result = f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], result)
    k = len(first)
    centroids = np.array([row["v"] for row in first], np.int64).reshape(k, dimensions)
    kept = f"vec_id {id_type}, {_KEPT}"
    state = base.mapInArrow(_begin(centroids), kept).persist()
    last, total = None, np.full((k, dimensions + 1), 0, object)
    for done in range(1, rounds + 1):
        total = total + _changes(state, k, dimensions)
        if last is not None:
            last.unpersist()
        new = centroids.copy()
        for c in np.flatnonzero(total[:, -1] > 0):
            new[c] = [int(s // total[c, -1]) for s in total[c, :-1]]
        change = new - centroids
        if not change.any():
            break  # the vectors stay where they are in all rounds to come
        centroids = new
        last, state = state, state.mapInArrow(_moved(centroids, change), kept)
        if done % WRITTEN == 0:
            path = scratch_path(spark, "clusters")
            state.write.parquet(path)
            state = spark.read.parquet(path)
        else:
            state.persist()
    path = scratch_path(spark, "clustered")
    state.select("vec_id", "cluster", "distance").write.parquet(path)
    for table in (last, state):
        if table is not None:
            table.unpersist()
    found = spark.read.parquet(path)
    spent = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # k rows at most
    by_cluster = {row["cluster"]: int(row["d"]) for row in spent}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    about = spark.createDataFrame([(c, d, sum(by_cluster.values()), names[c]) for c, d in by_cluster.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

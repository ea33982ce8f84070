"""Exact top-k inner products by a KD-tree in every shard.

Rows are dealt to shards by a hash of their id. A shard's tree splits at the
median of the widest component and keeps each node's tight box. A block of
queries visits a tree best-first: the most a node can score is the inner
product with its box's best corner, and a node is opened only while that may
still reach a query's kth score. Blocks first visit one shard; the kth scores
found there go along to all others, where few nodes are opened and few rows
come back.

Trees and query blocks are packed rows of bounded size that meet by shard
number, so neither side is ever held whole.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.llm.common import cut

SHARD_ROWS, LEAF_ROWS, BLOCK_QUERIES = 8192, 128, 256
K = 5


def _packed(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _open(data: bytes):
    return np.load(io.BytesIO(bytes(data)), allow_pickle=False)


def build(ids: np.ndarray, vectors: np.ndarray) -> bytes:
    """A tree: rows in leaf order, and for each node its box, children and rows."""
    order, nodes, boxes = np.arange(len(ids)), [], []
    stack = [(0, len(ids), -1, 0)]
    while stack:
        a, b, parent, side = stack.pop()
        own = vectors[order[a:b]]
        low, high = own.min(axis=0), own.max(axis=0)
        here = len(nodes)
        nodes.append([a, b, -1, -1])
        boxes.append((low, high))
        if parent >= 0:
            nodes[parent][2 + side] = here
        wide = high - low
        if b - a > LEAF_ROWS and len(wide) and wide.max() > 0:
            axis = int(wide.argmax())
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, axis], mid)]
            stack += [(a, a + mid, here, 0), (a + mid, b, here, 1)]
    low, high = (np.array([x[i] for x in boxes]) for i in (0, 1))
    return _packed(ids=ids[order], vectors=vectors[order], nodes=np.array(nodes), low=low, high=high)


def search(tree, ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query id, row id, score) of every row that can be among a query's k best.

    ``kth`` is a score that k other rows are known to reach, or the lowest one.
    """
    rows, vectors, nodes = tree["ids"], tree["vectors"], tree["nodes"]
    dims = max(vectors.shape[1], queries.shape[1])
    vectors, queries, low, high = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (vectors, queries, tree["low"], tree["high"]))
    # Exact: a score above 2**53 goes through integers.
    big = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dims >= 2.0**53
    kind = np.int64 if big else np.float64
    vectors, queries, low, high = (x.astype(kind) for x in (vectors, queries, low, high))
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    out = []
    for q, name in enumerate(ids.tolist()):
        bound, floor, best = bounds[q], kth[q], []  # best: (score, -row id), the worst first
        heap = [(-bound[0], 0)]
        while heap:
            reach, node = heapq.heappop(heap)
            limit = max(floor, best[0][0]) if len(best) == k else floor
            if -reach < limit:
                break
            a, b, left, right = nodes[node]
            if left >= 0:
                for child in (left, right):
                    if bound[child] >= limit:
                        heapq.heappush(heap, (-bound[child], int(child)))
                continue
            scores = vectors[a:b] @ queries[q]
            at = np.flatnonzero(scores >= limit)
            if len(at) > 4 * k:  # only the best of a leaf, ties with the last of them included
                last = np.partition(scores[at], len(at) - k - 1)[len(at) - k - 1]
                at = at[scores[at] >= last]
            for score, row in sorted(zip(scores[at].tolist(), (-rows[a:b][at]).tolist()), reverse=True):
                if -row == name:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (score, row))
                elif (score, row) > best[0]:
                    heapq.heapreplace(best, (score, row))
                else:
                    break
        out += [(name, -row, int(score)) for score, row in best if score >= floor]
    return out


_FOUND = "query_id long, vec_id long, score long"


def _stacked(vectors: pd.Series) -> np.ndarray:
    dims = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), dims), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def quantised(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(256 x) of every component, for rows whose id, vector
    and components are all there and finite."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & fine)
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))


def top_k(table: DataFrame, every: int = 50, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of each row
    whose id is divisible by ``every``, against all rows but those with its id.

    Ties go to the smaller id; a query has fewer than k rows only if there are
    fewer candidates. Vectors that are null or hold null or non-finite
    components take no part; a shorter vector counts as filled up with zeros.
    Of rows with one id and one vector, one takes part; different vectors under
    one id are candidates of their own. No rows give no rows.
    """
    rows = cut(quantised(table, vec_id, embedding).distinct())
    n = rows.count()
    shards = max(1, -(-n // SHARD_ROWS))
    where = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")

    def plant(key, group):
        tree = build(group["vec_id"].to_numpy(np.int64), _stacked(group["v"]))
        return pd.DataFrame({"shard": [key[0]], "tree": [tree]})

    trees = cut(rows.withColumn("shard", where).groupBy("shard").applyInPandas(plant, "shard int, tree binary"))
    queries = rows.where(F.col("vec_id") % every == 0).withColumn("home", where)
    blocks = max(1, -(-n // every // shards // BLOCK_QUERIES))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))

    def gather(key, group):
        packed = _packed(ids=group["vec_id"].to_numpy(np.int64), queries=_stacked(group["v"]), kth=group["kth"].to_numpy(float))
        return pd.DataFrame({"home": [key[0]], "block": [key[1]], "queries": [packed]})

    def visit(group):
        # A group is one tree and one block; a batch of many would be large.
        found = []
        for tree, block in zip(group["tree"], group["queries"]):
            block = _open(block)
            found += search(_open(tree), block["ids"], block["queries"], block["kth"], k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    def pack(with_kth: DataFrame) -> DataFrame:
        return cut(with_kth.groupBy("home", "block").applyInPandas(gather, "home int, block int, queries binary"))

    def meet(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("shard", "home", "block").applyInPandas(visit, _FOUND)

    first = pack(queries.withColumn("kth", F.lit(float("-inf"))))
    at_home = cut(meet(first.join(trees, first.home == trees.shard)))
    worst = at_home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    kth = worst.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") >= k, F.col("least").cast("double")).alias("seen"))
    second = pack(queries.join(kth, "vec_id", "left").withColumn("kth", F.coalesce("seen", F.lit(float("-inf")))).drop("seen"))
    others = second.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    elsewhere = meet(others.join(trees, "shard"))
    found = at_home.union(elsewhere).distinct()
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Two passes over the texts. The first leaves 64-bit fingerprints, one packed row
per partition; they go to owners as Golomb codes and come back as bitmaps of
duplicates. The second digests the texts and lets only the texts of suspects
travel, where grouping by the bytes themselves decides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm import exchange
from dockflow.llm.common import cut

_FLAGGED = "doc_id long, row_key long, row_no long, sha string, suspect boolean, body binary"


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their bytes are; a null text counts as empty. The row
    with the largest id of a group stays, and of rows that repeat id and text
    just one. A null id is smaller than any other. No rows give no rows. Other
    columns are not read, whatever their names, but a column named by ``row`` (a
    key of each row) comes out as ``row_key``.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    row_key = (F.col(row) if row else F.lit(None)).cast("long").alias("row_key")
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body"), row_key)
    rows = own.rdd.map(lambda r: ((r[0], r[2]), bytes(r[1])))
    owners = max(rows.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def fingerprints(batches):
        prints = [xxhash.xxh3_64_intdigest(t) for batch in batches for t in batch.column(1).to_pylist()]
        if prints:
            part, packed = TaskContext.get().partitionId(), np.array(prints, np.uint64).tobytes()
            columns = [pa.array([part], pa.int32()), pa.array([len(prints)], pa.int32()), pa.array([packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "n", "prints"])

    packed = cut(own.mapInArrow(fingerprints, "part int, n int, prints binary"))
    counts = {r[0]: r[1] for r in packed.select("part", "n").toLocalIterator()}
    sent = packed.rdd.flatMap(lambda r: exchange.messages(r[0], np.frombuffer(bytes(r[2]), np.uint64), None, owners))
    replies = exchange.answers(sent, owners)
    kept_prints = packed.rdd.map(lambda r: (r[0], (-1, bytes(r[2]), b"")))

    def marks(part, mail, n):
        prints = next(np.frombuffer(m[1], np.uint64) for m in mail if m[0] < 0)
        unique, back = np.unique(prints, return_inverse=True)
        bits, to = np.zeros(len(unique), bool), ((unique >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
        for owner, _, flags in mail:
            if owner >= 0:
                a, b = np.searchsorted(to, [np.uint64(owner), np.uint64(owner + 1)])
                bits[a:b] = np.unpackbits(np.frombuffer(flags, np.uint8))[: b - a]
        for i, (suspect, mark) in enumerate(zip(bits[back].tolist(), (prints & np.uint64(0xFFFF)).tolist())):
            yield part * (1 << 36) + i, suspect, mark

    def digest(pair):
        (key, own), (row_no, suspect, mark) = pair
        if xxhash.xxh3_64_intdigest(own) & 0xFFFF != mark:
            raise RuntimeError("the rows of a partition changed between two reads; write the table first")
        return *key, row_no, hashlib.sha256(own).hexdigest(), suspect, own if suspect else None

    flagged = exchange.align(rows, counts, replies.union(kept_prints), marks).map(digest)
    flagged = cut(spark.createDataFrame(flagged, _FLAGGED, verifySchema=False))
    place = F.struct("doc_id", "row_no")
    suspects = flagged.where("suspect")
    # The partial aggregate runs before the shuffle: a text travels once per task.
    groups = (
        suspects.groupBy("sha", "body")
        .agg(F.max(place).alias("best"), F.count("*").alias("size"))
        .select("sha", F.col("best.doc_id").alias("keep_id"), F.col("best.row_no").alias("keep_row"), F.col("size").alias("group_size"))
    )
    keys = ["row_key"] if row else []
    joined = suspects.drop("body").join(groups, "sha").select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), F.col("sha").alias("text_sha256"), *keys
    )
    alone = flagged.where("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), *keys
    )
    return alone.union(joined)

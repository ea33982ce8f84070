"""Token files: ids by frequency rank, in as many bytes as each rank needs.

A block holds whole documents in ascending order of id. Its sections are a
header, document ids, lengths, control bytes (two bits a value, four values a
byte: one to four bytes follow) and the values' bytes. A reader looks up the
lengths of four values at once by control byte. Blocks lie in a Parquet
container, so that Spark commits the files and any store can hold them; the
ranks lie beside them.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.llm.common import over_texts, text_groups
from dockflow.llm.spaced_ids import spaced_encoder
from dockflow.llm.word_ids import kind, tokenizer
from dockflow.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Ids after which a block is closed; a longer document is a block of its own.
BLOCK_IDS = 1 << 18
_MAGIC = b"RKV1"
_HEAD = struct.Struct("<4sIQQ")
# Lengths of the four values behind a control byte.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def code(values: np.ndarray) -> bytes:
    """Control bytes, then the values' low bytes."""
    values = values.astype(np.uint32)
    sizes = 1 + (values >= 1 << 8).astype(np.int64) + (values >= 1 << 16) + (values >= 1 << 24)
    bits = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    bits[: len(values)] = sizes - 1
    control = bits.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    wide = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes() + wide[np.arange(4) < sizes[:, None]].tobytes()


def decoded(data: np.ndarray, n: int) -> np.ndarray:
    """``n`` values from their code."""
    control = -(-n // 4)
    sizes = _LENGTHS[data[:control]].ravel()[:n]
    at = control + np.cumsum(sizes) - sizes
    out = data[at].astype(np.uint32)
    for more in range(1, 4):
        has = np.flatnonzero(sizes > more)
        if len(has):
            out[has] |= data[at[has] + more].astype(np.uint32) << np.uint32(8 * more)
    return out


def pack_block(doc_ids: list, lengths: list[int], ranks: np.ndarray, start: int) -> bytes:
    """A block; ``start`` is the number of ids before it in its shard."""
    n = len(doc_ids)
    missing = np.packbits([d is None for d in doc_ids]).tobytes()
    names = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    return _HEAD.pack(_MAGIC, n, len(ranks), start) + missing + names + np.array(lengths, "<u4").tobytes() + code(ranks)


def unpack_block(block: bytes) -> tuple[list, np.ndarray, np.ndarray, int]:
    magic, n, n_ids, start = _HEAD.unpack_from(block)
    if magic != _MAGIC:
        raise ValueError("not a block of this format")
    data, at = np.frombuffer(block, np.uint8), _HEAD.size
    missing = np.unpackbits(data[at : at + -(-n // 8)])[:n]
    at += -(-n // 8)
    names = np.frombuffer(block, "<i8", n, at).tolist()
    lengths = np.frombuffer(block, "<u4", n, at + 8 * n).astype(np.int64)
    return [None if m else d for d, m in zip(names, missing)], lengths, decoded(data[at + 12 * n :], n_ids), start


def _encoded(docs: DataFrame, doc_id: str, text: str, path: str, end_id: int) -> DataFrame:
    """(doc_id, n, ids): ids with the end id, compressed by document."""

    def run(batch):
        names, bodies = batch.column(0), [t or b"" for t in batch.column(1).to_pylist()]
        encoder, squeeze, dtype = spaced_encoder(path), zstandard.ZstdCompressor(level=1), kind(path)
        end = np.array([end_id], dtype).tobytes()
        for a, b in text_groups([len(t) for t in bodies]):
            ids, counts = encoder.encode(bodies[a:b])
            raw, upto = ids.astype(dtype).tobytes(), (np.cumsum(counts) * len(end)).tolist()
            parts = [squeeze.compress(raw[x:y] + end) for x, y in zip([0, *upto], upto)]
            yield pa.RecordBatch.from_arrays([names.slice(a, b - a), pa.array(counts + 1), pa.array(parts, pa.binary())], names=["doc_id", "n", "ids"])

    return over_texts(docs, [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body")], run, "doc_id long, n long, ids binary")


def write_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, end_id: int = 0) -> None:
    """Write the ids of every text, each followed by ``end_id``, to ``path``.

    Texts are encoded once and kept, compressed, in the shared folder; counting
    and sorting read that. Ids of all documents are counted, and the most
    frequent one gets rank 0. A null text is empty, a null id sorts first,
    repeated rows are written as often as they occur, and no rows give no
    blocks. Other columns aren't read.
    """
    spark = docs.sparkSession
    kept = scratch_path(spark, "ids")
    _encoded(docs, doc_id, text, vocabulary, end_id).write.option("compression", "none").parquet(kept)
    encoded = spark.read.parquet(kept)
    size, dtype = max(tokenizer(vocabulary).get_vocab_size(), end_id + 1), kind(vocabulary)

    def count(batches):
        total, open_ = np.zeros(size, np.int64), zstandard.ZstdDecompressor()
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(open_.decompress(ids), dtype), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    # As many rows as the vocabulary at most.
    total = np.zeros(size, np.int64)
    total[counts["id"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    by_rank = np.argsort(-total, kind="stable").astype("<u4")
    spark.createDataFrame([(by_rank.tobytes(),)], "ids binary").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.empty(size, np.uint32)
    rank_of[by_rank] = np.arange(size, dtype=np.uint32)

    def blocks(batches):
        names, lengths, parts, waiting, start, number = [], [], [], 0, 0, 0
        open_ = zstandard.ZstdDecompressor()

        def close():
            block = pack_block(names, lengths, np.concatenate(parts), start)
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([waiting]), pa.array([block], pa.binary())], names=["block", "n_ids", "data"])

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ranks = rank_of[np.frombuffer(open_.decompress(ids), dtype)]
                names.append(name)
                lengths.append(len(ranks))
                parts.append(ranks)
                waiting += len(ranks)
                if waiting >= BLOCK_IDS:
                    yield close()
                    names, lengths, parts, waiting, start, number = [], [], [], 0, start + waiting, number + 1
        if names:
            yield close()

    ordered = encoded.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    written = ordered.mapInArrow(blocks, "block long, n_ids long, data binary").withColumn("shard", F.spark_partition_id())
    written.write.option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files at ``path``; ``start`` counts
    the ids of all documents before. With ``digest`` the unsigned CRC-32 of the
    ids as little-endian 32-bit integers, ids_crc32, stands in place of ids."""
    (by_rank,) = [np.frombuffer(bytes(r.ids), "<u4") for r in spark.read.parquet(f"{path}/ranks").collect()]
    blocks = spark.read.parquet(f"{path}/blocks")
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    # One row per shard.
    before = shards.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("before"))

    def run(batches):
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                names, lengths, ranks, start = unpack_block(data.as_py())
                ids = by_rank[ranks].astype("<u4")
                ends = np.cumsum(lengths)
                parts = [ids[e - n : e].tobytes() for n, e in zip(lengths.tolist(), ends.tolist())]
                shown = pa.array([zlib.crc32(p) for p in parts], pa.int64()) if digest else pa.array(parts, pa.binary())
                arrays = [pa.array([shard] * len(names), pa.int32()), pa.array(names, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), shown]
                yield pa.RecordBatch.from_arrays(arrays, names=["shard", "doc_id", "inside", "n_tokens", last])

    last = "ids_crc32" if digest else "ids"
    read = blocks.select("shard", "data").mapInArrow(run, f"shard int, doc_id long, inside long, n_tokens long, {last} {'long' if digest else 'binary'}")
    return read.join(before, "shard").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", last)

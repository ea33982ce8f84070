import zlib

import numpy as np
from texts import DOCS, documents, odd_texts

from dockflow.llm import packing, token_files, word_ids
from dockflow.session import scratch_path


def ids_of(path, text, end):
    return word_ids.tokenizer(path).encode(text or "", add_special_tokens=False).ids + [end]


def test_values_of_every_width():
    values = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    for n in range(len(values) + 1):
        assert token_files.decoded(np.frombuffer(token_files.code(values[:n]), np.uint8), n).tolist() == values[:n].tolist()


def test_token_files(spark):
    docs = documents(spark, odd_texts(), clashing=True)
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(docs, path)
    start, want = 0, []
    for r in docs.select("doc_id", "text").orderBy("doc_id").collect():
        ids = ids_of(token_files.VOCABULARY, r.text, 0)
        want.append((r.doc_id, start, len(ids), ids))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.read_tokens(spark, path).orderBy("doc_id").collect()]
    assert got == want
    empty = scratch_path(spark, "tokens")
    token_files.write_tokens(spark.createDataFrame([], DOCS), empty)
    assert token_files.read_tokens(spark, empty).count() == 0


def test_packing(spark):
    docs = documents(spark, odd_texts(), clashing=True)
    rows = packing.pack(docs, capacity=512).collect()
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = ids_of(packing.VOCABULARY, r.text, 1)
        for i in range(0, len(ids), 512):
            own = np.array(ids[i : i + 512], "<u4")
            want[r.doc_id, i // 512] = (i, len(own), zlib.crc32(own.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 512
    assert len(sequences) <= 1.02 * sum(r.length for r in rows) / 512 + 2
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0

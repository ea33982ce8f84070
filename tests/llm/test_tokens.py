import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import DOCS, documents, odd_texts

from dockflow.llm import byte_bpe

RANKS = byte_bpe.merges(byte_bpe.RANKS).ranks
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def by_hand(text):
    return TIKTOKEN.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'strevldm019 \n\t\xa0 .!é中́\U0001f600IS"), max_size=40), max_size=6))
def test_pieces_and_merges(texts):
    encoder = byte_bpe._encoder(byte_bpe.RANKS)
    ids, counts = encoder.encode(texts)
    ends = np.cumsum(counts)
    assert [ids[e - n : e].tolist() for e, n in zip(ends, counts)] == [by_hand(t) for t in texts]


def test_long_pieces():
    rng = random.Random(5)
    for piece in ["x" * 3000, "".join(rng.choice("abcde") for _ in range(4000)), "=" * 777, " " * 500 + "a"]:
        ids, _ = byte_bpe._encoder(byte_bpe.RANKS).encode([piece])
        assert ids.tolist() == by_hand(piece)


def test_encode_and_decode(spark):
    docs = documents(spark, odd_texts(), clashing=True)
    texts = {r[0]: r[1] or "" for r in docs.select("doc_id", "text").collect()}
    got = byte_bpe.decode(byte_bpe.encode(docs)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == by_hand(texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode()
    assert byte_bpe.decode(byte_bpe.encode(spark.createDataFrame([], DOCS))).count() == 0

"""License notices by an exact set-similarity join of text blocks and templates.

A block is 2w consecutive words from every wth word on, w being the words of the
longest template, so that whatever a template's length covers lies in one block
whole. A block matches a template if it holds at least the template's share of
its distinct words. The words of templates are ordered by how often the corpus
has them, rarest first. Then

* prefix: a match shares one of the first |T| - need + 1 words of the template and
  one of the first |B| - need + 1 template words of the block, where need is the
  least overlap; blocks without any rare enough word never leave their task;
* length: |B| must reach need;
* position: the words behind the first shared one must suffice for need.

What passes is verified by the full overlap. Blocks meet the templates in a join
on prefix words, and each pair at its first shared word only. Phrases are
templates that must be there whole; their places are found in the blocks that
match them.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import over_texts, text_groups
from dockflow.session import scratch_path


class Template(NamedTuple):
    label: str
    text: str
    tenths: int = 8  # of its distinct words that a block must hold
    phrase: bool = False  # stands word by word


# Phrases and labels of the base, and opening sentences of public licenses.
# Sentences that differ from another license's in a word or two must be there whole.
TEMPLATES = [
    Template("mit", "under the mit license", 10, True),
    Template("apache-2", "apache license version 2", 10, True),
    Template("cc-by-nc", "cc by nc", 10, True),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
    ),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    Template("gpl-3", "This work is licensed under the GNU General Public License, version 3", 10),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", 10),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", 10),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
]

#: Bytes to what they count as: letters in lower case, digits, all beyond ASCII; the rest parts words.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in (ord(chr(b).lower()) if b < 128 else b for b in range(256)))


def words_of(text: str) -> list[str]:
    return text.encode().translate(_FOLD).decode().split()


def need(template: Template) -> int:
    """Fewest distinct words of the template that a block must hold."""
    return -(-template.tenths * len(set(words_of(template.text))) // 10)


class _Group:
    """Template words in some texts: number, text, place in it; and words by text."""

    def __init__(self, bodies: list[bytes], numbers: dict[bytes, int]):
        texts = [b" ".join(body.translate(_FOLD).split()) for body in bodies]
        self.n_words = np.array([t.count(b" ") + 1 if t else 0 for t in texts], np.int64)
        raw = b" ".join([t for t in texts if t]) + b" "
        if not self.n_words.sum():
            self.word = self.text = self.at = np.zeros(0, np.int64)
            return
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32) + 1
        # A word and the space behind it, so that the slices lie on end.
        slices = [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(raw)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(ends), slices).dictionary_encode()
        known = np.array([numbers.get(w[:-1], -1) for w in coded.dictionary.to_pylist()], np.int64)
        numbered = known[coded.indices.to_numpy()]
        hits = np.flatnonzero(numbered >= 0)
        self.word, self.text = numbered[hits], np.repeat(np.arange(len(texts)), self.n_words)[hits]
        self.at = hits - (np.cumsum(self.n_words) - self.n_words)[self.text]


def _groups(bodies: list, numbers: dict[bytes, int]):
    bodies = [b or b"" for b in bodies]
    for a, b in text_groups([len(x) for x in bodies]):
        yield a, b, _Group(bodies[a:b], numbers)


def word_counts(docs: DataFrame, words: list[str], text: str = "text") -> dict[str, int]:
    """How often the texts hold each of these words."""
    numbers = {w.encode(): i for i, w in enumerate(words)}

    def run(batches):
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for _, _, group in _groups(batch.column(0).to_pylist(), numbers):
                total += np.bincount(group.word, minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(words)), pa.int32()), pa.array(total)], names=["word", "n"])

    counted = docs.select(F.col(text).cast("binary").alias("body")).mapInArrow(run, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {words[r["word"]]: r["n"] for r in counted.collect()}  # a row for each word of the templates
    return {w: found.get(w, 0) for w in words}


def _blocks(group: _Group, width: int, rare: np.ndarray, least: int) -> list[list[dict]]:
    """Blocks of each text with ``least`` distinct template words and a rare one among them."""
    own: list[list[dict]] = [[] for _ in group.n_words]
    block = np.concatenate([group.at // width, group.at // width - 1])
    text, at, word = (np.concatenate([x, x]) for x in (group.text, group.at, group.word))
    fine = block >= 0
    text, block, at, word = text[fine], block[fine], at[fine], word[fine]
    if not len(text):
        return own
    order = np.lexsort((at, block, text))
    text, block, at, word = text[order], block[order], at[order], word[order]
    opens = np.append(True, (text[1:] != text[:-1]) | (block[1:] != block[:-1]))
    first = np.flatnonzero(opens)
    ends = np.append(first[1:], len(text))
    has_rare = np.add.reduceat(rare[word].astype(np.int64), first) > 0
    for a, b in zip(first[has_rare & (ends - first >= least)].tolist(), ends[has_rare & (ends - first >= least)].tolist()):
        if len(set(word[a:b].tolist())) >= least:
            own[text[a]].append({"block": int(block[a]), "at": at[a:b].tolist(), "word": word[a:b].tolist()})
    return own


def _in_place(phrase: Column, at: Column, word: Column) -> Column:
    """Places where the words of ``phrase`` stand one after the other."""
    last = F.size(word) - F.size(phrase)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    same = lambda k: F.forall(
        F.sequence(F.lit(0), F.size(phrase) - 1),
        lambda m: (F.get(word, k + m) == F.get(phrase, m)) & (F.get(at, k + m) == F.get(at, k) + m),
    )
    return F.transform(F.filter(starts, same), lambda k: F.get(at, k))


_BLOCK = pa.struct([("block", pa.int32()), ("at", pa.list_(pa.int32())), ("word", pa.list_(pa.int32()))])


def matches(docs: DataFrame, templates: list[Template] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, pairs): rows (row, doc_id, n_words) of all documents, and pairs
    (row, block, template, label, phrase, containment, places) of every block
    that meets a template. ``places`` are a phrase's starts in the block's own
    first half. A pair of a phrase without a place may be there."""
    spark = docs.sparkSession
    sets = [sorted(set(words_of(t.text))) for t in templates]
    width = max(len(words_of(t.text)) for t in templates)
    counts = word_counts(docs, sorted({w for s in sets for w in s}), text)
    rank = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
    ranked = [sorted(rank[w] for w in s) for s in sets]
    needs = [need(t) for t in templates]
    prefixes = [r[: len(r) - k + 1] for r, k in zip(ranked, needs)]
    rare, least = np.zeros(len(rank), bool), min(needs)
    rare[sorted({w for p in prefixes for w in p})] = True
    numbers = {w.encode(): i for w, i in rank.items()}

    def run(batch):
        for a, b, group in _groups(batch.column(2).to_pylist(), numbers):
            blocks = pa.array(_blocks(group, width, rare, least), pa.list_(_BLOCK))
            arrays = [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(group.n_words), blocks]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_words", "blocks"])

    columns = [F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("body")]
    path = scratch_path(spark, "blocks")
    over_texts(docs, columns, run, "row long, doc_id long, n_words long, blocks array<struct<block:int,at:array<int>,word:array<int>>>").write.parquet(path)
    scanned = spark.read.parquet(path)

    known = [
        (i, t.label, t.phrase, k, r, [rank[w] for w in words_of(t.text)], j, w)
        for i, (t, k, r, p) in enumerate(zip(templates, needs, ranked, prefixes))
        for j, w in enumerate(p)
    ]
    schema = "template int, label string, phrase boolean, need int, words array<int>, in_order array<int>, j int, prefix int"
    wanted = spark.createDataFrame(known, schema)
    blocks = scanned.where(F.size("blocks") > 0).select("row", F.inline("blocks")).withColumn("words_here", F.array_sort(F.array_distinct("word")))
    front = F.slice("words_here", 1, F.size("words_here") - (least - 1))
    probes = blocks.select("*", F.posexplode(front).alias("i", "prefix"))
    # The templates are a fixed list: as many rows as their prefixes have words.
    met = probes.join(F.broadcast(wanted), "prefix")
    behind = F.least(F.size("words_here") - F.col("i"), F.size("words") - F.col("j"))
    first_shared = ~F.arrays_overlap(F.slice("words_here", F.lit(1), F.col("i")), F.slice("words", F.lit(1), F.col("j")))
    overlap = F.size(F.array_intersect("words_here", "words"))
    met = met.where((F.size("words_here") >= F.col("need")) & (behind >= F.col("need")) & first_shared & (overlap >= F.col("need")))
    own_half = lambda place: place < (F.col("block") + 1) * width
    places = F.when(F.col("phrase"), F.filter(_in_place(F.col("in_order"), F.col("at"), F.col("word")), own_half))
    pairs = met.select("row", "block", "template", "label", "phrase", (overlap / F.size("words")).alias("containment"), places.alias("places"))
    return scanned.select("row", "doc_id", "n_words"), pairs


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of ASCII letters (lower-cased), digits and characters beyond
    ASCII. ``n_base`` counts the places of the phrases, ``first_word`` and
    ``last_word`` are the least and greatest start among them. ``base_labels``
    are the phrases' labels, ``labels`` also those of all other templates that
    a block meets, each sorted and joined by commas ('' if there are none).
    ``score`` is the greatest containment among a document's labels, 0 without
    any. A null or empty text has no words. Repeated rows and ids are rows of their
    own, no rows give none, other columns aren't read.
    """
    rows, pairs = matches(docs, templates, doc_id, text)
    counts = ~F.col("phrase") | (F.size("places") > 0)
    base, none = F.col("phrase"), F.array().cast("array<string>")
    found = (
        pairs.where(counts)
        .groupBy("row")
        .agg(
            F.sum(F.when(base, F.size("places"))).cast("long").alias("n_base"),
            F.min(F.array_min("places")).cast("long").alias("first_word"),
            F.max(F.array_max("places")).cast("long").alias("last_word"),
            F.collect_set(F.when(base, F.col("label"))).alias("base"),
            F.collect_set("label").alias("all"),
            F.max("containment").alias("score"),
        )
    )
    joined = lambda c: F.array_join(F.array_sort(F.coalesce(F.col(c), none)), ",")
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        joined("base").alias("base_labels"),
        joined("all").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

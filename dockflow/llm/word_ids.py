"""Ids of whole texts by the tokenizers library, each distinct word once.

Where a tokenizer never joins two neighbours, a text can be cut and its parts
encoded apart. The parts are looked up in a cache, and the library encodes what
the cache doesn't have, so that a worker pays for its distinct words only.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np
from tokenizers import Tokenizer

os.environ["TOKENIZERS_PARALLELISM"] = "false"

#: Words in one of a worker's two generations; a full one becomes the old one,
#: from which words that are used again move back. Longer words aren't kept.
CACHED, LONGEST = 600_000, 64
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
#: A letter run ends before one of these, and whatever follows is a part of its own.
_STOPS = frozenset(".,!?;:")


class _Unsafe(Exception):
    """A word that begins or ends with white space can't be cut off."""


@cache
def tokenizer(path: str) -> Tokenizer:
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # their strings in a text are ordinary text
    return made


@cache
def kind(path: str) -> str:
    """Integers that hold every id of the vocabulary."""
    return "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies spell bytes: printable ones
    stand for themselves, the rest for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Parts(dict):
    """Ids, as bytes, of a prefix and the word that is the key."""

    def __init__(self, path: str, prefix: str, fold: bool):
        super().__init__()
        self.library, self.kind, self.prefix, self.fold = tokenizer(path), kind(path), prefix, fold
        self.letters = _byte_letters()
        self.spelt = prefix.translate(self.letters)
        self.tail = self
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(word) <= LONGEST:
            if len(self) >= CACHED:
                self.old = self.copy()
                self.clear()
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if not word.isalpha():
            # Lower case too, as a letter may become a letter and a sign.
            if len(word) > 1 and word[-1] in _STOPS and word[-2].lower().isalpha():
                return self[word[:-1]] + self.tail[word[-1]]
            head, line, rest = word.partition("\n")
            if head and rest and not head[-1].isspace() and not rest[0].isspace():
                return self[head] + self.tail[line] + self.tail[rest]
            if self.prefix and (not word or word[0].isspace() or word[-1].isspace()):
                raise _Unsafe
        folded = self.library.normalizer.normalize_str(word) if self.fold and not word.isascii() else word
        if folded.isalpha():  # one run of letters, which only the merges can cut
            if folded.isascii():
                spelt = self.spelt + folded
            else:
                spelt = (self.prefix + folded).encode().decode("latin-1").translate(self.letters)
            return np.array([t.id for t in self.library.model.tokenize(spelt)], self.kind).tobytes()
        return np.array(self.library.encode(self.prefix + word, add_special_tokens=False).ids, self.kind).tobytes()


class SpacedWords:
    """For byte-level tokenizers: a space that follows other text begins a new
    piece, to which it belongs."""

    def __init__(self, path: str):
        self.bare, self.spaced = _Parts(path, "", False), _Parts(path, " ", False)
        self.spaced.tail = self.bare

    def ids(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            if first and first[-1].isspace():
                raise _Unsafe
            spaced = self.spaced
            return self.bare[first] + b"".join([spaced[w] for w in rest])
        except _Unsafe:
            return b"".join([self.bare[p] for p in _BEFORE_SPACE.split(text)])


class FoldedWords:
    """For tokenizers that fold case and drop white space: ASCII white space
    separates parts."""

    def __init__(self, path: str):
        self.parts = _Parts(path, "", True)

    def ids(self, text: str) -> bytes:
        # Bytes know ASCII case and white space only, as is wanted here.
        parts = self.parts
        words = b" ".join(text.encode().lower().split()).decode()
        return b"".join([parts[w] for w in words.split(" ")])


@cache
def spaced_words(path: str) -> SpacedWords:
    return SpacedWords(path)


@cache
def folded_words(path: str) -> FoldedWords:
    return FoldedWords(path)

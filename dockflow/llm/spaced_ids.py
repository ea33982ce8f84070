"""Ids of texts by a byte-level tokenizer, many texts at once.

Such a tokenizer never joins a space that follows other text with what stands
before it, nor letters with a stop behind them, so texts are cut there. The cuts
are found in the bytes of all texts together, equal pieces meet the cache once a
batch, and only pieces new to the cache are encoded.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

from dockflow.llm.piece_ids import CACHED, PieceEncoder
from dockflow.llm.word_ids import _Unsafe, spaced_words, tokenizer

# White space beyond ASCII, as its last bytes in UTF-8; and in ASCII.
WIDE_SPACE = [chr(c).encode() for c in [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]
_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[*range(9, 14), *range(28, 33)]] = True
_NOT_PLAIN = _ASCII_SPACE | (np.arange(256) >= 128)
_WIDE = np.array(sorted(int.from_bytes(b.rjust(3, b"\0"), "big") for b in WIDE_SPACE))


_LETTERS, _STOPS = np.zeros(256, bool), np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_STOPS[[ord(c) for c in ".,!?;:"]] = True


def cuts(raw: np.ndarray) -> np.ndarray:
    """Whether a text may be cut before each byte: before a space that follows a
    character other than white space, between an ASCII letter and a stop, and
    on both sides of a line break between ASCII characters other than white space."""
    n, cut = len(raw), np.zeros(len(raw), bool)
    cut[1:] = _STOPS[raw[1:]] & _LETTERS[raw[:-1]]
    at = np.flatnonzero(raw == 10)
    at = at[(at > 0) & (at < n - 1)]
    at = at[~_NOT_PLAIN[raw[at - 1]] & ~_NOT_PLAIN[raw[at + 1]]]
    cut[at] = cut[at + 1] = True
    at = np.flatnonzero(raw == 32)
    at = at[at > 0]
    at = at[~_ASCII_SPACE[raw[at - 1]]]
    wide = raw[at - 1] >= 128
    if wide.any():
        end = at[wide]
        two, one = raw[end - 2].astype(np.int64), raw[end - 1].astype(np.int64)
        three = np.where(end > 2, raw[np.maximum(end - 3, 0)], 0).astype(np.int64)
        short, whole = two << 8 | one, three << 16 | two << 8 | one
        blank = np.isin(whole, _WIDE) | ((short < 0xC300) & np.isin(short, _WIDE))
        keep = np.ones(len(at), bool)
        keep[np.flatnonzero(wide)[blank]] = False
        at = at[keep]
    cut[at] = True
    return cut


class SpacedEncoder(PieceEncoder):
    """A ``PieceEncoder`` whose pieces end before spaces and stops."""

    def __init__(self, path: str):
        self.library, self.words = tokenizer(path), spaced_words(path)
        super().__init__(self._ids_of)

    def _ids_of(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece. One run of letters, which only the merges can cut,
        goes to them at once, in the letters by which the vocabulary spells bytes."""
        merge, letters = self.library.model.tokenize, self.words.bare.letters
        space, out = " ".translate(letters), []
        for piece in pieces:
            text = piece.decode()
            spaced = text[0] == " "
            word = text[1:] if spaced else text
            if word.isalpha():
                spelt = word if word.isascii() else word.encode().decode("latin-1").translate(letters)
                out.append([t.id for t in merge(space + spelt if spaced else spelt)])
            else:
                out.append(self._alone(text))
        return out

    def _alone(self, text: str) -> list[int]:
        part = self.words.bare
        if text[0] == " ":
            try:
                return np.frombuffer(self.words.spaced._ids(text[1:]), part.kind).tolist()
            except _Unsafe:
                pass
        return np.frombuffer(part._ids(text), part.kind).tolist()

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts on end, number of ids of each text) of UTF-8 texts."""
        if self.count > CACHED:
            self._reset()
        data = b"".join(texts)
        if not data:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        ends = np.cumsum(np.fromiter((len(t) for t in texts), np.int64, len(texts)))
        begins = np.concatenate([[0], ends[:-1]])
        opens = cuts(np.frombuffer(data, np.uint8))
        opens[begins[begins < ends]] = True
        starts = np.flatnonzero(opens)
        offsets = pa.py_buffer(np.append(starts, len(data)))
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        known, get = coded.dictionary.to_pylist(), self.slots.get
        slots = np.fromiter((get(p, -1) for p in known), np.int64, len(known))
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self._add([known[i] for i in new])
        slots = slots[coded.indices.to_numpy()]
        sizes = self.size[slots]
        upto = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.begin[slots] - upto + sizes, sizes) + np.arange(upto[-1])]
        return ids, np.diff(np.append(0, upto)[np.searchsorted(starts, np.append(begins, len(data)))])


@cache
def spaced_encoder(path: str) -> SpacedEncoder:
    return SpacedEncoder(path)

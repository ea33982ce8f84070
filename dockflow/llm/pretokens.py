"""Pre-tokenisation without regular expressions.

The pattern (contractions, letters, digits, other signs, white space) is a
finite automaton once a character's class looks at its next two neighbours.
Each class is a transition function on eight states. Composition of functions
is associative, so a batch is cut into blocks: all blocks compose their
functions at once, a doubling scan composes the blocks, and a last pass replays
every block from its now known state and marks the pieces' first characters.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

# Classes of characters.
LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, SPACE_LAST, WHITE_LAST, WHITE = range(8)
# States: what the piece so far is. ONE and TWO: characters left of a contraction.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, IN_WHITE, ONE, TWO = range(8)
_BLOCK = 128

# The code points of Unicode's White_Space.
WHITE_SPACE = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


@cache
def _classes() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    table[WHITE_SPACE] = WHITE
    return table


@cache
def _automaton(attach_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """(next state, piece begins here) by class * 8 + state; classes from 8 on
    are those of a text's first character, which forget the state."""
    step, begins = np.zeros((16, 8), np.uint8), np.zeros((16, 8), bool)
    for c in range(8):
        for s in range(8):
            if s in (ONE, TWO):
                to, new = (FRESH if s == ONE else ONE), False
            elif c in (QUOTE2, QUOTE3) and s not in (IN_OTHERS, AFTER_SPACE):
                to, new = (ONE if c == QUOTE2 else TWO), True
            elif c in (LETTER, NUMBER, OTHER, QUOTE2, QUOTE3):
                to = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(c, IN_OTHERS)
                new = s not in (to, AFTER_SPACE)
            elif c == WHITE:
                to, new = IN_WHITE, s != IN_WHITE
            else:
                to, new = (AFTER_SPACE if c == SPACE_LAST and attach_space else IN_WHITE), True
            step[c, s], begins[c, s] = to, new
    for c in range(8):
        step[8 + c], begins[8 + c] = step[c, FRESH], True
    return step.ravel(), begins.ravel()


def _symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The class of every character, as its two next neighbours make it."""
    n = len(points)
    kind = _classes()[points]
    last = np.zeros(n, bool)
    last[firsts[1:] - 1] = True
    last[-1:] = True
    white = kind == WHITE
    next_black = np.zeros(n, bool)
    next_black[:-1] = ~white[1:]
    ends = white & next_black & ~last
    symbols = np.where(ends, np.where(points == 32, SPACE_LAST, WHITE_LAST), kind).astype(np.uint8)
    quotes = np.flatnonzero(points == 39)
    if len(quotes):
        wide = np.append(points, [0, 0])
        inside1 = ~last[quotes]
        inside2 = inside1 & ~np.append(last, True)[quotes + 1]
        a, b = wide[quotes + 1], wide[quotes + 2]
        short = inside1 & np.isin(a, [ord(x) for x in "stmd"])
        pairs = [(ord(x), ord(y)) for x, y in ("re", "ve", "ll")]
        long = inside2 & np.logical_or.reduce([(a == x) & (b == y) for x, y in pairs])
        symbols[quotes[short]] = QUOTE2
        symbols[quotes[long]] = QUOTE3
    symbols[firsts] += 8
    return symbols


def piece_starts(points: np.ndarray, firsts: np.ndarray, attach_space: bool = True) -> np.ndarray:
    """Index of the first character of every piece.

    ``points`` are the code points of several texts on end, ``firsts`` the index
    of each non-empty text's first one. Without ``attach_space`` a space belongs
    to no following piece.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    step, begins = _automaton(attach_space)
    blocks = -(-n // _BLOCK)
    symbols = np.full(blocks * _BLOCK, WHITE, np.int16)
    symbols[:n] = _symbols(points, firsts)
    columns = np.ascontiguousarray(symbols.reshape(blocks, _BLOCK).T) * 8

    whole = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in columns:
        whole = step.take(column[:, None] + whole)
    reach = 1
    while reach < blocks:  # whole[i] becomes the function of blocks up to i
        later = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.int64), axis=1)
        whole = np.concatenate([whole[:reach], later])
        reach *= 2
    state = np.concatenate([[FRESH], whole[:-1, FRESH]]).astype(np.uint8)
    marks = np.empty((_BLOCK, blocks), bool)
    for i, column in enumerate(columns):
        at = column + state
        marks[i] = begins.take(at)
        state = step.take(at)
    return np.flatnonzero(marks.T.ravel()[:n])

"""Pre-tokens of byte-level BPE found without a regular expression.

Every code point has one of eleven classes. A character's class is a function
from states to states, and such functions compose associatively: the text is
cut into chunks, all chunks run side by side from every state, the chunk
functions are combined by a prefix scan, and a second run from the then known
states marks the boundaries. What a character says about its predecessor (white
space before a word, an apostrophe that is no contraction) comes one step later.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import regex
from tokenizers import pre_tokenizers

SPACE, WHITE, LETTER, NUMBER, OTHER, QUOTE, STMD, R, V, L, E = range(11)
N_CLASSES = 11
WORD, DIGITS, SYMBOLS, QUOTED, Q_R, Q_V, Q_L, CLOSED, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE, START = range(13)
N_STATES = 12
CHUNK = 256
_LETTERS = (LETTER, STMD, R, V, L, E)
_CLASSES: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """The class of every code point.

    Where two Unicode versions at hand disagree about letters and numbers, the
    tokenizers library decides: the point is a letter if it joins a letter.
    """
    if _CLASSES:
        return _CLASSES[0]
    points = np.array([i for i in range(0x110000) if not 0xD800 <= i < 0xE000])
    every = "".join(map(chr, points))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+")):
        for m in regex.finditer(pattern, every):
            table[points[m.start():m.end()]] = kind
    disputed = [c for c in every if table[ord(c)] in (LETTER, NUMBER) and unicodedata.category(c)[0] not in "LN"]
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    for first in range(0, len(disputed), 5000):
        part = disputed[first:first + 5000]
        begins = np.zeros(6 * len(part) + 1, bool)
        for _, (a, _b) in split.pre_tokenize_str("".join(f"a{c}0{c}!{c}" for c in part)):
            begins[a] = True
        alone = begins[:-1].reshape(-1, 6)
        table[[ord(c) for c in part]] = np.where(~alone[:, 1], LETTER, np.where(~alone[:, 3], NUMBER, OTHER))
    for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        for c in chars:
            table[ord(c)] = kind
    _CLASSES.append(table)
    return table


def _step(state: int, kind: int) -> tuple[int, int, int]:
    """The next state, whether a pre-token begins at this character, and whether one begins at the character before."""
    late = 0
    if state in (Q_R, Q_V, Q_L):
        if (state in (Q_R, Q_V) and kind == E) or (state == Q_L and kind == L):
            return CLOSED, 0, 0
        state, late = WORD, 1  # the quote stands alone and its letter begins a word
    if kind in (SPACE, WHITE):
        white = state in (ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE)
        after = (MORE_SPACE if white else ONE_SPACE) if kind == SPACE else (MORE_WHITE if white else ONE_WHITE)
        return after, int(not white), late
    if state == QUOTED and kind in (STMD, R, V, L):
        return {STMD: CLOSED, R: Q_R, V: Q_V, L: Q_L}[kind], 0, late
    own = WORD if kind in _LETTERS else DIGITS if kind == NUMBER else SYMBOLS
    if state in (ONE_SPACE, MORE_SPACE):  # the last space belongs to what follows
        return own, 0, int(state == MORE_SPACE)
    if state == own or (own == SYMBOLS and state == QUOTED):
        return own, 0, late
    late = late or int(state == MORE_WHITE)
    return (QUOTED if kind == QUOTE else own), 1, late


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By class * 12 + state, and by 132 + class for a first character: the next state; its two marks."""
    after = np.zeros((2 * N_CLASSES) * N_STATES, np.uint8)
    marks = np.zeros_like(after)
    for kind in range(2 * N_CLASSES):
        for state in range(N_STATES):
            to, here, before = _step(START if kind >= N_CLASSES else state, kind % N_CLASSES)
            after[kind * N_STATES + state] = to
            marks[kind * N_STATES + state] = here | before << 1
    return after, marks


AFTER, MARKS = _tables()


def entry_states(classes: np.ndarray) -> np.ndarray:
    """The state before each chunk; classes: (position in chunk, chunk), scaled by the number of states."""
    n = classes.shape[1]
    maps = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8)[:, None], (N_STATES, n)).copy()
    for row in classes:
        maps = AFTER[row + maps]
    maps = np.ascontiguousarray(maps.T)
    reach = 1
    while reach < n:  # inclusive scan: a chunk's function after those of `reach` chunks before it
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].copy(), axis=1)
        reach *= 2
    states = np.zeros(n, np.uint8)
    states[1:] = maps[:-1, 0]  # the first character of all sets the state whatever it was
    return states


def boundaries(data: bytes, firsts: np.ndarray) -> np.ndarray:
    """Byte offsets at which the pre-tokens of UTF-8 `data` begin; pieces begin at `firsts` (sorted, each on a character)."""
    if not data:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    points = np.frombuffer(data.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    wide = -(-n // CHUNK)
    kinds = np.full(wide * CHUNK, OTHER * N_STATES, np.uint16)
    np.multiply(class_table()[points], N_STATES, out=kinds[:n], dtype=np.uint16)
    begin = np.searchsorted(at, firsts)
    kinds[begin[begin < n]] += N_CLASSES * N_STATES
    kinds = np.ascontiguousarray(kinds.reshape(wide, CHUNK).T)
    state = entry_states(kinds)
    marks = np.empty(kinds.shape, np.uint8)
    ends = np.empty(kinds.shape, np.uint8)
    for i, row in enumerate(kinds):
        key = row + state
        marks[i] = MARKS[key]
        state = ends[i] = AFTER[key]
    marks, ends = marks.T.reshape(-1)[:n], ends.T.reshape(-1)[:n]
    begins = (marks & 1).astype(bool)
    begins[begin[begin < n]] = True
    late = marks[1:] >> 1 == 1
    late[begin[(begin > 0) & (begin < n)] - 1] = False  # said of another piece
    begins[:-1] |= late
    last = np.append(begin[1:], n) - 1
    last = last[last >= 0]
    begins[last[np.isin(ends[last], (Q_R, Q_V, Q_L))]] = True
    return at[begins]

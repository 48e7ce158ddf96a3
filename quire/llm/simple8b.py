"""Simple-8b: 64-bit words of a 4-bit selector and 60 bits that hold 1 to 120 equal-width ids.

A block stands alone: its id count, words and escapes. Ids of 2**60 or more are escapes: a word with
selector 0 keeps their place and the id follows the block's words in full.
"""

from __future__ import annotations

import numpy as np

#: (ids in a word, bits of an id) by selector; selector 0 marks an escape.
SELECTORS = [(1, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_COUNT = np.array([n for n, _ in SELECTORS])
_ESCAPE = np.uint64(1 << 60)


def _choices(width: np.ndarray) -> np.ndarray:
    """For each position the selector whose word would hold the most ids from there; 0 for an escape.

    A selector fits where the widest of its next ids does; the widest of a run comes from those of shorter runs.
    """
    n = len(width)
    choice = np.where(width > 60, 0, 15).astype(np.uint8)
    least = int(width.min())
    widest, held = width, 1
    for s in range(14, 0, -1):  # from few wide ids to many narrow ones
        count, bits = SELECTORS[s]
        if bits < least:
            break  # no id is so narrow
        while held < min(count, n):  # ids behind the end take no room
            step = min(held, count - held)
            widest = np.maximum(widest, np.append(widest[step:], np.zeros(min(step, n), np.uint8)))
            held += step
        choice[widest <= bits] = s
    return choice


def encode_block(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes (unsigned 64-bit) of a block's ids."""
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    width = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    ids = ids.astype(np.uint64)
    width[(width > 60) & (ids < _ESCAPE)] = 60
    choice = _choices(width)
    step = _COUNT[choice].tolist()
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    start = np.array(starts)
    chosen = choice[start]
    padded = np.concatenate([ids, np.zeros(120, np.uint64)])
    words = np.empty(len(start), np.uint64)
    for s in np.unique(chosen):
        count, bits = SELECTORS[s]
        rows = np.flatnonzero(chosen == s)
        word = np.full(len(rows), np.uint64(int(s) << 60))
        if bits:
            for k in range(count):
                word |= padded[start[rows] + k] << np.uint64(k * bits)
        words[rows] = word
    return words, ids[start[chosen == 0]]


def decode_block(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ids of a block, selector by selector."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[selector]
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(selector):
        k, bits = SELECTORS[s]
        rows = np.flatnonzero(selector == s)
        if s == 0:
            out[start[rows]] = escapes
        elif bits:
            shifts = (np.arange(k) * bits).astype(np.uint64)
            out[start[rows][:, None] + np.arange(k)] = (words[rows][:, None] >> shifts) & np.uint64((1 << bits) - 1)
    return out[:n]

"""Simple-8b coding of token ids in 64-bit words, by blocks that are coded and decoded side by side with numpy.

A word holds a selector in its 4 highest bits and as many values of equal width as the selector says in the other 60. The greatest count that
fits is taken at each step. A value of more than 60 bits is an escape: its word holds the position of the value in the block's list of
whole 64-bit values.
"""

from __future__ import annotations

import numpy as np

#: Fixed values: (values in a word, bits of each) by selector. The last selector is the escape.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64])
ESCAPE = len(COUNTS) - 1
BLOCK = 4096
_PAD = int(COUNTS.max())


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, 1 at least."""
    out = np.ones(values.shape, np.uint8)
    for shift in (32, 16, 8, 4, 2, 1):
        more = (values >> np.uint64(shift)) > 0
        out[more] += np.uint8(shift)
        values = np.where(more, values >> np.uint64(shift), values)
    return out


def _fitting(widths: np.ndarray) -> np.ndarray:
    """The selector to use at each position: the one with most values that all fit."""
    n = widths.shape[1] - _PAD
    doubled = {1: widths}
    for step in (1, 2, 4, 8, 16):
        less = doubled[step]
        doubled[2 * step] = np.maximum(less[:, :-step], less[:, step:])
    best = np.full((widths.shape[0], n), ESCAPE, np.uint8)
    for s in range(ESCAPE - 1, -1, -1):
        count = int(COUNTS[s])
        power = 1 << (count.bit_length() - 1)
        most = np.maximum(doubled[power][:, :n], doubled[power][:, count - power : count - power + n])
        best[most <= WIDTHS[s]] = s
    return best


def encode(ids: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of up to BLOCK ids: (ids in it, words, whole values of escapes)."""
    n = len(ids)
    if not n:
        return []
    blocks = -(-n // BLOCK)
    values = np.zeros(blocks * BLOCK, np.uint64)
    values[:n] = ids
    values = np.pad(values.reshape(blocks, BLOCK), ((0, 0), (0, _PAD)))
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = n - (blocks - 1) * BLOCK
    best = _fitting(_widths(values))
    # All blocks step from word to word together.
    at, alive, taken = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(alive):
        here = at[alive]
        chosen = best[alive, here]
        taken.append((alive, here, chosen))
        at[alive] = here + COUNTS[chosen]
        alive = alive[at[alive] < sizes[alive]]
    block, start, chosen = (np.concatenate(x) for x in zip(*taken))
    order = np.argsort(block, kind="stable")
    block, start, chosen = block[order], start[order], chosen[order]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(ESCAPE):
        own = np.flatnonzero(chosen == s)
        if len(own):
            steps = np.arange(COUNTS[s])
            got = values[block[own, None], start[own, None] + steps] << (steps * WIDTHS[s]).astype(np.uint64)
            words[own] |= np.bitwise_or.reduce(got, axis=1)
    escaped = np.flatnonzero(chosen == ESCAPE)
    whole = values[block[escaped], start[escaped]]
    ends = np.searchsorted(block, np.arange(blocks + 1))
    out = []
    for b in range(blocks):
        own = slice(*np.searchsorted(escaped, ends[b : b + 2]))
        words[escaped[own]] |= np.arange(own.stop - own.start, dtype=np.uint64)
        out.append((int(sizes[b]), words[ends[b] : ends[b + 1]], whole[own]))
    return out


def decode(sizes: np.ndarray, n_words: np.ndarray, words: np.ndarray, n_escapes: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """Ids of consecutive blocks: their words and escapes, each one after the other."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[chosen]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    starts = ends - counts
    for s in range(ESCAPE):
        own = np.flatnonzero(chosen == s)
        if len(own):
            steps = np.arange(COUNTS[s])
            out[starts[own, None] + steps] = (words[own, None] >> (steps * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << int(WIDTHS[s])) - 1)
    escaped = np.flatnonzero(chosen == ESCAPE)
    if len(escaped):
        block = np.repeat(np.arange(len(n_words)), n_words)[escaped]
        inside = (words[escaped] & np.uint64((1 << 60) - 1)).astype(np.int64)
        out[starts[escaped]] = escapes[(np.cumsum(n_escapes) - n_escapes)[block] + inside]
    # The last word of a block may be filled up with zeros.
    first = np.concatenate([[0], ends])[np.cumsum(n_words) - n_words] if len(n_words) else np.zeros(0, np.int64)
    whole = np.concatenate([[0], ends])[np.cumsum(n_words)] - first if len(n_words) else np.zeros(0, np.int64)
    keep = np.arange(len(out)) - np.repeat(first, whole) < np.repeat(sizes, whole)
    return out[keep]

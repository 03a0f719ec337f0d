"""A compressed FM-index over word sequences: backward search for many patterns side by side.

The Burrows-Wheeler transform of the indexed pieces lies in a wavelet matrix: one bit vector per bit of the word numbers, packed in 64-bit words with running
counts. ``matches`` computes clipped matching statistics of streamed pieces: for each position whether the ``length`` words from there on
occur in an indexed document that is smaller than the piece's own.
"""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np

#: Words of the short search that tells whether a failed place can be skipped as a whole.
PROBE = 8


def suffix_order(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by prefix doubling, and for each of its places whether the suffix shares ``length`` symbols with the one before."""
    n = len(symbols)
    rank, step, shared, covered = symbols.astype(np.int64), 1, None, 1
    goal = 1 << (length.bit_length() - 1)
    order = np.argsort(rank, kind="stable")
    while True:
        values = rank[order]
        new = np.concatenate([[0], np.cumsum(values[1:] != values[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if covered == goal:
            shared = rank
        if new[-1] == n - 1:
            break
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        rank = rank * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        step, covered = 2 * step, 2 * covered
    if shared is None:
        return order, np.zeros(n, bool)
    later = shared[np.minimum(np.arange(n) + length - goal, n - 1)]
    same = np.zeros(n, bool)
    same[1:] = (shared[order[1:]] == shared[order[:-1]]) & (later[order[1:]] == later[order[:-1]])
    return order, same


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, size: int):
        self.depth = max(1, int(size - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for shift in range(self.depth - 1, -1, -1):
            bits = (symbols >> shift) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            packed = np.pad(packed, (0, 8 + -len(packed) % 8)).view("<u8")
            ones = np.bitwise_count(packed).astype(np.int64)
            self.words.append(packed)
            self.counts.append((np.cumsum(ones) - ones).astype(np.int32))
            self.zeros.append(int(len(symbols) - ones.sum()))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def descend(self, place: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Where ``place`` comes to on the way of ``symbol`` through all levels."""
        for level in range(self.depth):
            word = place >> 6
            below = self.words[level][word] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))
            ones = self.counts[level][word] + np.bitwise_count(below)
            place = np.where((symbol >> (self.depth - 1 - level)) & 1, self.zeros[level] + ones, place - ones)
        return place


class FMIndex:
    """``pieces``: lists of words; ``docs``: the document of each piece. ``length``: words of a match."""

    def __init__(self, pieces: list[list[bytes]], docs: np.ndarray, length: int):
        self.length = length
        self.numbers = {w: i for i, w in enumerate(set(chain.from_iterable(pieces)), 1)}
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes + 1) - 1
        self.n = n = int(sizes.sum()) + len(pieces)
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(pieces)), np.int64, n - len(pieces))
        # Each end of a piece is a symbol of its own, smaller than all words.
        order_symbols = text + len(pieces)
        order_symbols[ends] = np.arange(len(pieces))
        order, same = suffix_order(order_symbols, length - 1)
        size = len(self.numbers) + 1
        self.matrix = WaveletMatrix(text[order - 1], size)
        symbols = np.arange(size)
        first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))[:-1]])
        self.shift = first - self.matrix.descend(np.zeros(size, np.int64), symbols)
        # For each place, the range of places that share length - 1 words with it.
        starts = np.flatnonzero(~same)
        group = np.cumsum(~same) - 1
        self.low, self.high = starts[group], np.append(starts[1:], n)[group]
        self.docs, ranks = np.unique(docs, return_inverse=True)
        least = np.repeat(ranks, sizes + 1)[order].astype(np.int32)
        self.least = [least]
        while 2 << (len(self.least) - 1) <= n:
            half, last = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(last[: len(last) - half], last[half:]))

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rank of the smallest document among the places from ``low`` to ``high``."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.least[k][low[own]], self.least[k][high[own] - (1 << int(k))])
        return out

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the places whose suffix is the symbol and then a suffix of the given places."""
        both = self.matrix.descend(np.concatenate([low, high]), np.concatenate([symbol, symbol]))
        moved = both + np.concatenate([self.shift[symbol], self.shift[symbol]])
        return moved[: len(low)], moved[len(low) :]

    def matches(self, pieces: list[list[bytes]], docs: np.ndarray) -> list[np.ndarray]:
        """For each piece, per start position, whether ``length`` words from there on occur in a smaller document of the index."""
        length = self.length
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begins = np.cumsum(sizes) - sizes
        text = np.fromiter(map(self.numbers.get, chain.from_iterable(pieces), repeat(-1)), np.int64, int(sizes.sum()))
        found = np.zeros(len(text), bool)
        smaller = np.searchsorted(self.docs, docs)  # documents of the index that are smaller
        alive = np.flatnonzero(sizes >= length)
        # State of each piece: last word of the pattern, its words so far, places; a probe remembers where to go on.
        end = begins + sizes - 1
        size, low, high = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), np.full(len(pieces), self.n)
        back = np.full(len(pieces), -1)
        while len(alive):
            at = end[alive] - size[alive]
            symbol = text[at]
            lo, hi = self.extend(low[alive], high[alive], np.maximum(symbol, 0))
            failed = (symbol < 0) | (hi <= lo)
            good = alive[~failed]
            low[good], high[good] = lo[~failed], hi[~failed]
            size[good] += 1
            # A whole match: note it and drop its last word.
            whole = good[size[good] == length]
            if len(whole):
                found[end[whole] - length + 1] = self.smallest(low[whole], high[whole]) < smaller[whole]
                end[whole] -= 1
                size[whole] = length - 1
                low[whole], high[whole] = self.low[low[whole]], self.high[low[whole]]
            # A probe that came through: nothing can be skipped.
            through = good[(back[good] >= 0) & (size[good] == PROBE)]
            end[through] = back[through] - 1
            # A failure at word ``at``: a pattern that holds all from there to its end occurs nowhere.
            bad, place = alive[failed], at[failed]
            unknown, probed = symbol[failed] < 0, back[bad] >= 0
            long = size[bad] > PROBE
            begin_probe = bad[~unknown & ~probed & long]
            back[begin_probe] = end[begin_probe]
            end[begin_probe] = place[~unknown & ~probed & long] + PROBE - 1
            step = ~unknown & (probed | ~long)
            end[bad[step]] -= 1
            end[bad[unknown]] = place[unknown] - 1
            for again in (through, bad[unknown], bad[step]):
                back[again] = -1
            for again in (through, bad):
                size[again], low[again], high[again] = 0, 0, self.n
            alive = alive[(back[alive] >= 0) | (end[alive] - begins[alive] >= length - 1)]
        return [found[b : b + max(0, s - length + 1)] for b, s in zip(begins, sizes)]

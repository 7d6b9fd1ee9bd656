"""A word-level FM-index in numpy: suffix sorting, wavelet ranks, backward search, sampled locate.

Used inside tasks on one shard of bounded size; all operations are vectorised over the
patterns or the rows asked for.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8   # every SAMPLE-th text position keeps its suffix position


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Start positions of the sorted suffixes of ``seq`` (non-negative ints, last one a unique 0).

    Several symbols are packed into the first sort key; after that only the suffixes that
    still tie are sorted again, on their rank ``h`` symbols further, with ``h`` doubling.
    """
    n = len(seq)
    bits = max(1, int(seq.max()).bit_length())
    packed = max(1, 62 // bits)
    key = np.zeros(n + packed, dtype=np.int64)
    padded = np.zeros(n + packed, dtype=np.int64)
    padded[:n] = seq
    key = padded[:n].copy()
    for j in range(1, packed):
        key = (key << bits) | padded[j:n + j]
    sa = np.argsort(key, kind="stable")
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    sorted_key, members, h = key[sa], sa, packed
    while True:
        first = np.r_[True, sorted_key[1:] != sorted_key[:-1]]
        start = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        rank[members] = start
        tied = ~(first & np.r_[first[1:], True])
        if not tied.any():
            return sa
        slots, members = slots[tied], members[tied]
        ahead = members + h
        far = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[members] * (n + 1) + far
        order = np.argsort(key, kind="stable")
        members, sorted_key = members[order], key[order]
        sa[slots] = members
        h *= 2


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, dtype=bool)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each position."""
        w, r = i >> 6, (i & 63).astype(np.uint64)
        low = self.words[w] & ((np.uint64(1) << r) - np.uint64(1))
        return self.before[w] + np.bitwise_count(low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return ((self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Symbol ranks and access over an int sequence; one bit vector a level, zeros before ones."""

    def __init__(self, seq: np.ndarray):
        self.depth = max(1, int(seq.max()).bit_length())
        self.levels, self.zeros = [], []
        for level in range(self.depth - 1, -1, -1):
            bit = (seq >> level & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        low = np.zeros_like(i)
        for k, bits in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k) & 1).astype(bool)
            up_i, up_low = bits.rank(i), bits.rank(low)
            i = np.where(one, self.zeros[k] + up_i, i - up_i)
            low = np.where(one, self.zeros[k] + up_low, low - up_low)
        return i - low

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its rank there."""
        symbol, low = np.zeros_like(i), np.zeros_like(i)
        for k, bits in enumerate(self.levels):
            one = bits.get(i)
            up_i, up_low = bits.rank(i), bits.rank(low)
            i = np.where(one, self.zeros[k] + up_i, i - up_i)
            low = np.where(one, self.zeros[k] + up_low, low - up_low)
            symbol = symbol << 1 | one
        return symbol, i - low


class FmIndex:
    """Index of a sequence of ints over 0, given without its terminal 0."""

    def __init__(self, seq: np.ndarray):
        seq = np.append(seq, 0).astype(np.int64)
        sa = suffix_array(seq)
        self.n = len(seq)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(seq))])
        self.tree = WaveletTree(seq[sa - 1])
        marked = sa % SAMPLE == 0
        self.marked, self.sampled = Bits(marked), sa[marked]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row interval [low, high) of each pattern; ``patterns``: one pattern a row."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        live = np.flatnonzero((patterns < len(self.less) - 1).all(axis=1))
        high[np.setdiff1d(np.arange(len(patterns)), live)] = 0
        for k in range(patterns.shape[1] - 1, -1, -1):
            if not len(live):
                break
            c = patterns[live, k]
            low[live] = self.less[c] + self.tree.rank(c, low[live])
            high[live] = self.less[c] + self.tree.rank(c, high[live])
            live = live[high[live] > low[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to a sampled position."""
        out = np.zeros(len(rows), dtype=np.int64)
        todo, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            hit = self.marked.get(at)
            out[todo[hit]] = self.sampled[self.marked.rank(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            symbol, rank = self.tree.access(at)
            at = self.less[symbol] + rank
            steps += 1
        return out

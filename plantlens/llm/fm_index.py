"""FM-index over the word sequence of one shard of documents.

Suffixes are sorted by prefix doubling; the Burrows-Wheeler sequence is
held as a wavelet matrix of packed bits with block counts. All queries are
vectorised over many patterns or rows.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, flags: np.ndarray):
        size = len(flags)
        padded = np.zeros((size // 64 + 1) * 64, dtype=bool)
        padded[:size] = flags
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)
        self.before = np.concatenate([[0], counts[:-1]])
        self.zeros = size - int(counts[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions in suffix order. Symbol 0 separates documents; each
    separator sorts as a symbol of its own, so that no comparison runs
    beyond a document. The last symbol must be 0."""
    size = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    ranks = symbols.astype(np.int64) + len(ends)
    ranks[ends] = np.arange(len(ends))
    width = int(ranks.max()).bit_length()
    depth = max(1, 63 // width)
    padded = np.concatenate([ranks, np.zeros(depth, dtype=np.int64)])
    key = np.zeros(size, dtype=np.int64)
    for k in range(depth):
        key = (key << width) | padded[k : k + size]
    order = np.argsort(key)
    slots = np.arange(size)
    rank = np.empty(size, dtype=np.int64)
    shift = size.bit_length()
    ordered, key = order, key[order]
    while True:
        head = np.concatenate([[True], key[1:] != key[:-1]])
        first = slots[np.flatnonzero(head)][np.cumsum(head) - 1]
        rank[ordered] = first
        single = head & np.concatenate([head[1:], [True]])
        slots = slots[~single]
        if not len(slots):
            return order
        ordered = order[slots]
        key = (rank[ordered] << shift) | rank[ordered + depth]
        by_key = np.argsort(key)
        key, ordered = key[by_key], ordered[by_key]
        order[slots] = ordered
        depth *= 2


class FMIndex:
    """Backward search and location over ``symbols`` (see suffix_array)."""

    def __init__(self, symbols: np.ndarray, step: int = 8):
        order = suffix_array(symbols)
        self.size = len(symbols)
        sequence = symbols[order - 1]
        top = int(symbols.max())
        counts = np.bincount(symbols, minlength=top + 1)
        self.starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.levels: list[tuple[int, Bits]] = []
        for bit in reversed(range(max(1, top.bit_length()))):
            ones = (sequence >> bit) & 1 != 0
            self.levels.append((bit, Bits(ones)))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        # Where each symbol's run begins in the lowest level.
        self.origin = self._descend(np.zeros(top + 1, dtype=np.int64), np.arange(top + 1))
        # Sampled suffix positions: every step-th one and document starts.
        begins = np.zeros(self.size, dtype=bool)
        begins[0] = True
        begins[np.flatnonzero(symbols == 0)[:-1] + 1] = True
        sampled = begins[order] | (order % step == 0)
        self.sampled, self.samples = Bits(sampled), order[sampled]

    def _descend(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for bit, level in self.levels:
            ones = level.rank(at)
            at = np.where((symbol >> bit) & 1, level.zeros + ones, at - ones)
        return at

    def _before(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Row of the first suffix that starts with ``symbol`` followed by
        a suffix at or after ``row``."""
        return self.starts[symbol] + self._descend(row, symbol) - self.origin[symbol]

    def _step_back(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix one position earlier."""
        at, symbol = row, np.zeros(len(row), dtype=np.int64)
        for _, level in self.levels:
            bit, ones = level.get(at), level.rank(at)
            at = np.where(bit, level.zeros + ones, at - ones)
            symbol = (symbol << 1) | bit
        return self.starts[symbol] + at - self.origin[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each pattern; patterns are right-aligned rows of
        symbols."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.size, dtype=np.int64)
        width = patterns.shape[1]
        live = np.arange(len(patterns))
        for back in range(width):
            live = live[(lengths[live] > back) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = patterns[live, width - 1 - back]
            low[live] = self._before(symbol, low[live])
            high[live] = self._before(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, walked back to a sampled one."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            hit = self.sampled.get(rows)
            found[open_[hit]] = self.samples[self.sampled.rank(rows[hit])] + steps
            open_, rows, steps = open_[~hit], rows[~hit], steps + 1
            if len(open_):
                rows = self._step_back(rows)
        return found

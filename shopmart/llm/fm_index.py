"""FM-index over a sequence of symbols, in numpy: counts and locates many phrases at once."""

from __future__ import annotations

import numpy as np


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Suffix array of ``seq`` by prefix doubling; 0 is a separator, and the last symbol must be one.

    Separators sort before all symbols and among themselves by position, so
    every suffix is unique once its run has ended; a round sorts only the
    suffixes that are still tied.
    """
    n = len(seq)
    stops = np.cumsum(seq == 0)
    key = np.where(seq == 0, stops, seq + stops[-1])
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(n, bool)
    rank = np.empty(n, np.int64)
    slots, k = np.arange(n), 1
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    while True:
        head = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[order[slots]] = head
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = slots[tied]
        if not len(slots):
            return order
        at = order[slots]
        a, b = rank[at], rank[at + k]
        by = np.lexsort((b, a))
        order[slots] = at[by]
        a, b = a[by], b[by]
        new = np.ones(len(slots), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        k *= 2


class Wavelet:
    """Wavelet tree (one level per bit, highest first) with prefix counts of ones for rank queries."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.bits = range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1)
        self.ones, self.zeros = [], []
        for b in self.bits:
            bit = (seq >> b) & 1
            ones = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(seq) - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        low = np.zeros_like(at)
        for b, ones, zeros in zip(self.bits, self.ones, self.zeros):
            one = ((symbol >> b) & 1).astype(bool)
            low = np.where(one, zeros + ones[low], low - ones[low])
            at = np.where(one, zeros + ones[at], at - ones[at])
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros):
            one = ones[at + 1] > ones[at]
            symbol = symbol * 2 + one
            at = np.where(one, zeros + ones[at], at - ones[at])
        return symbol


class FMIndex:
    """``seq`` holds symbols 1 .. n_symbols - 1 in runs, each closed by a 0."""

    def __init__(self, seq: np.ndarray, n_symbols: int, every: int = 8):
        order = suffix_order(seq)
        self.n = len(seq)
        self.tree = Wavelet(seq[order - 1], n_symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=n_symbols))])
        # sampled positions: every few symbols of a run, its first one included, so that a walk never crosses a 0
        stop = np.flatnonzero(seq == 0)
        start = np.concatenate([[0], stop[:-1] + 1])
        inside = np.arange(self.n) - np.repeat(start, stop - start + 1)
        kept = (inside % every == 0)[order]
        self.kept = kept
        self.kept_before = np.cumsum(kept) - kept
        self.samples = order[kept]

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.before[symbol] + self.tree.rank(symbol, at)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``search_in`` for the rows of a 0-padded matrix."""
        return self.search_in(phrases.ravel(), phrases.shape[1] * np.arange(len(phrases)) + lengths, lengths)

    def search_in(self, symbols: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: rows [low, high) of the suffix order that begin with each phrase, symbols[end - length:end]."""
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64)
        live = np.arange(len(ends))
        for t in range(int(lengths.max(initial=0))):
            on = live[lengths[live] > t]
            symbol = symbols[ends[on] - 1 - t].astype(np.int64)
            low[on], high[on] = self.step(symbol, low[on]), self.step(symbol, high[on])
            live = live[low[live] < high[live]]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: walk back to the next sampled suffix."""
        at, walked, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            done = self.kept[at[left]]
            here = left[done]
            out[here] = self.samples[self.kept_before[at[here]]] + walked[here]
            left = left[~done]
            at[left] = self.step(self.tree.access(at[left]), at[left])
            walked[left] += 1
        return out

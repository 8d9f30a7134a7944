"""FM-index of a symbol sequence: suffix array, wavelet-tree ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; a suffix that ends is smaller than one that goes on."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-width] = rank[width:] + 1 if width < n else 0
        both = rank * (n + 1) + after
        order = np.argsort(both, kind="stable")
        fresh = np.concatenate([[0], (np.diff(both[order]) != 0).cumsum()])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        width *= 2
        if fresh[-1] == n - 1 or width >= n:
            return order


class WaveletTree:
    """Bits of each symbol from the highest on, every level stably split by the bits above, with prefix counts."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int((~bit).sum()))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        begin = np.zeros_like(before)
        for level in range(self.bits):
            one = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            ones, zeros = self.ones[level], self.zeros[level]
            before = np.where(one, zeros + ones[before], before - ones[before])
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
        return before - begin


class FMIndex:
    """Search of phrases in a sequence of symbols from 1 to `top`; 0 separates and is never searched."""

    def __init__(self, symbols: np.ndarray, top: int):
        # A last symbol 0 of its own makes every suffix end.
        text = np.concatenate([symbols, [0]]).astype(np.int64) + 1
        text[-1] = 0
        order = suffix_array(text)
        self.last = text[order - 1]
        self.tree = WaveletTree(self.last, max(1, int(top + 1).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 3))])
        self.sampled = order % SAMPLE == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]
        self.n = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of phrases (one a row): the range of suffixes that begin with each."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for at in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, at] + 1
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
            live = live[high[live] > low[live]]
            if not len(live):
                break
        found = np.zeros(len(phrases), bool)
        found[live] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: step back through the text to the nearest sampled one."""
        out = np.zeros(len(rows), np.int64)
        live, rows, steps = np.arange(len(rows)), rows.copy(), 0
        while len(live):
            known = self.sampled[rows]
            out[live[known]] = self.samples[self.sample_rank[rows[known]]] + steps
            live, rows = live[~known], rows[~known]
            symbol = self.last[rows]
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return out

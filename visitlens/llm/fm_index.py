"""An FM-index over numbers: backward search through wavelet ranks, sampled suffix positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling: groups that agree over k symbols are parted by the ranks
    of what follows; only groups still equal are sorted again. The last symbol must be the
    lowest and occur once."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)

    def ranks_of(new: np.ndarray) -> np.ndarray:
        """A group's rank is the place of its first member."""
        return np.maximum.accumulate(np.where(new, np.arange(n), 0))

    new = np.r_[True, symbols[order][1:] != symbols[order][:-1]]
    rank[order] = ranks_of(new)
    width = 1
    while not new.all():
        single = new & np.r_[new[1:], True]
        at = np.flatnonzero(~single)
        rows = order[at]
        follows = np.minimum(rows + width, n - 1)
        key = rank[rows] * np.int64(n) + rank[follows]
        part = np.argsort(key, kind="stable")
        order[at] = rows[part]
        key = key[part]
        new[at] = np.r_[True, key[1:] != key[:-1]] | new[at]
        rank[order] = ranks_of(new)
        width *= 2
    return order


class Wavelet:
    """Ranks and access over numbers, one bit per level; on each level numbers whose bit is 0
    go before the others."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros, self.ones_before = [], []
        for bit in range(self.bits - 1, -1, -1):
            ones = ((values >> bit) & 1).astype(bool)
            self.ones_before.append(np.r_[0, np.cumsum(ones)])
            self.zeros.append(int((~ones).sum()))
            values = np.r_[values[~ones], values[ones]]

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its end."""
        start = np.zeros(len(symbols), np.int64)
        end = ends
        for level in range(self.bits):
            one = ((symbols >> (self.bits - 1 - level)) & 1).astype(bool)
            before, zeros = self.ones_before[level], self.zeros[level]
            start = np.where(one, zeros + before[start], start - before[start])
            end = np.where(one, zeros + before[end], end - before[end])
        return end - start

    def at(self, places: np.ndarray) -> np.ndarray:
        """The symbols at places."""
        found = np.zeros(len(places), np.int64)
        for level in range(self.bits):
            before, zeros = self.ones_before[level], self.zeros[level]
            one = before[places + 1] > before[places]
            found = (found << 1) | one
            places = np.where(one, zeros + before[places], places - before[places])
        return found


class FMIndex:
    """``symbols`` must be 1 or more; 0 is put at the end."""

    def __init__(self, symbols: np.ndarray):
        text = np.r_[symbols.astype(np.int64), 0]
        order = suffix_array(text)
        last = text[order - 1]
        self.wavelet = Wavelet(last)
        counts = np.bincount(text)
        self.before = np.cumsum(counts) - counts
        sampled = order % SAMPLE == 0
        self.sampled_before = np.r_[0, np.cumsum(sampled)]
        self.samples = order[sampled]
        self.size = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of suffixes that begin with each phrase. Phrases are rows that
        end at the last column, with 0 before the first symbol."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, column]
            more = symbol > 0
            known = more & (symbol < len(self.before))
            low[live[more & ~known]] = high[live[more & ~known]] = 0
            go, symbol = live[known], symbol[known]
            low[go] = self.before[symbol] + self.wavelet.rank(symbol, low[go])
            high[go] = self.before[symbol] + self.wavelet.rank(symbol, high[go])
            live = go[low[go] < high[go]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of rows start: walk back to a sampled one and add the steps."""
        found = np.empty(len(rows), np.int64)
        at, waiting, steps = rows.copy(), np.arange(len(rows)), 0
        while len(waiting):
            hit = self.sampled_before[at + 1] > self.sampled_before[at]
            found[waiting[hit]] = self.samples[self.sampled_before[at[hit]]] + steps
            at, waiting = at[~hit], waiting[~hit]
            symbol = self.wavelet.at(at)
            at = self.before[symbol] + self.wavelet.rank(symbol, at)
            steps += 1
        return found

"""FM-index over a sequence of small integers, in numpy.

The sequence holds runs of symbols 1, 2, ...; a 0 ends each run. Suffixes are
compared up to the end of their run, and ends of runs rank by place, so the
order is total and the LF mapping exact. Ranks over the Burrows-Wheeler
transform come from a wavelet matrix of packed bits. Every ``rate``-th place
and every start of a run keeps its suffix position; other places are found by
walking LF to one of those. All searches run on arrays of phrases at once.
"""

from __future__ import annotations

import numpy as np

#: Ranks and places of a sequence this long fit three times into 63 bits; then a plain sort orders them.
PACKED = 1 << 21


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order of a 0-terminated sequence, by prefix doubling over the groups not yet resolved."""
    n = len(text)
    ends = np.flatnonzero(text == 0)
    counts = np.bincount(text)
    rank = (np.cumsum(counts) - counts)[text]
    rank[ends] = np.arange(len(ends))
    open_ = np.flatnonzero((text > 0) & (counts[text] > 1))
    step = 1
    while len(open_):
        first, second = rank[open_], rank[open_ + step]
        if n <= PACKED:
            packed = np.sort((first << 42) | (second << 21) | np.arange(len(open_)))
            order = packed & (PACKED - 1)
            pair = packed >> 21
        else:
            order = np.lexsort((second, first))
            pair = first[order] * np.int64(n) + second[order]
        first = first[order]
        place = np.arange(len(order))
        new_old = np.append(True, first[1:] != first[:-1])
        new = np.append(True, pair[1:] != pair[:-1])
        old_start = np.maximum.accumulate(np.where(new_old, place, 0))
        start = np.maximum.accumulate(np.where(new, place, 0))
        members = open_[order]
        rank[members] = first + (start - old_start)
        alone = new & np.append(new[1:], True)
        open_ = np.sort(members[~alone])
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Symbols by their bits, highest first; each level sorts stably by its bit."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(max(1, int(largest).bit_length()))):
            ones = (symbols >> bit) & 1 == 1
            self.levels.append((bit, Bits(ones), int(len(symbols) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low, high = np.zeros_like(at), at
        for bit, bits, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            low_ones, high_ones = bits.rank(low), bits.rank(high)
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return high - low


class FMIndex:
    """Index of ``text``: runs of symbols from 1 to ``largest``, each ended by a 0."""

    def __init__(self, text: np.ndarray, largest: int, rate: int = 16):
        order = suffix_array(text)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])
        before = np.where(order > 0, text[order - 1], 0)
        self.transform = before
        self.ranks = WaveletMatrix(before, largest)
        kept = (before == 0) | (order % rate == 0)
        self.kept = Bits(kept)
        self.is_kept = kept
        self.places = order[kept]

    def count(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases, given as rows of symbols that end at the last column; empty ranges for those that don't occur."""
        low, high = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        live = np.flatnonzero(lengths > 0)
        last = phrases[live, -1]
        low[live], high[live] = self.smaller[last], self.smaller[last + 1]
        for back in range(2, phrases.shape[1] + 1):
            live = live[low[live] < high[live]]
            longer = live[lengths[live] >= back]
            if not len(longer):
                break
            symbol = phrases[longer, -back]
            both = self.ranks.rank(np.concatenate([symbol, symbol]), np.concatenate([low[longer], high[longer]]))
            low[longer] = self.smaller[symbol] + both[: len(longer)]
            high[longer] = self.smaller[symbol] + both[len(longer) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place in the sequence at which each row's suffix starts."""
        out = np.empty(len(rows), dtype=np.int64)
        left, now, steps = np.arange(len(rows)), rows, 0
        while len(left):
            there = self.is_kept[now]
            out[left[there]] = self.places[self.kept.rank(now[there])] + steps
            left, now = left[~there], now[~there]
            symbol = self.transform[now]
            now = self.smaller[symbol] + self.ranks.rank(symbol, now)
            steps += 1
        return out

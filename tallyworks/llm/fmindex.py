"""An FM-index over a sequence of word numbers: wavelet-tree ranks and sampled positions."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling."""
    size = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        following = np.zeros(size, dtype=np.int64)
        following[: max(0, size - step)] = rank[step:] + 1
        keys = rank * (size + 1) + following
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        fresh = np.concatenate(([False], ordered[1:] != ordered[:-1]))
        rank = np.empty(size, dtype=np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == size - 1:
            return order
        step *= 2


class WaveletTree:
    """Ranks of any symbol in a sequence, one bit plane for each bit of the symbols.

    Each plane orders the sequence by its bit, zeros first and otherwise as before
    (the pointerless form of the tree). Ranks come from running counts of ones.
    """

    def __init__(self, symbols: np.ndarray, planes: int):
        self.shifts = range(planes - 1, -1, -1)
        self.bits: list[np.ndarray] = []
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for shift in self.shifts:
            bit = (symbols >> shift & 1).astype(bool)
            self.bits.append(bit)
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(len(bit) - int(self.ones[-1][-1]))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        start = np.zeros_like(end)
        for shift, ones, zeros in zip(self.shifts, self.ones, self.zeros, strict=True):
            one = (symbol >> shift & 1).astype(bool)
            start = np.where(one, zeros + ones[start], start - ones[start])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - start

    def at(self, place: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        symbol = np.zeros(len(place), dtype=np.int64)
        for bits, ones, zeros in zip(self.bits, self.ones, self.zeros, strict=True):
            one = bits[place]
            symbol = symbol << 1 | one
            place = np.where(one, zeros + ones[place], place - ones[place])
        return symbol


class FMIndex:
    """Backward search over symbols 1 … ``top``; symbol 0 is the end of the sequence."""

    def __init__(self, symbols: np.ndarray, top: int, sample: int = 8):
        text = np.concatenate((symbols, [0])).astype(np.int64)
        order = suffix_order(text)
        last = text[order - 1]
        self.size = len(text)
        self.tree = WaveletTree(last, max(1, int(top).bit_length()))
        counts = np.bincount(text, minlength=top + 1)
        self.before = np.concatenate(([0], np.cumsum(counts)))
        sampled = order % sample == 0
        self.sampled = sampled
        self.sample_rank = np.concatenate(([0], np.cumsum(sampled)))
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [start, end) of each phrase; rows of ``phrases`` are padded on the left."""
        start = np.zeros(len(phrases), dtype=np.int64)
        end = np.full(len(phrases), self.size, dtype=np.int64)
        width = phrases.shape[1]
        for back in range(width):
            live = np.flatnonzero((lengths > back) & (start < end))
            if not live.size:
                break
            symbol = phrases[live, width - 1 - back]
            start[live] = self.before[symbol] + self.tree.rank(symbol, start[live])
            end[live] = self.before[symbol] + self.tree.rank(symbol, end[live])
        return start, np.maximum(start, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row: step back to a sampled suffix and count the steps."""
        position = np.empty(len(rows), dtype=np.int64)
        walking, row, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while walking.size:
            done = self.sampled[row]
            position[walking[done]] = self.samples[self.sample_rank[row[done]]] + steps
            walking, row = walking[~done], row[~done]
            symbol = self.tree.at(row)
            row = self.before[symbol] + self.tree.rank(symbol, row)
            steps += 1
        return position

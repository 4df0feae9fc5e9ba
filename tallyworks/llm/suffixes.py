"""Suffix arrays by induced sorting, and common prefixes in text order."""

from __future__ import annotations

import numpy as np

from tallyworks.llm.fmindex import suffix_order

# Texts with at most so many different symbols are sorted by inducing, a bucket at a time.
BUCKETED = 1_024


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last symbol is the unique smallest one."""
    size = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    following = differs[np.searchsorted(differs, np.arange(size - 1))]
    smaller = np.ones(size, dtype=bool)
    smaller[:-1] = text[following] < text[following + 1]
    return smaller


class Buckets:
    """Suffixes placed by first symbol, from the front or from the back of their buckets."""

    def __init__(self, text: np.ndarray, sizes: np.ndarray):
        self.text, self.sizes = text, sizes
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.order = np.full(len(text), -1, dtype=np.int64)

    def grouped(self, suffixes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes by symbol in stable order, their symbols, places in the group, and counts."""
        symbols = self.text[suffixes]
        by_symbol = np.argsort(symbols, kind="stable")
        symbols = symbols[by_symbol]
        counts = np.bincount(symbols, minlength=len(self.sizes))
        places = np.arange(len(symbols)) - (np.cumsum(counts) - counts)[symbols]
        return suffixes[by_symbol], symbols, places, counts

    def append(self, suffixes: np.ndarray, heads: np.ndarray) -> None:
        suffixes, symbols, places, counts = self.grouped(suffixes)
        self.order[heads[symbols] + places] = suffixes
        heads += counts

    def prepend(self, suffixes: np.ndarray, tails: np.ndarray) -> None:
        suffixes, symbols, places, counts = self.grouped(suffixes)
        self.order[tails[symbols] - 1 - places] = suffixes
        tails -= counts


def induce_buckets(
    text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, sizes: np.ndarray
) -> np.ndarray:
    """Order of all suffixes from that of the leftmost smaller ones, whole buckets at a time."""
    buckets = Buckets(text, sizes)
    order, starts, ends = buckets.order, buckets.starts, buckets.ends
    tails = ends.copy()
    buckets.prepend(leftmost[::-1], tails)
    heads = starts.copy()

    def before(suffixes: np.ndarray, kind: bool) -> np.ndarray:
        previous = suffixes[suffixes > 0] - 1
        return previous[smaller[previous] == kind]

    present = np.flatnonzero(sizes).tolist()
    for symbol in present:
        done = starts[symbol]
        while done < heads[symbol]:
            done, chunk = heads[symbol], order[done : heads[symbol]]
            buckets.append(before(chunk, False), heads)
        buckets.append(before(order[tails[symbol] : ends[symbol]], False), heads)
    tails = ends.copy()
    tails[text[-1]] -= 1
    order[tails[text[-1]]] = len(text) - 1
    for symbol in reversed(present):
        done = ends[symbol]
        while done > tails[symbol]:
            done, chunk = tails[symbol], order[tails[symbol] : done]
            buckets.prepend(before(chunk[::-1], True), tails)
        buckets.prepend(before(order[starts[symbol] : heads[symbol]][::-1], True), tails)
    return order


def named(text: np.ndarray, leftmost: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """The leftmost smaller substrings in text order, as ranks; equal ones have equal ranks."""
    size = np.empty(len(text), dtype=np.int64)
    size[leftmost] = np.append(np.diff(leftmost), 0) + 1
    left, right = ordered[:-1], ordered[1:]
    same = size[left] == size[right]
    pending = np.flatnonzero(same)
    offset = 0
    while len(pending):
        equal = text[left[pending] + offset] == text[right[pending] + offset]
        same[pending[~equal]] = False
        offset += 1
        pending = pending[equal & (size[left[pending]] > offset)]
    ranks = np.empty(len(text), dtype=np.int64)
    ranks[ordered] = np.concatenate(([0], np.cumsum(~same)))
    return ranks[leftmost], int(ranks[ordered[-1]]) + 1


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of all suffixes of ``text`` in order.

    ``text`` holds numbers below ``symbols`` and ends with its only zero. Suffixes are
    either smaller or larger than the one that follows. The leftmost of each run of
    smaller ones cut the text into substrings; inducing sorts these, their ranks form a
    shorter text that is sorted in turn, and its order induces that of all suffixes. A
    shorter text of few names is sorted by inducing again, one of many names by pairs of its
    substrings, pairs of pairs and so on: inducing goes by bucket, and there would be too many.
    """
    if len(text) == 1:
        return np.zeros(1, dtype=np.int64)
    smaller = smaller_types(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    sizes = np.bincount(text, minlength=symbols)
    rough = induce_buckets(text, smaller, leftmost, sizes)
    starts = np.zeros(len(text), dtype=bool)
    starts[leftmost] = True
    shorter, names = named(text, leftmost, rough[starts[rough]])
    if names == len(leftmost):
        by_name = np.argsort(shorter)
    elif names <= BUCKETED:
        by_name = suffix_array(shorter, names)
    else:
        by_name = suffix_order(shorter)
    return induce_buckets(text, smaller, leftmost[by_name], sizes)


def predecessors(order: np.ndarray) -> np.ndarray:
    """For every suffix the one before it in order, -1 for the first."""
    before = np.empty(len(order), dtype=np.int64)
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    return before


def permuted_prefixes(text: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Length of the prefix that each suffix, in text order, shares with its predecessor.

    Where the symbols before both suffixes are equal, it is one less than the
    length a place earlier; only the other suffixes are compared. ``text`` has 16-bit symbols.
    """
    size = len(text)
    padded = np.concatenate((text, np.zeros(4, text.dtype))).astype(np.uint64)
    quads = padded[:size] | padded[1 : size + 1] << 16 | padded[2 : size + 2] << 32 | padded[3 : size + 3] << 48
    compared = before <= 0
    compared[0] = True
    rest = np.flatnonzero(~compared)
    compared[rest] = text[rest - 1] != text[before[rest] - 1]
    compared &= before >= 0
    left = np.flatnonzero(compared)
    right = before[left]
    shared = np.zeros(len(left), dtype=np.int64)
    active = np.arange(len(left))
    while len(active):
        equal = quads[left[active] + shared[active]] == quads[right[active] + shared[active]]
        active = active[equal]
        shared[active] += 4
    active = np.arange(len(left))
    for _ in range(3):
        equal = text[left[active] + shared[active]] == text[right[active] + shared[active]]
        active = active[equal]
        shared[active] += 1
    reach = np.zeros(size, dtype=np.int64)
    reach[left] = left + shared
    return np.maximum(np.maximum.accumulate(reach) - np.arange(size), 0) * (before >= 0)

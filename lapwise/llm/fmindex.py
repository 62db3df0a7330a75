"""FM-index of a sequence of word numbers: suffix order, wavelet-tree ranks, sampled positions."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; a 0 is a separator that no other suffix equals.

    Ranks by the first 1, 2, 4, ... symbols; only suffixes that still share a rank
    are sorted again.
    """
    size = len(symbols)
    gaps = symbols == 0
    rank = symbols.astype(np.int64) + int(gaps.sum())
    rank[gaps] = np.arange(int(gaps.sum()))
    order = np.argsort(rank, kind="stable")
    sorted_rank = rank[order]
    heads = np.flatnonzero(np.r_[True, sorted_rank[1:] != sorted_rank[:-1]])
    sizes = np.diff(np.r_[heads, size])
    rank[order] = np.repeat(heads, sizes)
    open_places = np.flatnonzero(np.repeat(sizes, sizes) > 1)
    step = 1
    while len(open_places):
        members = order[open_places]
        ahead = members + step
        second = np.where(ahead < size, rank[np.minimum(ahead, size - 1)], -1)
        first = rank[members]
        turn = np.lexsort((second, first))
        members, first, second = members[turn], first[turn], second[turn]
        order[open_places] = members
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        starts = np.flatnonzero(new)
        runs = np.diff(np.r_[starts, len(members)])
        rank[members] = np.repeat(open_places[starts], runs)
        open_places = open_places[np.repeat(runs, runs) > 1]
        step *= 2
    return order


class Bits:
    """A bit vector with ranks: packed words and the number of ones before each word."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(len(bits) // 64 * 64 + 64, np.uint8)
        padded[: len(bits)] = bits
        self._words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self._words).astype(np.int64)
        self._before = np.cumsum(ones) - ones
        self.ones = int(ones.sum())

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = places >> 6
        mask = (_ONE << (places & 63).astype(np.uint64)) - _ONE
        return self._before[word] + np.bitwise_count(self._words[word] & mask)

    def get(self, places: np.ndarray) -> np.ndarray:
        return (self._words[places >> 6] >> (places & 63).astype(np.uint64)) & _ONE == 1


class WaveletTree:
    """Ranks of any symbol, one bit vector for each bit of the alphabet, highest bit first."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self._levels: list[tuple[int, Bits, int]] = []
        now = symbols
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bits = (now >> shift) & 1 == 1
            self._levels.append((shift, Bits(bits), int(len(bits) - bits.sum())))
            now = np.concatenate([now[~bits], now[bits]])

    def rank(self, symbol: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often `symbol` stands before each place."""
        low, high = np.zeros_like(places), places
        for shift, bits, zeros in self._levels:
            one = (symbol >> shift) & 1 == 1
            left, right = bits.rank(low), bits.rank(high)
            low = np.where(one, zeros + left, low - left)
            high = np.where(one, zeros + right, high - right)
        return high - low

    def get(self, places: np.ndarray) -> np.ndarray:
        out = np.zeros_like(places)
        for shift, bits, zeros in self._levels:
            one = bits.get(places)
            out |= one.astype(out.dtype) << shift
            ones = bits.rank(places)
            places = np.where(one, zeros + ones, places - ones)
        return out


class FMIndex:
    """Counts and positions of phrases in a sequence of symbols from 1 to `largest`; 0 separates."""

    def __init__(self, symbols: np.ndarray, largest: int, sample: int = 8) -> None:
        order = suffix_order(symbols)
        self.size = len(symbols)
        self._tree = WaveletTree(symbols[order - 1], largest)
        self._below = np.zeros(largest + 2, np.int64)
        np.cumsum(np.bincount(symbols, minlength=largest + 1), out=self._below[1:])
        # every `sample`-th position, and the first behind each separator, where walks back end
        kept = (order % sample == 0) | (symbols[order - 1] == 0)
        self._sampled, self._positions = Bits(kept), order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last suffix place of each phrase (rows, left-aligned)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - back]
            low[live] = self._below[symbol] + self._tree.rank(symbol, low[live])
            high[live] = self._below[symbol] + self._tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Positions of suffix places: walk back to a sampled one and add the steps."""
        out = np.zeros(len(places), np.int64)
        going, now, steps = np.arange(len(places)), places.copy(), 0
        while len(going):
            done = self._sampled.get(now)
            out[going[done]] = self._positions[self._sampled.rank(now[done])] + steps
            going, now = going[~done], now[~done]
            symbol = self._tree.get(now)
            now = self._below[symbol] + self._tree.rank(symbol, now)
            steps += 1
        return out

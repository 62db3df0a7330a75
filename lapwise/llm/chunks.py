"""Texts cut at single blanks into chunks, whose tokens are learned once and gathered by number."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from lapwise.llm.common import PrefixHash, mix

#: Chunks learned at once.
LEARNED = 8192
#: Added to the hash of a text's first chunk, which no blank precedes.
_FIRST = np.uint64(0xA5B35705F0C3A7D1)
# White space other than blanks and line ends, by its UTF-8 bytes.
_ODD = np.zeros(256, np.bool_)
_ODD[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_ODD_TWO = (0xC285, 0xC2A0)
_ODD_THREE = (0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080)


class Lot:
    """The chunks of some texts: what stands between blanks.

    `odd` tells the texts in which white space other than single blanks and line ends
    could join what blanks part; they are not cut well and have to be taken whole.
    """

    def __init__(self, texts: Sequence[bytes], blank_first: bool) -> None:
        self.raw = b" " + b" ".join(texts)
        data = np.frombuffer(self.raw, np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        blanks = np.flatnonzero(data == 0x20)
        self.opens = blanks + 1
        self.closes = np.r_[blanks[1:], len(data)]
        self.starts = np.searchsorted(blanks, np.r_[0, ends])  # the first chunk of each text, and the end
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.starts))
        self.keys = PrefixHash(data).between(self.opens, self.closes)
        if not blank_first:
            self.keys[self.starts[:-1]] = mix(self.keys[self.starts[:-1]] + _FIRST)
        self.odd = np.zeros(len(texts), np.bool_)
        empty = self.opens == self.closes
        led = np.r_[data, 0][self.opens] == 0x0A
        self.odd[self.owner[(empty | led) & (np.diff(self.starts)[self.owner] > 1)]] = True
        self.odd[self.owner[led]] = True
        places = [np.flatnonzero(_ODD[data])]
        lead = np.flatnonzero((data == 0xC2) | (data >= 0xE1) & (data <= 0xE3))
        wide = np.r_[data, np.zeros(2, np.uint8)].astype(np.uint32)
        two = wide[lead] << np.uint32(8) | wide[lead + 1]
        places += [lead[np.isin(two, _ODD_TWO)], lead[np.isin(two << np.uint32(8) | wide[lead + 2], _ODD_THREE)]]
        self.odd[np.searchsorted(ends, np.concatenate(places), side="right")] = True

    def text(self, chunk: int) -> str:
        return self.raw[self.opens[chunk] : self.closes[chunk]].decode()


class Numbers:
    """A number for each chunk met so far, by its 64-bit hash; what belongs to a number is kept by the user.

    `learn` gets the chunks that are new, in the order of their numbers, and whether
    each stands first in its text, in lots that keep what it needs small. `room` is
    called where no number is in use: beyond `most` chunks all are forgotten.
    """

    def __init__(self, most: int, learn: Callable[[list[str], list[bool]], None], forget: Callable[[], None]) -> None:
        self._most, self._learn, self._forget = most, learn, forget
        self._keys, self._numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def room(self) -> None:
        if len(self._keys) > self._most:
            self._keys, self._numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            self._forget()

    def of(self, lot: Lot, chosen: np.ndarray) -> np.ndarray:
        """Numbers of the chosen chunks of a lot."""
        keys, at, back = np.unique(lot.keys[chosen], return_index=True, return_inverse=True)
        place = np.searchsorted(self._keys, keys)
        known = np.zeros(len(keys), np.bool_)
        inside = place < len(self._keys)
        known[inside] = self._keys[place[inside]] == keys[inside]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            for some in np.array_split(chosen[at[fresh]], -(-len(fresh) // LEARNED)):
                self._learn([lot.text(c) for c in some.tolist()], (lot.starts[lot.owner[some]] == some).tolist())
            self._numbers = np.insert(self._numbers, place[fresh], len(self._keys) + np.arange(len(fresh)))
            self._keys = np.insert(self._keys, place[fresh], keys[fresh])
            place = np.searchsorted(self._keys, keys)
        return self._numbers[place][back]


class Rows:
    """Arrays of different lengths one after the other, found by number."""

    def __init__(self, kind: type) -> None:
        self.values, self.starts = np.zeros(0, kind), np.zeros(1, np.int64)

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.r_[self.starts, self.starts[-1] + np.cumsum(sizes)]
        self.values = np.concatenate([self.values, values])

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        return self.starts[numbers + 1] - self.starts[numbers]

    def take(self, numbers: np.ndarray) -> np.ndarray:
        """The arrays of these numbers, joined."""
        sizes = self.sizes(numbers)
        shift = self.starts[numbers] - (np.cumsum(sizes) - sizes)
        return self.values[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]

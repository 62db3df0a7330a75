"""Word shingles of texts as hashes, with counts, for many texts at once."""

from __future__ import annotations

import numpy as np

from lapwise.llm.common import PrefixHash, joined, lowered, mix, word_bounds

_STEP = np.uint64(0x9FB21C651E98DF25)


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of the distinct shingles of each text, in order of text and hash.

    A shingle is `words` consecutive words; a text of fewer, but not none, is one shingle.
    """
    data, starts = joined(texts)
    data = lowered(data)
    opens, closes, counts = word_bounds(data, starts)
    if not len(opens):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = PrefixHash(data).between(opens, closes)
    ends = np.cumsum(counts)
    width = np.minimum(counts, words)
    room = np.repeat(ends, counts) - np.arange(len(hashes))  # words from here to the text's end
    first = np.flatnonzero(room >= np.repeat(width, counts))
    owner = np.repeat(np.arange(len(counts)), counts)[first]
    total = np.zeros(len(first), np.uint64)
    for place in range(words):
        live = place < width[owner]
        if live.all():
            total = (total + hashes[first + place]) * _STEP
        else:
            total[live] = (total[live] + hashes[first[live] + place]) * _STEP
    total = mix(total)
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    heads = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (total[1:] != total[:-1])])
    return owner[heads], total[heads], np.diff(np.r_[heads, len(total)])

"""Places on a Hilbert curve through a grid, for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of each row of grid coordinates (`bits` bits each, at most 62 bits together).

    The transposed form is made by undoing the rotations of the curve bit by bit,
    then Gray-coded; the bits of the axes are interleaved, highest first.
    """
    x = cells.astype(np.int64).copy()
    axes = x.shape[1]
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for axis in range(axes):
            high = (x[:, axis] & level) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, axis] ^= swap
        level >>= 1
    for axis in range(1, axes):
        x[:, axis] ^= x[:, axis - 1]
    turn = np.zeros(len(x), np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where(x[:, axes - 1] & level, level - 1, 0)
        level >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(axes):
            key = key << 1 | (x[:, axis] >> bit & 1)
    return key

"""Hilbert curves through grids of any number of dimensions."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions of integer grid cells (one row each) on the Hilbert curve: Gray-code transform of the axes, then interleaving."""
    x = cells.astype(np.int64).copy()
    n, d = x.shape
    for level in range(bits - 1, 0, -1):
        bit, mask = 1 << level, (1 << level) - 1
        for i in range(d):
            turned = (x[:, i] & bit) != 0
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, i]) & mask)
            x[:, 0] ^= np.where(turned, mask, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, d - 1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[:, i] >> level) & 1)
    return key

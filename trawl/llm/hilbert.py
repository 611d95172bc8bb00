"""Places of grid cells along a Hilbert curve of any number of dimensions, for many cells at once."""

from __future__ import annotations

import numpy as np


def curve_keys(cells: np.ndarray, bits: int) -> list[bytes]:
    """The place of each cell along the curve, as big-endian bytes that sort in its order.

    ``cells`` has a row per cell and a column per dimension, whole numbers below ``2 ** bits``.
    Level by level, from the coarsest, a cell's orthant tells how the axes below it are reflected
    and swapped (Skilling, 2004); undoing that leaves bits which, read across dimensions, are the
    Gray code of the place.
    """
    n, dims = cells.shape
    if not n or not dims:
        return [b""] * n
    axes = [cells[:, i].astype(np.int64) for i in range(dims)]
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i in range(dims):
            set_here = (axes[i] >> level) & 1 == 1
            swapped = np.where(set_here, 0, (axes[0] ^ axes[i]) & below)
            axes[0] = axes[0] ^ np.where(set_here, below, swapped)
            axes[i] = axes[i] ^ swapped
    for i in range(1, dims):
        axes[i] = axes[i] ^ axes[i - 1]
    flips = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    code = np.stack([axis ^ flips for axis in axes], axis=1)
    digits = [(code >> level) & 1 for level in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(digits, axis=1).astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]

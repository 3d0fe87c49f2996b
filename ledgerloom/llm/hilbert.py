"""Places of points along a Hilbert curve, for whole arrays of points at a time."""

from __future__ import annotations

import numpy as np

#: Coordinates that take part; wider points are folded to so many sums.
AXES = 8


def _grid(points: np.ndarray, bits: int) -> np.ndarray:
    """Every coordinate as a number of ``bits`` bits, spread over its own range."""
    low, high = points.min(axis=0), points.max(axis=0)
    span = np.maximum(high - low, 1)
    return np.minimum((points - low) * (1 << bits) // (span + 1), (1 << bits) - 1).astype(np.uint64)


def hilbert_order(points: np.ndarray) -> np.ndarray:
    """The rows of an integer matrix in the order in which a Hilbert curve meets them.

    Coordinates are gray-coded axis by axis: from the highest bit on, an axis
    whose bit is set inverts the lower bits of the first axis, one whose bit is
    not set exchanges them with it. The transposed bits are the place.
    """
    n, width = points.shape
    if not width or n < 2:
        return np.arange(n)
    if width > AXES:
        points = np.add.reduceat(points, np.arange(AXES) * width // AXES, axis=1)
    axes = points.shape[1]
    bits = min(10, 63 // axes)
    x = np.ascontiguousarray(_grid(points, bits).T)
    for b in range(bits - 1, 0, -1):
        low = np.uint64((1 << b) - 1)
        for i in range(axes):
            on = (x[i] >> np.uint64(b)) & np.uint64(1) > 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros(n, np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> np.uint64(b)) & np.uint64(1) > 0, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn
    place = np.zeros(n, np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            place = (place << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return np.argsort(place, kind="stable")

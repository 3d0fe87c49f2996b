"""Sets of word shingles as 64-bit hashes, for whole batches of texts at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from ledgerloom.llm.common import GOLDEN, mix

SIZE = 5
#: Longer input is hashed piece by piece, cut at spaces, so that memory stays bounded.
PIECE_BYTES = 4 << 20
_BASE = GOLDEN | np.uint64(1)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUE = _BYTES[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_PLACES = mix(np.arange(1001, 1001 + SIZE, dtype=np.uint64)) | np.uint64(1)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, b)])) for b in (_BASE, inverse))


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (lower-cased in A-Z) and the number of words of each row."""
    space = _SPACE[data]
    if len(data) > PIECE_BYTES:
        cuts, found, counts = [0], [], np.zeros(len(at) - 1, np.int64)
        while cuts[-1] < len(data):
            near = cuts[-1] + PIECE_BYTES
            ahead = np.flatnonzero(space[near : near + PIECE_BYTES])
            cuts.append(min(len(data), near + int(ahead[0]) if len(ahead) else _next_space(space, near)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own, n = _words(data[a:b], np.clip(at, a, b) - a, space[a:b])
            found.append(own)
            counts += n
        return np.concatenate(found), counts
    return _words(data, at, space)


def _next_space(space: np.ndarray, start: int) -> int:
    ahead = np.flatnonzero(space[start:])
    return start + int(ahead[0]) if len(ahead) else len(space)


def _words(data: np.ndarray, at: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    inner = at[:-1][np.diff(at) > 0]
    before[inner] = True
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    after[inner[1:] - 1] = True
    start, end = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    up, down = _powers(1 << max(20, int(len(data)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[data] * up[: len(data)])])
    hashes = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(start, at))


def shingle_sets(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row: five words, or all if there are fewer; none without words."""
    w, counts = words(data, at)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = max(0, len(w) - SIZE + 1)
    total = np.zeros(n, np.uint64)
    for j in range(SIZE):
        total += w[j : j + n] * _PLACES[j]
    five = mix(total)
    out = []
    for i, c in enumerate(counts.tolist()):
        a = first[i]
        if c >= SIZE:
            out.append(np.unique(five[a : a + c - SIZE + 1]))
        elif c:
            out.append(mix(np.array([(w[a : a + c] * _PLACES[:c]).sum() + np.uint64(c)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name a set, as signed longs."""
    pair = np.array([mix(own).sum(dtype=np.uint64), mix(own ^ GOLDEN).sum(dtype=np.uint64)], np.uint64)
    return tuple(mix(pair + np.uint64(len(own))).view(np.int64).tolist())


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0

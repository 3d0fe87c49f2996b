"""Counts of word sequences as acyclic automata.

A path is a sequence of at most ``width`` labels, 0 marks its end before that.
Paths come in order; each one shares the states of the path before it up to the
first label that differs and adds states for the rest, so the automaton is built
by one look at neighbouring paths. A state's weight is the sum over the paths
through it, that is, the count of the sequence that leads to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Paths = tuple[np.ndarray, np.ndarray]


def sorted_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and for each given word its place there, from 1 on."""
    held = words.dictionary_encode()
    order = pc.array_sort_indices(held.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(1, len(order) + 1)
    return held.dictionary.take(pa.array(order)), place[held.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)


def keys(paths: np.ndarray, top: int) -> list[np.ndarray]:
    """The labels (``top`` at most) of each path in as few 64-bit numbers as hold them, first ones first."""
    bits = max(1, int(top).bit_length())
    per, out = 64 // bits, []
    for start in range(0, paths.shape[1], per):
        key = np.zeros(len(paths), np.uint64)
        for column in paths[:, start : start + per].T:
            key = (key << np.uint64(bits)) | column.astype(np.uint64)
        out.append(key)
    return out


def in_order(found: list[np.ndarray]) -> np.ndarray:
    return np.argsort(found[0], kind="stable") if len(found) == 1 else np.lexsort(found[::-1])


def summed(paths: np.ndarray, counts: np.ndarray, top: int) -> Paths:
    """Distinct paths in order with the sum of their counts."""
    if not len(paths):
        return paths, counts
    found = keys(paths, top)
    order = in_order(found)
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in found:
        own = key[order]
        new[1:] |= own[1:] != own[:-1]
    at = np.flatnonzero(new)
    return paths[order[at]], np.add.reduceat(counts[order], at)


def shared(paths: np.ndarray) -> np.ndarray:
    """How many states each path shares with the one before it."""
    out = np.zeros(len(paths), np.uint8)
    if len(paths) > 1:
        out[1:] = (paths[1:] != paths[:-1]).argmax(axis=1)
    return out


def _narrow(values: np.ndarray) -> np.ndarray:
    most = int(values.max()) if len(values) else 0
    return values.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")


def written(words: pa.Array, paths: np.ndarray, counts: np.ndarray) -> bytes:
    """An automaton as bytes: the words it uses, then per path the labels that it does not share."""
    used = np.unique(paths)
    used = used[used > 0]
    place = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.int64)
    place[used] = np.arange(1, len(used) + 1)
    paths = place[paths]
    own = words.take(pa.array(used - 1)).cast(pa.binary())
    depth = shared(paths)
    parts = [b" ".join(own.to_pylist()), depth.tobytes(), _narrow(counts)]
    before = np.ones(len(paths), bool)
    for k in range(paths.shape[1]):
        # A path that has ended stores nothing more.
        parts.append(_narrow(paths[(depth <= k) & before, k]))
        before = before & (paths[:, k] > 0)
    head = [len(paths), paths.shape[1]]
    body = []
    for p in parts:
        data = p if isinstance(p, bytes) else p.tobytes()
        head += [len(data), 1 if isinstance(p, bytes) else p.itemsize]
        body.append(data)
    return np.array(head, "<i8").tobytes() + b"".join(body)


def read(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, paths and counts of :func:`written`."""
    n, width = np.frombuffer(data, "<i8", 2).tolist()
    sizes = np.frombuffer(data, "<i8", 2 * (width + 3), 16).reshape(-1, 2).tolist()
    at, parts = 16 + 16 * (width + 3), []
    for size, item in sizes:
        parts.append(np.frombuffer(data, f"<u{item}", size // item, at))
        at += size
    words = parts[0].tobytes().split(b" ") if len(parts[0]) else []
    depth, counts = parts[1], parts[2].astype(np.int64)
    paths, before, rows = np.zeros((n, width), np.int64), np.ones(n, bool), np.arange(n)
    for k in range(width):
        new = depth <= k
        paths[new & before, k] = parts[3 + k]
        last = np.maximum.accumulate(np.where(new, rows, 0)) if n else rows
        paths[:, k] = paths[last, k]
        before = before & (paths[:, k] > 0)
    return words, paths, counts


def union(several: list[tuple[list[bytes], np.ndarray, np.ndarray]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """One automaton that gives every path the sum of its weights."""
    words, place = sorted_words(pa.array([w for own, _, _ in several for w in own], pa.binary()))
    moved, start = [], 0
    for own, paths, _ in several:
        moved.append(np.concatenate([[0], place[start : start + len(own)]])[paths])
        start += len(own)
    paths, counts = summed(np.concatenate(moved), np.concatenate([c for _, _, c in several]), len(words))
    return words, paths, counts


def states(paths: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all states ``length`` labels deep: a path through each, its weight, and whether it is the first or last one."""
    new = np.ones(len(paths), bool)
    new[1:] = shared(paths)[1:] < length
    at = np.flatnonzero(new)
    weight = np.add.reduceat(counts, at) if len(at) else counts
    edge = np.zeros(len(at), bool)
    edge[[0, -1] if len(at) else []] = True
    real = paths[at, length - 1] > 0
    return paths[at[real], :length], weight[real], edge[real]


class Lookup:
    """An automaton to walk along: per depth the edges (state, label) in order."""

    def __init__(self, paths: np.ndarray, counts: np.ndarray, top: int) -> None:
        self.top, self.weights = top + 1, counts
        self.edges, state = [], np.zeros(len(paths), np.int64)
        depth = shared(paths)
        for k in range(paths.shape[1]):
            new = np.ones(len(paths), bool)
            new[1:] = depth[1:] <= k
            self.edges.append((state * self.top + paths[:, k])[new])
            state = np.cumsum(new) - 1

    def walk(self, asked: np.ndarray) -> np.ndarray:
        """Weights of the asked paths; 0 where the automaton has none. Label -1 is unknown."""
        state, alive = np.zeros(len(asked), np.int64), np.ones(len(asked), bool)
        for k, edges in enumerate(self.edges):
            alive &= asked[:, k] >= 0
            if not len(edges):
                return np.zeros(len(asked), np.int64)
            target = state * self.top + asked[:, k]
            at = np.minimum(np.searchsorted(edges, target), len(edges) - 1)
            alive &= edges[at] == target
            state = at
        return np.where(alive, self.weights[state], 0)

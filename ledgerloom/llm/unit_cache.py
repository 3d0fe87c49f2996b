"""Results for distinct parts of texts, kept by a worker between batches and tasks."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np

from ledgerloom.llm.common import ragged


class UnitCache:
    """Numbers for each distinct part; ``learn`` finds those of parts not seen yet.

    Beyond ``limit`` parts the ones that were used most stay, at most half.
    Which are kept moves work, never results.
    """

    def __init__(self, learn: Callable[[list], list[list[int]]], limit: int = 300_000) -> None:
        self.learn, self.limit = learn, limit
        self.clear()

    def clear(self) -> None:
        self._set({}, np.zeros(0, np.int64), np.zeros(0, np.int32))

    def _set(self, places: dict, lengths: np.ndarray, flat: np.ndarray) -> None:
        self.places = places
        self.starts = np.zeros(max(1 << 12, 2 * len(lengths)) + 1, np.int64)
        self.starts[1 : len(lengths) + 1] = np.cumsum(lengths)
        self.flat = np.zeros(max(1 << 12, 2 * len(flat)), np.int32)
        self.flat[: len(flat)] = flat
        self.uses = np.zeros(len(self.starts), np.int64)

    def __getitem__(self, part) -> list[int]:
        at = self.places[part]
        return self.flat[self.starts[at] : self.starts[at + 1]].tolist()

    def __contains__(self, part) -> bool:
        return part in self.places

    def _shrink(self) -> None:
        n = len(self.places)
        uses = self.uses[:n]
        least = max(2, int(np.partition(uses, n // 2)[n // 2]) + 1)
        kept = np.flatnonzero(uses >= least)
        lengths = self.starts[kept + 1] - self.starts[kept]
        flat = self.flat[ragged(self.starts[kept], lengths)]
        parts = list(self.places)
        self._set({parts[i]: place for place, i in enumerate(kept.tolist())}, lengths, flat)

    def _add(self, parts: list) -> None:
        found = self.learn(parts)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
        n = len(self.places)
        used = int(self.starts[n])
        while used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(parts) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.flat[used : used + len(flat)] = flat
        self.starts[n + 1 : n + 1 + len(parts)] = used + np.cumsum(lengths)
        self.places.update(zip(parts, range(n, n + len(parts)), strict=True))

    def numbers(self, parts: list) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all parts in one array, and how many each part has."""
        if len(self.places) > self.limit:
            self._shrink()
        at = np.fromiter(map(self.places.get, parts, repeat(-1)), np.int64, len(parts))
        unseen = np.flatnonzero(at < 0).tolist()
        if unseen:
            self._add(list(dict.fromkeys([parts[i] for i in unseen])))
            at[unseen] = [self.places[parts[i]] for i in unseen]
        if len(at):
            counts = np.bincount(at)
            self.uses[: len(counts)] += counts
        lengths = self.starts[at + 1] - self.starts[at]
        return self.flat[ragged(self.starts[at], lengths)], lengths

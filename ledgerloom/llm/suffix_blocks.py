"""Suffixes of one block of bytes, sorted bucket by bucket with a difference cover.

Only chosen suffixes are sorted, and only as far as ``depth`` bytes matter:
equal first ``depth`` bytes end up together. Suffixes are dealt into buckets by
their first two bytes and one bucket is sorted at a time, so extra memory is
that of a bucket. A bucket is sorted by the first ``WORDS`` words; longer ties
are resolved by ranks of a cover sample, computed once for the block: for any
two places a shift below ``PERIOD`` brings both into the sample, whose order
then decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: A perfect difference set: every difference modulo PERIOD occurs among its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
WORDS = 4
BUCKET = 1 << 18

_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: Smallest shift that brings places of two residues into the cover.
_SHIFT = np.array([[next(s for s in range(PERIOD) if _IN_COVER[(a + s) % PERIOD] and _IN_COVER[(b + s) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)])


def word_view(data: bytes) -> np.ndarray:
    """The eight bytes from every place on as one big-endian number, without a copy; places past the end are zeros."""
    padded = data + bytes(256)
    return np.ndarray((len(padded) - 7,), ">u8", padded, 0, (1,))


def refine(words: np.ndarray, place: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of places by ``steps`` words, and the number of each one's group of equals in that order."""
    first = words[place].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    ranked = first[order]
    new = np.ones(len(place), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    for step in range(1, steps):
        tied = ~new | ~np.append(new[1:], True)
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(new)[at]
        own = order[at]
        word = words[place[own] + 8 * step].astype(np.uint64)
        again = np.lexsort((word, group))
        order[at] = own[again]
        word, group = word[again], group[again]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
        new[at] |= fresh
    return order, np.cumsum(new) - 1


class CoverRanks:
    """Ranks of the cover sample among places that shifts from ``place`` can reach, by ``depth`` bytes."""

    def __init__(self, words: np.ndarray, place: np.ndarray, depth: int, size: int) -> None:
        reach = np.zeros(size + PERIOD + 1, np.int32)
        np.add.at(reach, place, 1)
        np.add.at(reach, place + PERIOD, -1)
        near = np.flatnonzero(np.cumsum(reach) > 0)
        sample = near[_IN_COVER[near % PERIOD]]
        order, group = refine(words, sample, -(-depth // 8))
        self.rank = np.zeros(size + PERIOD + 1, np.int32)
        self.rank[sample[order]] = group

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sign of the order of suffixes whose first PERIOD bytes are equal."""
        shift = _SHIFT[a % PERIOD, b % PERIOD]
        return np.sign(self.rank[a + shift] - self.rank[b + shift])


def break_ties(ranks: CoverRanks, place: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of places inside their groups, by splitting all groups at a pivot each, round by round."""
    order = np.arange(len(place))
    group = group.astype(np.int64)
    done = np.zeros(len(place), bool)
    while True:
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(starts, len(group)))
        done |= np.repeat(sizes == 1, sizes)
        if done.all():
            return order
        pivot = np.repeat(order[starts + sizes // 2], sizes)
        sign = np.where(done, 0, ranks.compare(place[order], place[pivot]))
        key = 3 * group + 1 + sign
        again = np.argsort(key, kind="stable")
        order, key, done, equal = order[again], key[again], done[again], (sign == 0)[again]
        done |= equal
        group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))


def sorted_buckets(data: bytes, place: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in suffix order, a bucket at a time, with True where the first ``depth`` bytes differ from those before."""
    if not len(place):
        return
    words = word_view(data)
    ranks = CoverRanks(words, place, depth + 8, len(data))
    lead = (words[place] >> np.uint64(48)).astype(np.int64)
    by_lead = np.argsort(lead, kind="stable")
    counts = np.bincount(lead, minlength=1 << 16)
    ends = np.cumsum(counts)
    cuts, last = [0], 0
    for lead_end in ends[np.flatnonzero(counts)].tolist():
        if lead_end - last >= BUCKET:
            cuts.append(lead_end)
            last = lead_end
    if cuts[-1] != len(place):
        cuts.append(len(place))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = place[by_lead[a:b]]
        order, group = refine(words, own, WORDS)
        own = own[order]
        tied = np.ones(len(own), bool)
        tied[1:] = group[1:] == group[:-1]
        tied[0] = False
        tied |= np.append(tied[1:], False)
        at = np.flatnonzero(tied)
        if len(at):
            own[at] = own[at][break_ties(ranks, own[at], group[at])]
        new = np.ones(len(own), bool)
        new[1:] = False
        for start in [*range(0, depth - 7, 8), depth - 8]:
            word = words[own + start]
            new[1:] |= word[1:] != word[:-1]
        yield own, new

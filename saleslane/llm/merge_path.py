"""Merging the token ends of two tokenizers by merge paths, in numpy.

The ends of the tokens A and of the tokens B of some texts are two rising sequences of byte offsets.
Merging them is a path through a grid; equally spaced diagonals cut it into pieces of equal work,
whose corners binary searches find. The pieces are then walked in step, each by itself: every end on
the way is an overlap of one A token with one B token, but for a B end that an A end has met already.
Where both end together a group is complete; groups that run over pieces are stitched by counting.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Ends that one piece merges.
PIECE = 256


def corners(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d merged ends are A's, for every diagonal d; A goes first in ties."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        other = np.where(open_, diagonals - 1 - middle, 0)
        first = a[np.where(open_, middle, 0)] <= b[other]
        low = np.where(open_ & first, middle + 1, low)
        high = np.where(open_ & ~first, middle, high)


@dataclass
class Path:
    """All merged ends in order. At each, ``a`` and ``b`` are the tokens that are open there.

    ``link`` says where the two overlap for the first time, ``close`` where both have ended.
    """

    a: np.ndarray
    b: np.ndarray
    link: np.ndarray
    close: np.ndarray


def merged(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Path:
    """The path through the ends ``a`` and ``b``, which are rising and end alike."""
    total = len(a) + len(b)
    pieces = -(-total // piece)
    diagonals = np.arange(pieces) * piece
    i = corners(a, b, diagonals)
    j = diagonals - i
    over = np.iinfo(np.int64).max
    a_ends, b_ends = np.append(a, over), np.append(b, over)
    at_a = np.empty((piece, pieces), np.int32)
    at_b = np.empty((piece, pieces), np.int32)
    is_a = np.empty((piece, pieces), bool)
    for step in range(piece):
        at_a[step], at_b[step] = i, j
        first = a_ends[i] <= b_ends[j]
        is_a[step] = first
        i = np.minimum(i + first, len(a))
        j = np.minimum(j + ~first, len(b))
    at_a, at_b, is_a = (x.T.ravel()[:total] for x in (at_a, at_b, is_a))
    # a B end that equals the A end before it closes a group, wherever a piece begins
    close = ~is_a & (at_a > 0) & (a_ends[at_a - 1] == b_ends[at_b])
    return Path(at_a, at_b, ~close, close)


@dataclass
class Groups:
    """The number of the group of every A and every B token, and how many groups there are."""

    of_a: np.ndarray
    of_b: np.ndarray
    count: int


def groups_of(path: Path, n_a: int, n_b: int) -> Groups:
    """Tokens between two common ends are one group."""
    ended_b = path.b[path.close]  # the last B token of every group
    ended_a = path.a[path.close] - 1
    return Groups(
        np.searchsorted(ended_a, np.arange(n_a)), np.searchsorted(ended_b, np.arange(n_b)), len(ended_a)
    )


class PairTable:
    """Counts of id pairs and whether they are the best of their B, found by a hash of the pair."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
        self.bits = max(4, int(2 * max(1, len(pairs))).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.counts, self.best = np.zeros(size, np.int64), np.zeros(size, bool)
        left, slots = np.arange(len(pairs)), self._slots(pairs)
        while len(left):  # the slot behind, as long as one is taken by another pair
            free = self.keys[slots] < 0
            self.keys[slots[free]] = pairs[left[free]]
            placed = self.keys[slots] == pairs[left]
            self.counts[slots[placed]] = counts[left[placed]]
            self.best[slots[placed]] = best[left[placed]]
            left, slots = left[~placed], (slots[~placed] + 1) % size

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        # Fixed value: an odd multiplier that spreads neighbouring numbers.
        spread = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, whether best) of every pair; pairs that are not here count 0."""
        slots = self._slots(pairs)
        keys = self.keys[slots]
        wrong = np.flatnonzero((keys != pairs) & (keys >= 0))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) % len(self.keys)
            keys = self.keys[slots[wrong]]
            wrong = wrong[(keys != pairs[wrong]) & (keys >= 0)]
        here = self.keys[slots] == pairs
        return np.where(here, self.counts[slots], 0), here & self.best[slots]

"""A compressed set of places that answers "which is the n-th" without being unpacked.

Places are dealt to containers by their upper bits, 65,536 places to one, and a container takes the
form that needs the least bytes: an array of 2 byte values, a bitmap of 8 KB, or runs of 4 bytes.
The cumulative cardinalities of the containers lead to the container of a rank, and the rest of
the rank is found inside it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from chanlake.llm.words import groups

BITS = 16
SPAN = 1 << BITS
WORDS = SPAN // 64
_BITMAP_BYTES = SPAN // 8


@dataclass(frozen=True)
class Values:
    """An array container: the low bits of each place, ascending."""

    values: np.ndarray

    def select(self, ranks: np.ndarray) -> np.ndarray:
        return self.values[ranks].astype(np.int64)


@dataclass(frozen=True)
class Bitmap:
    """A bitmap container, with the number of bits set before each word of 64."""

    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> Bitmap:
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        before = np.zeros(WORDS, np.int64)
        np.cumsum(bits.reshape(WORDS, 64).sum(1)[:-1], out=before[1:])
        return cls(np.packbits(bits, bitorder="little").view(np.uint64), before)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, ranks, "right") - 1
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        place = (np.cumsum(bits, axis=1) <= (ranks - self.before[word])[:, None]).sum(1)
        return word * 64 + place


@dataclass(frozen=True)
class Stretches:
    """A run container: where runs of neighbouring places start, and the number of places before each."""

    starts: np.ndarray
    before: np.ndarray

    def select(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, ranks, "right") - 1
        return self.starts[run].astype(np.int64) + ranks - self.before[run]


def container(low: np.ndarray) -> Values | Bitmap | Stretches:
    """The smallest container of ascending values below 65,536."""
    heads = np.flatnonzero(np.append(True, np.diff(low) != 1)) if len(low) else np.zeros(0, np.int64)
    if 4 * len(heads) < min(2 * len(low), _BITMAP_BYTES):
        return Stretches(low[heads].astype(np.uint16), heads)
    if 2 * len(low) <= _BITMAP_BYTES:
        return Values(low.astype(np.uint16))
    return Bitmap.of(low)


class BoundarySet:
    """A set of places, given ascending and distinct."""

    def __init__(self, places: np.ndarray):
        upper = places >> BITS
        first, ends = groups(upper)
        self.base = upper[first] << BITS
        self.containers = [container(places[a:b] & (SPAN - 1)) for a, b in zip(first, ends, strict=True)]
        self.cardinality = np.append(0, ends)  # cumulative

    def __len__(self) -> int:
        return int(self.cardinality[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The places with these ranks, counted from 0."""
        ranks = np.asarray(ranks, np.int64)
        if len(ranks) and (ranks.min() < 0 or ranks.max() >= len(self)):
            raise IndexError("no such rank")
        home = np.searchsorted(self.cardinality, ranks, "right") - 1
        out = np.empty(len(ranks), np.int64)
        order = np.argsort(home, kind="stable")
        for a, b in zip(*groups(home[order]), strict=True):
            rows, at = order[a:b], int(home[order[a]])
            out[rows] = self.base[at] + self.containers[at].select(ranks[rows] - self.cardinality[at])
        return out

"""Minimal perfect hashing of distinct integers in numpy.

Keys are placed level by level: at each level a key takes the place its hash gives it if
no other key of the level wants that place, and goes to the next level otherwise.  The
slot of a key is the number of taken places before its own, over all levels.
"""

from __future__ import annotations

import numpy as np

PLACES_PER_KEY = 2.0
_LEVEL = 0x9E3779B97F4A7C15


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = keys.astype(np.uint64) + np.uint64((level + 1) * _LEVEL % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys below 2^32.  ``keys`` in slot order verify
    what is looked up, so a key that was not built in is told from one that was."""

    def __init__(self, sizes: np.ndarray, taken: np.ndarray, keys: np.ndarray):
        self.sizes, self.taken, self.keys = sizes, taken, keys
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.before = np.concatenate(([0], np.cumsum(taken)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, parts = keys, [], []
        while len(left):
            size = int(PLACES_PER_KEY * len(left)) + 1
            at = _places(left, len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            taken = np.zeros(size, bool)
            taken[at[alone]] = True
            sizes.append(size)
            parts.append(taken)
            left = left[~alone]
        made = cls(np.array(sizes, np.int64), np.concatenate([*parts, np.zeros(0, bool)]), np.zeros(len(keys), np.uint32))
        made.keys[made._slots(keys)] = keys
        return made

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for one that was not built in."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + _places(keys[open_], level, int(size))
            hit = self.taken[at]
            out[open_[hit]] = self.before[at[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1 where the verified key is another one."""
        out = self._slots(keys)
        found = out >= 0
        found[found] = self.keys[out[found]] == keys[found]
        return np.where(found, out, -1)

    def dumped(self) -> tuple[bytes, bytes, bytes]:
        return self.sizes.tobytes(), np.packbits(self.taken).tobytes(), self.keys.tobytes()

    @classmethod
    def loaded(cls, sizes: bytes, taken: bytes, keys: bytes) -> PerfectHash:
        levels = np.frombuffer(sizes, np.int64)
        bits = np.unpackbits(np.frombuffer(taken, np.uint8), count=int(levels.sum())).astype(bool)
        return cls(levels, bits, np.frombuffer(keys, np.uint32))

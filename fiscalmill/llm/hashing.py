"""A hash table of 64-bit keys in numpy: many keys are looked up or added at once."""

from __future__ import annotations

import numpy as np

from fiscalmill.llm.words import mix

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class HashTable:
    """Open addressing with linear steps, at most half full; values are not negative.

    The largest 64-bit number marks an empty place and is no key. ``capacity`` bounds
    the number of keys and with it the memory: 32 bytes for each.
    """

    def __init__(self, capacity: int):
        size = 1 << max(4, (2 * capacity - 1).bit_length())
        self.capacity, self.used, self.last = capacity, 0, np.int64(size - 1)
        self.keys, self.values = np.full(size, _EMPTY), np.zeros(size, np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return mix(keys).view(np.int64) & self.last

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it is not held."""
        place = self._home(keys)
        held = self.keys[place]
        out = np.where(held == keys, self.values[place], -1)
        on = np.flatnonzero((held != keys) & (held != _EMPTY))
        place = place[on]
        while len(on):
            place = (place + 1) & self.last
            held = self.keys[place]
            hit = held == keys[on]
            out[on[hit]] = self.values[place[hit]]
            further = ~hit & (held != _EMPTY)
            on, place = on[further], place[further]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not held yet."""
        if self.used + len(keys) > self.capacity:
            raise ValueError("more keys than the table has room for")
        self.used += len(keys)
        place = self._home(keys)
        while len(keys):
            free = self.keys[place] == _EMPTY
            self.keys[place[free]] = keys[free]  # of keys that meet at one place the last one stays
            settled = self.keys[place] == keys
            self.values[place[settled]] = values[settled]
            keys, values, place = keys[~settled], values[~settled], (place[~settled] + 1) & self.last

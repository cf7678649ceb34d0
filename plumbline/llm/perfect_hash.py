"""A minimal perfect hash over 128-bit keys, made of levels of bit arrays.

A key takes the first level in which no other key left shares its bit; its slot is the number of
bits set before it. A fingerprint in that slot tells members from strangers.
"""

from __future__ import annotations

import numpy as np

GAMMA = 2


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _places(a: np.ndarray, b: np.ndarray, level: int, width: int) -> np.ndarray:
    step = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    return (mixed(a ^ mixed(b + step)) % np.uint64(width)).astype(np.int64)


def build(a: np.ndarray, b: np.ndarray) -> list[bytes]:
    """The packed bit array of each level. The keys (a, b) must be distinct."""
    levels = []
    while len(a):
        width = -(-GAMMA * len(a) // 8) * 8
        at = _places(a, b, len(levels), width)
        alone = np.bincount(at, minlength=width) == 1
        levels.append(np.packbits(alone).tobytes())
        rest = ~alone[at]
        a, b = a[rest], b[rest]
    return levels


class Lookup:
    """Slots of keys, from the levels that build() made."""

    def __init__(self, levels: list[bytes]):
        self.bits, self.before, total = [], [], 0
        for packed in levels:
            bits = np.unpackbits(np.frombuffer(packed, np.uint8))
            self.bits.append(bits)
            self.before.append(total + np.cumsum(bits, dtype=np.int64) - bits)
            total += int(bits.sum())

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 where no level has its bit. A stranger may get a member's slot."""
        found = np.full(len(a), -1, dtype=np.int64)
        left = np.arange(len(a))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            if not len(left):
                break
            at = _places(a[left], b[left], level, len(bits))
            hit = bits[at] == 1
            found[left[hit]] = before[at[hit]]
            left = left[~hit]
        return found

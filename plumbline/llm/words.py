"""Hashes of words and of runs of words, for a whole Arrow batch of texts at once.

Words are runs of bytes other than space and 0x09 to 0x0D, with A-Z lower-cased. Everything is
array arithmetic on the bytes of the batch, in pieces of bounded size; a text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from plumbline.llm.common import worker_cache
from plumbline.llm.perfect_hash import mixed

PIECE = 1 << 20
_BASE = 0x2545F4914F6CDD1D


class Words(NamedTuple):
    """Words of the texts first to first + n: hashes in order, and the number of words of each text."""

    first: int
    hashes: np.ndarray
    counts: np.ndarray


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text begins (one entry more at the end). Null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `size` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, min(last, n)
        first = last


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache()
    have = cache.get("powers")
    if have is None or len(have[0]) < n:
        size = max(n, PIECE * 2)
        both = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=np.uint64))
        cache["powers"] = have = tuple(both)
    return have


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte, upper case as lower case."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    values[65:91] = values[97:123]
    return values


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: equal spans (A-Z apart from case) have equal hashes."""
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * power[:len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * inverse[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def not_blank(data: np.ndarray) -> np.ndarray:
    return (data != 32) & ((data < 9) | (data > 13))


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of the bytes inside begin and end. A run ends with its text."""
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]
    stops[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def letters_and_digits(data: np.ndarray) -> np.ndarray:
    """Where a byte is an ASCII letter or digit, or part of another character than ASCII."""
    return ((data >= 48) & (data <= 57)) | ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128)


def words(texts: pa.Array, plain: bool = False) -> Iterator[Words]:
    """plain: words are runs of letters and digits; else runs of anything but white space."""
    data, offsets = text_bytes(texts)
    for first, last in pieces(offsets):
        own = data[offsets[first]:offsets[last]]
        at = offsets[first:last + 1] - offsets[first]
        starts, ends = word_spans(own, at, letters_and_digits(own) if plain else not_blank(own))
        yield Words(first, span_hashes(own, starts, ends), np.diff(np.searchsorted(starts, at)))


def shingles(found: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words, and how many each text has; repeated runs count.

    A text with fewer words gives its whole sequence as one run, a text without words none.
    """
    h, counts = found.hashes, found.counts
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first_word = np.cumsum(counts) - counts
    first_run = np.cumsum(runs) - runs
    at = np.arange(runs.sum()) - np.repeat(first_run, runs) + np.repeat(first_word, runs)
    length = np.repeat(np.minimum(counts, width), runs)
    total = np.zeros(len(at), np.uint64)
    for j in range(width):
        has = length > j
        place = np.where(has, at + j, 0)
        step = mixed((h[place] if len(h) else np.zeros(len(at), np.uint64)) + np.uint64((0xA0761D6478BD642F * (j + 1)) % 2**64))
        total += np.where(has, step, np.uint64(0))
    return mixed(total), runs

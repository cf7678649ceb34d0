"""Stretches of a text that repeat with a period, found by longest common extensions in suffix trees.

A run is a stretch of words with smallest period q that no neighbouring word extends keeping q. The Lyndon root of a run, in one of the
two orders of the words, is the longest Lyndon word at its place. So every place proposes two candidates: the
way to the next smaller, and to the next larger suffix. A candidate is extended to the right by the
suffix tree of the words and to the left by that of the reversed words, both by constant-time lowest common
ancestors in an Euler tour; at least two periods make a run.

Runs of at least REPEATS periods are wanted. Any word of such a run stands in it REPEATS times, so words that occur more seldom
divide a text into stretches that hold its runs whole; what is left is divided again, until nothing is seldom. Only these
stretches get trees. A text stays within its row and task; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.suffix_tree import Extensions

LEAST = 6
REPEATS = 4
# Words of stretches that share a tree; a longer stretch has one of its own.
TOGETHER = 1 << 15


class Run(NamedTuple):
    start: int
    length: int
    period: int


def _next_other(rank: list[int], smaller: bool) -> np.ndarray:
    """For each place the next one with a smaller (or larger) rank; the length where there is none."""
    found, open_places = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while open_places and (rank[open_places[-1]] > r) == smaller:
            found[open_places.pop()] = i
        open_places.append(i)
    return np.array(found, np.int64)


def all_runs(text: list[int]) -> np.ndarray:
    """Every run of two periods or more of a sequence of numbers from 0 on: rows of start, length, period."""
    n = len(text)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    forward = Extensions(text)
    rank = forward.rank.tolist()
    places = np.arange(n)
    ends = [_next_other(rank, smaller) for smaller in (True, False)]
    start, period = np.tile(places, 2), np.concatenate(ends) - np.tile(places, 2)
    # What ends with the text has no second period to be compared with.
    keep = start + period < n
    start, period = start[keep], period[keep]
    right = forward.common(start, start + period)
    del forward
    backward = Extensions(text[::-1])
    left = backward.common(n - start, n - start - period)
    first, length = start - left, left + period + right
    whole = length >= 2 * period
    return np.unique(np.stack([first[whole], length[whole], period[whole]], axis=1), axis=0)


def stretches(words: list, low: int, high: int, least: int = LEAST, repeats: int = REPEATS) -> Iterator[tuple[int, int]]:
    """Stretches of words[low:high] of which every word occurs `repeats` times in its stretch; shorter ones than `least` hold no run."""
    open_parts = [(low, high)]
    while open_parts:
        low, high = open_parts.pop()
        part = words[low:high]
        often = {w for w, n in Counter(part).items() if n >= repeats}
        if not often:
            continue
        marks = bytes(map(often.__contains__, part))
        for found in re.finditer(b"\x01{%d,}" % least, marks):
            if found.end() - found.start() == high - low:
                yield low, high
            else:
                open_parts.append((low + found.start(), low + found.end()))


def runs_of(texts: list[list], least: int = LEAST, repeats: int = REPEATS) -> list[list[Run]]:
    """The runs of each sequence of words with at least `least` words and `repeats` periods, by start, then period."""
    found: list[list[Run]] = [[] for _ in texts]
    waiting, size = [], 0

    def settle():
        # Stretches are put one after the other, each closed by a number of its own, so no run leaves its stretch.
        numbers, line, starts, owners = {}, [], [], []
        for k, (t, low, high) in enumerate(waiting):
            starts.append(len(line))
            owners.append((t, low))
            line += [numbers.setdefault(w, len(numbers)) for w in texts[t][low:high]]
            line.append(numbers.setdefault((k,), len(numbers)))
        runs = all_runs(line)
        runs = runs[(runs[:, 1] >= least) & (runs[:, 1] >= repeats * runs[:, 2])]
        for k, (first, length, period) in zip((np.searchsorted(starts, runs[:, 0], side="right") - 1).tolist(), runs.tolist()):
            t, low = owners[k]
            found[t].append(Run(first - starts[k] + low, length, period))

    for t, words in enumerate(texts):
        for low, high in stretches(words, 0, len(words), least, repeats):
            waiting.append((t, low, high))
            size += high - low
            if size >= TOGETHER:
                settle()
                waiting, size = [], 0
    if waiting:
        settle()
    for runs in found:
        runs.sort(key=lambda r: (r.start, r.period))
    return found


def collapsed(words: list, runs: list[Run]) -> list:
    """The words but those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        change[r.start + r.period] += 1
        change[r.start + r.length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods, exactly; of equals the first, then the one of the smallest period."""
    return max(runs, key=lambda r: (Fraction(r.length, r.period), -r.start, -r.period), default=None)


def split_words(text: str | None) -> list[bytes]:
    """Words are runs of anything but 0x20 and 0x09 to 0x0D."""
    return text.encode().split() if text else []


SCHEMA = "doc_id {}, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:long,length:long,period:long>>, text string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _search(prepare: Callable | None, least: int, repeats: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [split_words(t) for t in batch.column(1).to_pylist()]
            if prepare is not None:
                texts = [prepare(i, words) for i, words in zip(ids, texts)]
            found = runs_of(texts, least, repeats)
            best = [strongest(runs) for runs in found]
            of = lambda f: pa.array([f(r) if r else None for r in best], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(len, found), pa.int64()),
                 of(lambda r: r.start), of(lambda r: r.length), of(lambda r: r.period), of(lambda r: 1000 * r.length // r.period),
                 pa.array([[r._asdict() for r in runs] for runs in found], _RUNS),
                 pa.array([b" ".join(collapsed(words, runs)).decode() for words, runs in zip(texts, found)], pa.string())],
                names=["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "text"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, repeats: int = REPEATS,
                  prepare: Callable | None = None) -> DataFrame:
    """doc_id, n_words, n_runs, start, length, period, exponent_milli, runs, text: one row for each input row.

    runs has every run of at least `least` words and `repeats` periods, by start, then period; start counts words from 0.
    start to exponent_milli (1000 * length / period, rounded down) are of the run of most periods, of equals the first, then
    of the smallest period; null without a run. text has the words left by one space each: a run keeps its first period, unless
    another run takes it. Words are compared as they stand, letter case included. prepare(id, words) may give other words in place of a row's.

    A null text has no words and gives an empty text. Rows are judged one by one: ids may be null or repeat, repeated
    rows give equal rows. Other columns are not read. An empty table gives no rows.
    """
    if least < 2 or repeats < 2:
        raise ValueError("a run has two periods or more")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_search(prepare, least, repeats), SCHEMA.format(kind))

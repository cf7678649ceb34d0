"""Documents that hold benchmark passages, found by spaced-seed hashing.

A seed is a mask of word positions; the words at its gaps do not count, so a replaced word breaks only
the seeds that look at it. The masks below are such that any alignment of seven words or more with
at most one word in five replaced (two in ten to fourteen) is hit by one of them. A hit only names a passage
and a place: the passage is then laid over the document there and the equal words are counted. Where no single place
holds enough of them, places that words left out or added have shifted are put together in order. A passage also
counts where a long stretch of it stands in a document.

The benchmark is cut into blocks of a bounded number of words. A block's hashes go to the tasks that
read the documents; several blocks are several passes. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.perfect_hash import mixed
from plumbline.llm.words import words

# Word positions each mask looks at.
MASKS = ((0, 2, 3, 4, 5), (0, 1, 2, 5, 6), (0, 1, 2, 3, 5), (0, 1, 2, 4, 5), (0, 1, 2, 3, 4))
SHARE = 0.8
LEAST_WORDS = 5
BLOCK_WORDS = 1 << 18
TABLE_BITS = 22
STEP = 1 << 20
# Words of a stretch that counts by itself, and places beside a hit that are looked at.
STRETCH = 13
BESIDE = 3
PART = 512


def _ranks(h: np.ndarray, weight: int) -> list[np.ndarray]:
    return [mixed(h + np.uint64((0x8CB92BA72F3D8DD7 * (j + 1)) % 2**64)) for j in range(weight)]


def seed_hashes(ranks: list[np.ndarray], mask: tuple[int, ...], n: int) -> np.ndarray:
    """The mask's hash at every place where it fits into n words."""
    m = n - mask[-1]
    total = np.zeros(max(0, m), np.uint64)
    for j, place in enumerate(mask if m > 0 else ()):
        total += ranks[j][place:place + m]
    return total


class Passages:
    """A block of benchmark passages: word hashes, and sorted seed hashes with where they stand."""

    def __init__(self, item_ids: list[int], texts: list[str]):
        found = list(words(pa.array(texts, pa.string()), plain=True))
        counts = np.concatenate([f.counts for f in found]) if found else np.zeros(0, np.int64)
        h = np.concatenate([f.hashes for f in found]) if found else np.zeros(0, np.uint64)
        first = np.cumsum(counts) - counts
        self.item_ids, self.counts, self.first, self.words = np.array(item_ids, np.int64), counts, first, h
        owner = np.repeat(np.arange(len(counts)), counts)
        ranks, keys, places = _ranks(h, 5), [], []
        for mask in MASKS:
            s = seed_hashes(ranks, mask, len(h))
            at = np.arange(len(s))
            whole = owner[at] == owner[at + mask[-1]] if len(s) else np.zeros(0, bool)
            whole &= counts[owner[at]] >= LEAST_WORDS
            keys.append(s[whole])
            places.append(at[whole])
        # The weight is one for all masks and the sum does not tell them apart, so keys carry the mask.
        keys = [mixed(k + np.uint64(i)) for i, k in enumerate(keys)]
        key, place = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(key, kind="stable")
        self.keys, self.places, self.owner = key[order], place[order], owner
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True


def _in_order(h: np.ndarray, item: np.ndarray, base: int, size: int, low: int, high: int) -> tuple[int, int]:
    """Most words of the item that stand in h[low:high] in order, each shifted to one of `size` places from base on, and the first place."""
    n = len(item)
    at = np.arange(base, base + size + n)
    inside = (at >= low) & (at < high)
    own = h[np.clip(at, 0, len(h) - 1)]
    # The number of equal words, then the first place, which is better if smaller.
    fresh = (1 << 32) + (1 << 31) - np.arange(size)
    best, left_out = np.zeros(size, np.int64), np.zeros(size + n + 1, np.int64)
    for k in range(n):
        # Words were added before this one, or words of the item left out.
        before = np.maximum(np.maximum.accumulate(best), left_out[k:k + size])
        same = inside[k:k + size] & (own[k:k + size] == item[k])
        best = np.maximum(best, np.where(same, np.where(before > 0, before + (1 << 32), fresh), 0))
        np.maximum(left_out[k + 1:k + 1 + size], best, out=left_out[k + 1:k + 1 + size])
    top = int(best.max())
    return (top >> 32, base + (1 << 31) - (top & 0xFFFFFFFF)) if top else (0, 0)


def _shifted(h: np.ndarray, item: np.ndarray, starts: np.ndarray, low: int, high: int, share: float) -> tuple[int, int]:
    """Most words of the item that stand in h[low:high] in order at places by the given ones, and the place of the first.

    Places are put together where the next is half of the item's words or less away, or BESIDE, and in windows of twice as many places as
    the item has words, every second half of one beginning the next. (0, 0) if fewer than `share` of the words stand there.
    """
    n, found = len(item), (0, 0)
    reach = max(BESIDE, n // 2)
    for near in np.split(starts, np.flatnonzero(np.diff(starts) > reach) + 1):
        first, last = int(near[0]) - BESIDE, int(near[-1]) + BESIDE + 1
        for base in range(first, max(first + 1, last - 2 * reach), 2 * reach):
            size = min(4 * reach, last - base)
            if np.isin(item, h[max(low, base):max(low, min(high, base + size + n))]).sum() < share * n - 1e-9:
                continue
            equal, place = _in_order(h, item, base, size, low, high)
            if equal > found[0]:
                found = equal, place
    return found if found[0] >= share * n - 1e-9 else (0, 0)


def _stretch(same: np.ndarray, share: float) -> bool:
    """True if STRETCH neighbouring words or more hold at least `share` equal ones."""
    if len(same) < STRETCH:
        return False
    total = np.r_[0, np.cumsum(same - share)]
    return bool((total[STRETCH:] - np.minimum.accumulate(total)[:len(total) - STRETCH] >= -1e-9).any())


def overlaps(h: np.ndarray, counts: np.ndarray, passages: Passages, share: float = SHARE):
    """(document, passage, equal words, place) of every alignment with at least `share` of the passage's words, or of a stretch of it.

    Where a document has no such alignment of a passage, its alignments are put together.
    """
    if not len(h) or not len(passages.keys):
        return (np.zeros(0, np.int64),) * 4
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    ranks = _ranks(h, 5)
    pairs = []
    for i, mask in enumerate(MASKS):
        s = seed_hashes(ranks, mask, len(h))
        s = mixed(s + np.uint64(i))
        at = np.flatnonzero(passages.table[(s >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        lo, hi = np.searchsorted(passages.keys, s[at]), np.searchsorted(passages.keys, s[at], side="right")
        at, lo, n = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        # Hits of a common seed are worked off in bounded steps.
        edges = np.searchsorted(np.cumsum(n), np.arange(STEP, int(n.sum()) + STEP, STEP), side="left") + 1 if len(n) else []
        begin = 0
        for end in edges:
            own = slice(begin, min(end, len(n)))
            begin = end
            reps = n[own]
            which = np.repeat(lo[own], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            place = passages.places[which]
            item = passages.owner[place]
            start = np.repeat(at[own], reps) - (place - passages.first[item])
            doc = np.repeat(owner[at[own]], reps)
            pairs.append(np.unique(np.stack([doc, item, start]), axis=1))
    if not pairs:
        return (np.zeros(0, np.int64),) * 4
    doc, item, start = np.unique(np.concatenate(pairs, axis=1), axis=1)
    equal = np.zeros(len(doc), np.int64)
    size = passages.counts[item]
    for b in range(0, len(doc), 4096):
        part = slice(b, b + 4096)
        n = size[part]
        total = int(n.sum())
        within = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat(start[part], n) + within
        low, high = np.repeat(first[doc[part]], n), np.repeat((first + counts)[doc[part]], n)
        inside = (place >= low) & (place < high)
        same = inside & (h[np.clip(place, 0, len(h) - 1)] == passages.words[np.repeat(passages.first[item[part]], n) + within])
        equal[part] = np.add.reduceat(same, np.cumsum(n) - n) if total else 0
    good = equal >= share * size - 1e-9
    # One group for each document and passage; what has a good alignment is settled.
    edges = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])
    lengths = np.diff(np.r_[edges, len(doc)])
    open_groups = ~np.logical_or.reduceat(good, edges)
    for begin, length in zip(edges[open_groups], lengths[open_groups]):
        d, p = doc[begin], item[begin]
        words_of = passages.words[passages.first[p]:passages.first[p] + size[begin]]
        low, high = int(first[d]), int(first[d] + counts[d])
        # Each part of a very long passage is put in order by itself, so that the work stays in proportion to it.
        parts = range(0, len(words_of), PART)
        found = [(_shifted(h, words_of[p:p + PART], start[begin:begin + length] + p, low, high, share / min(2, len(parts))), p) for p in parts]
        n = sum(equal for (equal, _), _ in found)
        place = next((at - p for (equal, at), p in found if equal), 0)
        if n < share * len(words_of) - 1e-9:
            n = 0
        if n:
            good[begin], equal[begin], start[begin] = True, n, place
            continue
        for i in range(begin, begin + length):
            if equal[i] >= share * STRETCH - 1e-9:
                k = np.arange(max(0, low - start[i]), min(size[i], high - start[i]))
                good[i] = _stretch(h[start[i] + k] == words_of[k], share)
    return doc[good], item[good], equal[good], (start - first[doc])[good]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """The benchmark in blocks of about block_words words: broadcast variables."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.size(F.split("text", "\\s+")))).first()[0] or 0
    n = max(1, -(-size // block_words))
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast(([r["item_id"] if r["item_id"] is not None else -1 for r in part], [r["text"] for r in part]))


def _find(block, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages(*block.value)
        for batch in batches:
            for found in words(batch.column(1), plain=True):
                doc, item, equal, place = overlaps(found.hashes, found.counts, passages, share)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc + found.first)), pa.array(passages.item_ids[item]), pa.array(equal),
                     pa.array(passages.counts[item]), pa.array(place)],
                    names=["doc_id", "item_id", "equal_words", "item_words", "place"])

    return run


def _keep(block, share: float, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = Passages(*block.value)
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for found in words(batch.column(batch.schema.get_field_index(text_col)), plain=True):
                clean[overlaps(found.hashes, found.counts, passages, share)[0] + found.first] = False
            yield batch.filter(pa.array(clean))

    return run


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text", share: float = SHARE,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, equal_words, item_words, place: one row for each passage a document holds.

    A passage is held where at least `share` of its words stand in the document, in their places
    relative to each other or, if that is nowhere so, in order with words left out or added between them; or where
    13 neighbouring words of it or more stand there with at least `share` of them equal, also at the document's
    beginning or end. Left out or added words are seen only beside a seed hit, and where the places of neighbouring hits are up to half of the
    passage's words apart, and all of them about as many as it has words. Words are runs of letters and digits, A-Z lower-cased. Of several places
    the one with most equal words counts, the first of equals. Of passages of five words only whole ones are
    found for sure, and of six not those with the third word replaced; passages of fewer than five words, and
    null ones, are not looked for; null and empty documents hold none. Repeated rows, of either table, are
    one finding. Other columns are not read; empty tables give no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for block in _blocks(benchmark, item_id_col, item_text_col, block_words):
        part = rows.mapInArrow(_find(block, share), "doc_id long, item_id long, equal_words long, item_words long, place long")
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("equal_words", (-F.col("place")).alias("back"), "item_words")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.equal_words", "b.item_words", (-F.col("b.back")).alias("place"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", share: float = SHARE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs that hold no passage, by the same rule; all columns stay."""
    schema = docs.schema
    for block in _blocks(benchmark, item_id_col, item_text_col, block_words):
        docs = docs.mapInArrow(_keep(block, share, text_col), schema)
    return docs

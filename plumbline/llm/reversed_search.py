"""Ranked lexical search the other way round: documents stream through an index of the queries.

The items (queries) are many fewer than the documents, so the inverted index is built over the items' terms and goes to the
tasks; nothing of the documents is indexed or shuffled.

1. A first pass counts, over all documents, how many have terms, all their terms, and how many documents hold each term
   of the index. A task sends one row for each such term at most.
2. A second pass streams each document's term counts through the index and adds its weights to the items that hold them. A task
   keeps the best documents of each item in a bounded heap, and drops at once what cannot enter it.
3. The tasks' heaps are merged, those of GROUP tasks first, then the merged ones.

Items are worked off in blocks of a bounded number of terms, each with passes of its own. All arithmetic after the term weights is in
64-bit integers. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.words import words

K = 20
# Terms of the items whose index is sent to the tasks at once.
BLOCK_TERMS = 1 << 18
# Scores of documents and items that are held at once.
CELLS = 1 << 20
GROUP = 256
TABLE_BITS = 20


class Index:
    """Terms of a block of items: sorted hashes, and for each term the items that hold it and how often."""

    def __init__(self, texts: list[str | None]):
        found = list(words(pa.array(texts, pa.string()), plain=True))
        counts = np.concatenate([f.counts for f in found]) if found else np.zeros(0, np.int64)
        h = np.concatenate([f.hashes for f in found]) if found else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(counts)), counts)
        self.terms, term = np.unique(h, return_inverse=True)
        pair, times = np.unique(term.astype(np.int64) * max(1, len(texts)) + owner, return_counts=True)
        self.items, self.times = pair % max(1, len(texts)), times.astype(np.int64)
        self.bounds = np.searchsorted(pair // max(1, len(texts)), np.arange(len(self.terms) + 1))
        self.n_items = len(texts)
        # Most words of documents are told apart from terms by their first bits.
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.terms >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def counted(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, term and number of occurrences, by document, then term."""
        maybe = np.flatnonzero(self.table[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        h = hashes[maybe]
        at = np.minimum(np.searchsorted(self.terms, h), max(0, len(self.terms) - 1))
        same = self.terms[at] == h if len(self.terms) else np.zeros(len(h), bool)
        doc = np.searchsorted(np.cumsum(counts), maybe[same], side="right")
        pair, times = np.unique(doc * max(1, len(self.terms)) + at[same], return_counts=True)
        return pair // max(1, len(self.terms)), pair % max(1, len(self.terms)), times.astype(np.int64)


def _statistics(block):
    """(term, number): documents that hold each term; under -1 the documents with terms, under -2 all terms of the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(block.value[1])
        df, n_docs, n_terms = np.zeros(len(index.terms), np.int64), 0, 0
        for batch in batches:
            for found in words(batch.column(0), plain=True):
                df += np.bincount(index.counted(found.hashes, found.counts)[1], minlength=len(df))
                n_docs += int((found.counts > 0).sum())
                n_terms += int(found.counts.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[held, -1, -2]), pa.array(np.r_[df[held], n_docs, n_terms])], names=["term", "number"])

    return run


class Heaps:
    """The best documents of each item so far: largest score, then smallest id, rows without an id last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.unnamed = np.zeros(0, bool)
        # What an item's full heap holds least of; lower scores cannot enter.
        self.least = np.ones(n_items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, unnamed: np.ndarray, doc: np.ndarray) -> None:
        item, score, unnamed, doc = (np.r_[a, b] for a, b in ((self.item, item), (self.score, score), (self.unnamed, unnamed), (self.doc, doc)))
        order = np.lexsort((doc, unnamed, -score, item))
        own = item[order]
        place = np.arange(len(own)) - np.searchsorted(own, own)
        order = order[place < self.k]
        self.item, self.score, self.unnamed, self.doc = item[order], score[order], unnamed[order], doc[order]
        last = np.flatnonzero(place[place < self.k] == self.k - 1)
        self.least[self.item[last]] = self.score[last]


def _spans(sizes: np.ndarray, most: int, at_once: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most at_once documents with about `most` in all; a larger one is a range of its own."""
    total, first = np.r_[0, np.cumsum(sizes)], 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(total, total[first] + most, side="right")) - 1)
        last = min(last, first + at_once, len(sizes))
        yield first, last
        first = last


def scores(index: Index, weights: np.ndarray, n_docs: int, n_terms: int, hashes: np.ndarray, counts: np.ndarray):
    """(first document, scores of documents and items): dense arrays of bounded size."""
    doc, term, times = index.counted(hashes, counts)
    scale = 75 + 25 * counts[doc] * n_docs // max(1, n_terms)
    gain = weights[term] * (1_000_000_000 * times // (1000 * times + 12 * scale))
    meets = index.bounds[term + 1] - index.bounds[term]
    from_pair = np.searchsorted(doc, np.arange(len(counts) + 1))
    of_doc = np.diff(np.r_[0, np.cumsum(meets)][from_pair])
    for first, last in _spans(of_doc, CELLS, max(1, CELLS // index.n_items)):
        own = slice(from_pair[first], from_pair[last])
        n = meets[own]
        at = np.repeat(index.bounds[term[own]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found = np.zeros((last - first) * index.n_items, np.int64)
        np.add.at(found, np.repeat(doc[own] - first, n) * index.n_items + index.items[at], np.repeat(gain[own], n) * index.times[at])
        yield first, found.reshape(last - first, index.n_items)


def _search(block, weighing, k: int):
    """(item, task, doc_id, score): the heaps of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, (weights, n_docs, n_terms) = Index(block.value[1]), weighing.value
        heaps = Heaps(index.n_items, k)
        for batch in batches:
            ids = batch.column(0)
            unnamed = ids.is_null().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            for found in words(batch.column(1), plain=True):
                for first, score in scores(index, weights, n_docs, n_terms, found.hashes, found.counts):
                    doc, item = np.nonzero(score >= heaps.least)
                    at = doc + first + found.first
                    heaps.add(item, score[doc, item], unnamed[at], ids[at])
        yield pa.RecordBatch.from_arrays(
            [pa.array(heaps.item), pa.array(np.full(len(heaps.item), TaskContext.get().partitionId(), np.int64)),
             pa.array(heaps.doc, pa.int64(), mask=heaps.unnamed), pa.array(heaps.score)], names=["item", "task", "doc_id", "score"])

    return run


def _blocks(items: DataFrame, id_col: str, text_col: str, block_terms: int):
    """The items in blocks of about block_terms terms: lists of ids and of texts."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text is not null").distinct()
    size = rows.agg(F.sum(F.size(F.split("text", "\\s+")))).first()[0] or 0
    n = -(-size // block_terms)
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy("item_id", "text").collect()
        if part:
            yield [r["item_id"] for r in part], [r["text"] for r in part]


def best_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                   item_text_col: str = "text", k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, fewer if fewer have a score above 0.

    Terms are runs of ASCII letters and digits and of all other characters than ASCII, with A-Z lower-cased. With N the documents with
    terms, L all their terms, n a document's terms, df the documents with a term, and tf its occurrences in a document, a
    term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), and a document scores w * (10^9 tf div (1000 tf + 12 m)) summed over the
    item's terms, repeats included, where m = 75 + 25 n N div L.

    Equal scores rank by id, rows without an id last. Each row of docs is a document, so a repeated row takes a rank of its own. Items
    are the different pairs of id and text; texts under one id rank apart. Null or empty items, items whose terms no document has, and empty tables
    give no rows; null and empty documents have no terms. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    heaps = None
    for number, (ids, texts) in enumerate(_blocks(items, item_id_col, item_text_col, block_terms)):
        block = spark.sparkContext.broadcast((ids, texts))
        counted = rows.select("text").mapInArrow(_statistics(block), "term long, number long").groupBy("term").agg(F.sum("number").alias("number"))
        known = {r["term"]: r["number"] for r in counted.collect()}
        n_docs, n_terms = known.pop(-1, 0), known.pop(-2, 0)
        weights = np.zeros(len(Index(texts).terms), np.int64)
        for term, df in known.items():
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        weighing = spark.sparkContext.broadcast((weights, n_docs, n_terms))
        named = spark.createDataFrame(list(enumerate(ids)), "item int, item_id long").withColumn("item", F.col("item").cast("long"))
        part = (rows.mapInArrow(_search(block, weighing, k), "item long, task long, doc_id long, score long")
                .join(F.broadcast(named), "item").withColumn("block", F.lit(number)))
        heaps = part if heaps is None else heaps.unionByName(part)
    if heaps is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for keys in (("block", "item", F.floor(F.col("task") / GROUP)), ("block", "item")):
        heaps = heaps.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return heaps.select("item_id", "rank", "doc_id", "score")

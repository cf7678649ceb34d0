"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces of documents are dealt at random to blocks of bounded size. Several islands evolve packings
of one block: a child takes whole well-filled bins of one parent, loses the bins of the other that
hold a document twice, and gets the displaced pieces back by best fit. After each epoch an island's
best packing moves on to the next island of its block. A block ends early when its packing reaches a
lower bound. Only lengths travel between islands; the pieces themselves join the best packing at the end.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import partitions, stored
from plumbline.llm.tokens import encoder

SIZE = 2048
BLOCK = 8192
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs, by the bound of Martello and Toth over all thresholds."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    load = count * np.arange(size + 1)
    n, total = np.cumsum(count), np.cumsum(load)
    half = size // 2
    best = -(-int(total[-1]) // size)
    for t in range(half + 1):
        big = n[-1] - n[size - t]
        middle, middle_load = n[size - t] - n[half], total[size - t] - total[half]
        small_load = total[half] - (total[t - 1] if t else 0)
        best = max(best, int(big + middle + max(0, -(-(small_load - (middle * size - middle_load)) // size))))
    return best


def best_fit(items: np.ndarray, lengths: np.ndarray, bins: np.ndarray, fill: list[int], size: int) -> None:
    """Puts items, longest first, each into the fullest bin that takes it. Changes bins and fill."""
    room: dict[int, list[int]] = {}
    open_rooms = 0
    for b, f in enumerate(fill):
        if 0 < f < size:
            room.setdefault(size - f, []).append(b)
            open_rooms |= 1 << (size - f)
    empty = [b for b, f in enumerate(fill) if f == 0]
    order = items[np.argsort(-lengths[items], kind="stable")]
    for item, length in zip(order.tolist(), lengths[order].tolist()):
        fits = open_rooms >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            stack = room[left]
            b = stack.pop()
            if not stack:
                open_rooms ^= 1 << left
                del room[left]
        else:
            left = size
            if empty:
                b = empty.pop()
            else:
                b = len(fill)
                fill.append(0)
        bins[item] = b
        fill[b] += length
        left -= length
        if left:
            room.setdefault(left, []).append(b)
            open_rooms |= 1 << left


def renumbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(bins: np.ndarray, lengths: np.ndarray, size: int) -> tuple[int, float]:
    """Fewer bins first, then fuller bins."""
    fill = np.bincount(bins, weights=lengths)
    fill = fill[fill > 0]
    return -len(fill), float(((fill / size) ** 2).sum())


def fresh(lengths: np.ndarray, size: int, draw: np.random.Generator | None) -> np.ndarray:
    """A packing by best fit, longest first; with `draw` a share of the pieces is put in first, at random."""
    bins, fill = np.full(len(lengths), -1, np.int32), []
    items = np.arange(len(lengths))
    if draw is not None:
        early = draw.random(len(lengths)) < 0.3
        for part in np.array_split(draw.permutation(items[early]), 8):
            best_fit(part, lengths, bins, fill, size)
        items = items[~early]
    best_fit(items, lengths, bins, fill, size)
    return renumbered(bins)


def crossed(one: np.ndarray, two: np.ndarray, lengths: np.ndarray, size: int, draw: np.random.Generator) -> np.ndarray:
    """A child: well-filled bins of `one` whole, the untouched bins of `two`, the rest by best fit."""
    fill_one, n_two = np.bincount(one, weights=lengths), int(two.max()) + 1
    well = fill_one >= np.quantile(fill_one, 0.5)
    chosen = well & (draw.random(len(fill_one)) < 0.5)
    injected = chosen[one]
    hit = np.zeros(n_two, bool)
    hit[two[injected]] = True
    # Mutation: some of the emptiest bins are dissolved too.
    fill_two = np.bincount(two, weights=lengths, minlength=n_two)
    hit[np.argsort(fill_two)[:max(1, n_two // 50)]] = True
    child = np.where(injected, one + n_two, two)
    displaced = ~injected & hit[two]
    child[displaced] = 0
    child = child.astype(np.int64)
    kept = ~displaced
    child[kept] = renumbered(child[kept])
    n = int(child[kept].max()) + 1 if kept.any() else 0
    fill = np.bincount(child[kept], weights=lengths[kept], minlength=n).astype(int).tolist()
    best_fit(np.flatnonzero(displaced), lengths, child, fill, size)
    return renumbered(child)


def evolve(lengths: np.ndarray, size: int, seed: int, guests: list[np.ndarray],
           generations: int = GENERATIONS, population: int = POPULATION) -> np.ndarray:
    """The best packing after some generations, starting from the guests and fresh packings."""
    if not len(lengths):
        return np.zeros(0, np.int32)
    floor, draw = lower_bound(lengths, size), np.random.default_rng(seed)
    people = list(guests) or [fresh(lengths, size, None)]
    rank = lambda p: fitness(p, lengths, size)
    best = max(people, key=rank)
    while len(people) < population and -rank(best)[0] > floor:
        people.append(fresh(lengths, size, draw))
    for _ in range(generations):
        best = max(people, key=rank)
        if -rank(best)[0] <= floor:
            break
        for _ in range(max(1, population // 2)):
            a, b = draw.choice(len(people), 2, replace=False)
            if rank(people[a]) < rank(people[b]):
                a, b = b, a
            people.append(crossed(people[a], people[b], lengths, size, draw))
        people = sorted(people, key=rank, reverse=True)[:population]
    return max(people, key=rank)


def _as_blocks(size: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        lengths = pieces["__length"].to_numpy(np.int64).astype("<i4")
        sink = io.BytesIO()
        rest = pa.Table.from_pandas(pieces.drop(columns=["__block", "__length", "__u"]), preserve_index=False)
        with pa.ipc.new_stream(sink, rest.schema) as w:
            w.write_table(rest)
        return pd.DataFrame({"block": [int(pieces["__block"].iloc[0])], "lengths": [lengths.tobytes()], "rows": [sink.getvalue()]})

    return run


def _islands(size: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block, island, lengths, *guests in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.frombuffer(lengths, "<i4").astype(np.int64)
                packings = [np.frombuffer(g, "<i4") for g in guests if g is not None]
                best = evolve(sizes, size, seed=block * 1009 + island * 31 + epoch, guests=packings)
                bins, full = fitness(best, sizes, size) if len(sizes) else (0, 0.0)
                out.append((block, island, lengths, best.astype("<i4").tobytes(), bins, full))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.float64()))],
                names=["block", "island", "lengths", "elite", "bins", "fullness"])

    return run


def _placed(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lengths, rows, elite in zip(*(c.to_pylist() for c in batch.columns)):
                sizes = np.frombuffer(lengths, "<i4").astype(np.int64)
                bins = np.frombuffer(elite, "<i4").astype(np.int64)
                table = pa.ipc.open_stream(rows).read_all().cast(schema).combine_chunks()
                order = np.lexsort((np.arange(len(bins)), -sizes, bins))
                sorted_bins, sorted_sizes = bins[order], sizes[order]
                ends = np.cumsum(sorted_sizes)
                first = np.flatnonzero(np.r_[True, sorted_bins[1:] != sorted_bins[:-1]])
                base = np.repeat((ends - sorted_sizes)[first], np.diff(np.r_[first, len(order)]))
                offset = np.empty(len(bins), np.int64)
                offset[order] = ends - sorted_sizes - base
                out = table.append_column("sequence_id", pa.array((block << 24) + bins)).append_column("offset", pa.array(offset))
                yield from out.to_batches(max_chunksize=10_000)

    return run


def pack(pieces: DataFrame, length_col: str = "length", size: int = SIZE, block: int = BLOCK, islands: int = ISLANDS,
         epochs: int = EPOCHS) -> DataFrame:
    """The rows of pieces with `sequence_id` and `offset`: bins of at most `size`, filled from 0 without gaps.

    Lengths are 1 to `size`; they, and the other columns, pass through unchanged. Equal rows are pieces of their own. An
    empty table gives no rows. Columns named sequence_id, offset, __block, __length or __u are reserved.
    """
    spark = pieces.sparkSession
    schema = pieces.schema
    rows = stored(pieces.withColumn("__u", F.xxhash64(F.monotonically_increasing_id())), "pack-pieces")
    n_blocks = max(1, -(-rows.count() // block))
    dealt = rows.withColumn("__block", F.pmod("__u", F.lit(n_blocks)).cast("long")).withColumn("__length", F.col(length_col))
    blocks = stored(dealt.groupBy("__block").applyInPandas(_as_blocks(size), "block long, lengths binary, rows binary"), "pack-blocks")

    shape = "block long, island long, lengths binary, elite binary, bins long, fullness double"
    state = blocks.select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(islands - 1).cast("long"))).alias("island"), "lengths")
    tasks = max(partitions(spark), 1)
    for epoch in range(epochs):
        state = stored(state.repartition(tasks, "block", "island").mapInArrow(_islands(size, epoch), shape), "pack-islands")
        if epoch < epochs - 1:
            # Elites go round: each island starts anew with its own and its neighbour's.
            guests = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("elite").alias("guest"))
            state = state.join(guests, ["block", "island"]).select("block", "island", "lengths", "elite", "guest")
    best = state.groupBy("block").agg(F.max_by("elite", F.struct("bins", "fullness", "island")).alias("elite"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    out = blocks.join(best, "block").select("block", "lengths", "rows", "elite").repartition(tasks, "block")
    return out.mapInArrow(_placed(_arrow_schema(pieces)), f"{fields}, sequence_id long, offset long")


def _arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def _cut(tokenizer: str, end_id: int, size: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = encode.encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at:at + 4 * size]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            n = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds[i]) for i in range(n)], names=names[:n])

    return run


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
                 with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): the ids of a text and the end id, cut only if longer than `size`.

    A null text is empty and gives one piece of the end id. Other columns are not read.
    """
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _cut(tokenizer, end_id, size, with_ids), shape)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: packed pieces that carry their ids, put together."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))

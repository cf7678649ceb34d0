"""Documents whose shingle sets are similar, found by PartEnum signatures and verified exactly.

Sets are put into bands of sizes so narrow that only neighbouring bands can be similar. Within a band
and the next, a Jaccard bound is a bound k on the number of elements in which two sets differ.
The domain is partitioned into groups by hash so that some group holds only a few, k2, of those
differences, and each group again into parts; a set's signatures are the subsets of all parts but k2 of
every group. Two similar sets agree on such a subset in some group, so they share a signature, whatever
their elements are; no candidate is lost and none is capped.

1. One row for each signature and document; where many of a batch share one, they are tied together before the shuffle.
2. Rows of a signature stand next to each other in a sorted partition. Up to FEW documents give their pairs, and
   sketches of the sets drop the pairs that cannot be similar. Of a larger group neighbours are linked, so that it
   gives as many links as it has members.
3. Components of those links are clusters of candidates. Equal sets of a cluster become one set.
   A cluster's sets are dealt to blocks by size band; every two blocks that can hold similar sets
   meet once, in one small task, where all intersections are one matrix product.
   Links of neighbours may chain unlike sets, so a cluster of more than a block falls apart first: the sketches of its
   sets meet in the same way, in larger blocks, and only sets that may be similar stay together.
4. Components of the verified links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import partitions, release, stored, worker_cache
from plumbline.llm.components import components, forest
from plumbline.llm.perfect_hash import mixed
from plumbline.llm.words import shingles, words

BLOCK = 512
# Blocks of sketches hold this many times as many sets: a sketch has about 1/40 of the bytes.
WIDER = 32
# Parts left out and parts of a group, and the elements that a signature should hold on average.
CUTS = ((1, 2), (1, 3), (1, 4), (1, 6), (2, 5), (2, 6))
LOAD = 4.0
SMALL = 40
# Documents of one signature of which every pair is judged by itself.
FEW = 12
# 48 bits of a signature travel: a chance match is one more candidate, and is verified like any other.
DROPPED = np.uint64(16)
CELLS = 1 << 24


def band_starts(share: tuple[int, int], top: int) -> np.ndarray:
    """Smallest size of each band, up to a band that holds `top`. share is the similarity as a fraction.

    A set is similar to none that is larger than its size divided by the similarity, so no more than
    the next band can hold its partners.
    """
    num, den = share
    starts = [1]
    while starts[-1] <= top:
        starts.append(starts[-1] * den // num + 1)
    return np.array(starts, dtype=np.int64)


def differences(share: tuple[int, int], starts: np.ndarray) -> np.ndarray:
    """For each band, the most elements in which a set of it can differ from a similar set of it or the next band."""
    num, den = share
    low = starts[1:] - 1
    high = low * den // num
    # |A & B| >= num / (num + den) * (|A| + |B|), and the difference is |A| + |B| - 2 |A & B|.
    return (low + high) * (den - num) // (den + num)


def element_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, distinct element hashes sorted within each text, number of each text)."""
    for found in words(texts):
        runs, counts = shingles(found, width)
        ends = np.cumsum(counts)
        own = [np.unique(runs[e - c:e]) for c, e in zip(counts, ends)]
        yield found.first, np.concatenate(own) if own else runs, np.array([len(x) for x in own], dtype=np.int64)


def _sums(cells: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(n, np.uint64)
    np.add.at(total, cells, values)
    return total


def sketch_bits(n: int) -> int:
    """A set's sketch has two to this power bits, one or two for each element."""
    return max(3, n.bit_length())


def sketches(elements: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """For every set, whether an odd number of its elements falls to each cell (the top bits of a hash)."""
    spread = mixed(elements ^ np.uint64(0x243F6A8885A308D3))
    out, at = [], 0
    for n in counts.tolist():
        bits = sketch_bits(n)
        held = np.bincount((spread[at:at + n] >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        out.append(np.packbits((held & 1).astype(np.uint8)).tobytes())
        at += n
    return out


def folded(sketch: bytes) -> bytes:
    """The sketch of the same set with half as many cells."""
    cells = np.unpackbits(np.frombuffer(sketch, np.uint8)).reshape(-1, 2)
    return np.packbits(cells[:, 0] ^ cells[:, 1]).tobytes()


def least_difference(one: bytes, two: bytes) -> int:
    """A bound from below of the number of elements in which two sets differ: each one changes one cell."""
    while len(one) > len(two):
        one = folded(one)
    while len(two) > len(one):
        two = folded(two)
    return (int.from_bytes(one, "little") ^ int.from_bytes(two, "little")).bit_count()


def _digests(width: int):
    """doc_id, number of elements, 128 bits that stand for the set, and its sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, elements, counts in element_sets(batch.column(1), width):
                owner = np.repeat(np.arange(len(counts)), counts)
                a = _sums(owner, mixed(elements ^ np.uint64(0x5851F42D4C957F2D)), len(counts))
                b = _sums(owner, mixed(elements ^ np.uint64(0x14057B7EF767814F)), len(counts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(counts)), pa.array(counts), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                     pa.array(sketches(elements, counts), pa.binary())],
                    names=["doc_id", "n", "a", "b", "sketch"])

    return run


class Plan(NamedTuple):
    """How the sets of each band are cut up: groups, of which some are to spare, parts of a group, and parts left out."""

    groups: np.ndarray
    spare: np.ndarray
    parts: np.ndarray
    left_out: np.ndarray


def plan(share: tuple[int, int], top: int) -> tuple[np.ndarray, np.ndarray, Plan]:
    """Band starts, differences, and for each band the cheapest cut whose signatures hold LOAD elements on average.

    With k2 parts left out, each group stands for k2 + 1 differences. A signature without elements says nothing, and
    unlike sets share it; with e groups to spare, similar sets agree in e + 1 groups at least, so a set with no more than e
    groups that have such a signature can do without them.
    """
    starts = band_starts(share, top)
    most = differences(share, starts)
    rows = []
    for size, k in zip(starts[:-1].tolist(), most.tolist()):
        if k == 0:
            rows.append((1, 0, 1, 0))
            continue
        found = []
        for left_out, parts in CUTS:
            # Large sets have few empty parts either way, and the first cut makes the fewest signatures.
            if left_out > k or (size >= SMALL and found):
                continue
            base = -(-(k + 1) // (left_out + 1))
            spare = 0
            for _ in range(4):
                load = size / (base + spare) * (parts - left_out) / parts
                empty = (base + spare) * min(1.0, math.comb(parts, left_out) * math.exp(-load))
                spare = min(base // 5, int(empty + 3 * math.sqrt(empty) + 0.5)) if base > 2 else 0
            found.append((load < LOAD, (base + spare) * math.comb(parts, left_out) if load >= LOAD else -load, (base + spare, spare, parts, left_out)))
        rows.append(min(found)[2])
    return starts, most, Plan(*(np.array(c, dtype=np.int64) for c in zip(*rows)))


def signatures_of(elements: np.ndarray, counts: np.ndarray, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set) for all sets; an empty set has none."""
    out_sig, out_set = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if not len(elements):
        return out_sig[0], out_set[0]
    top = 1 << int(counts.max()).bit_length()
    plans = worker_cache().setdefault("jaccard plans", {})
    if (share, top) not in plans:
        plans[share, top] = plan(share, top)
    starts, _, cuts = plans[share, top]
    band = np.searchsorted(starts, counts, side="right") - 1
    owner = np.repeat(np.arange(len(counts)), counts)
    coin = mixed(elements ^ np.uint64(0x2B7E151628AED2A6))
    value = mixed(elements ^ np.uint64(0xC2B2AE3D27D4EB4F))
    high, low = coin >> np.uint64(32), coin & np.uint64(0xFFFFFFFF)
    # A set takes part in the comparison of its band with the next, and of the band before with its own.
    for shift in (0, 1):
        instance = band - shift
        at = np.maximum(instance, 0)
        for parts, left_out in sorted(set(zip(cuts.parts.tolist(), cuts.left_out.tolist()))):
            active = (counts > 0) & (instance >= 0) & (cuts.parts[at] == parts) & (cuts.left_out[at] == left_out)
            groups = np.where(active, cuts.groups[at], 0)
            n_groups = int(groups.sum())
            if not n_groups:
                continue
            use = active[owner]
            whose = owner[use]
            group = (high[use] * groups[whose].astype(np.uint64)) >> np.uint64(32)
            part = (low[use] * np.uint64(parts)) >> np.uint64(32)
            first = (np.cumsum(groups) - groups) * parts
            cell = first[whose] + (group * np.uint64(parts) + part).astype(np.int64)
            total = _sums(cell, value[use], n_groups * parts).reshape(-1, parts)
            held = np.bincount(cell, minlength=n_groups * parts).reshape(-1, parts) > 0
            of_set = np.repeat(np.arange(len(counts)), groups)
            place = (np.arange(n_groups) - np.repeat(np.cumsum(groups) - groups, groups)).astype(np.uint64)
            label = mixed((instance[of_set].astype(np.uint64) << np.uint64(32)) + place)
            kept = [c for c in combinations(range(parts), parts - left_out)]
            filled = np.stack([held[:, list(c)].any(axis=1) for c in kept], axis=1)
            n_empty = np.bincount(of_set, weights=~filled.all(axis=1), minlength=len(counts))
            # A set with more such groups than are to spare goes by all its signatures, so that nothing is missed.
            every = n_empty > cuts.spare[at]
            for i, c in enumerate(kept):
                sig = mixed(label ^ np.uint64((0x9E3779B97F4A7C15 * (i + 1)) % 2**64))
                for p in c:
                    sig = mixed(sig ^ total[:, p])
                chosen = every[of_set] | filled[:, i]
                out_sig.append(sig[chosen])
                out_set.append(of_set[chosen])
    return np.concatenate(out_sig), np.concatenate(out_set)


def _signatures(width: int, share: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            found, owners = [], []
            for first, elements, counts in element_sets(batch.column(1), width):
                sig, of_set = signatures_of(elements, counts, share)
                found.append(sig)
                owners.append(ids[of_set + first])
            if not found:
                continue
            sig, own = np.concatenate(found), np.concatenate(owners)
            order = np.lexsort((own, sig))
            sig, own = sig[order] >> DROPPED, own[order]
            new = np.r_[True, sig[1:] != sig[:-1]] if len(sig) else np.zeros(0, bool)
            run = np.cumsum(new) - 1
            big = (np.bincount(run) > FEW)[run]
            # Of many documents of one signature the first stands for the batch. The others are tied to it by a
            # signature that only these two have.
            goes, again = new | ~big, ~new & big
            leader = own[new][run]
            tie = mixed(leader[again].view(np.uint64) ^ mixed(own[again].view(np.uint64) + np.uint64(0x632BE59BD9B4E019))) >> DROPPED
            flags = np.r_[big[goes], np.ones(2 * len(tie), bool)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[sig[goes], tie, tie].view(np.int64)), pa.array(np.r_[own[goes], leader[again], own[again]]), pa.array(flags)],
                names=["sig", "doc_id", "many"])

    return run


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v, sure) from rows sorted by signature.

    A few documents of one signature give all their pairs, each to be judged by itself. Many give links from each to
    the next, which hold the group together and are not judged.
    """
    held = None
    def judged(sig, own, many):
        out = []
        new = np.r_[True, sig[1:] != sig[:-1]]
        run = np.cumsum(new) - 1
        large = ((np.bincount(run) > FEW) | (np.bincount(run, weights=many) > 0))[run]
        for step in range(1, FEW):
            same = (sig[step:] == sig[:-step]) & (own[step:] != own[:-step])
            if step > 1:
                same &= ~large[step:]
            if not same.any() and step > 1:
                break
            out.append((own[:-step][same], own[step:][same], large[step:][same]))
        return [np.concatenate(x) for x in zip(*out)]

    def table(sig, own, many):
        u, v, sure = judged(sig, own, many)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v)), pa.array(sure)], names=["u", "v", "sure"])

    for batch in batches:
        rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            rows = [np.r_[h, r] for h, r in zip(held, rows)]
        sig, own, many = rows
        if not len(sig):
            continue
        last = int(np.searchsorted(sig, sig[-1]))
        if len(sig) - last > FEW:
            # A large group goes on: its last document is enough to continue with.
            held = [sig[-1:], own[-1:], np.ones(1, bool)]
            many = many.copy()
            many[last:] = True
            yield table(sig, own, many)
        else:
            held = [sig[last:], own[last:], many[last:]]
            if last:
                yield table(sig[:last], own[:last], many[:last])
    if held is not None and len(held[0]) > 1:
        yield table(*held)


def _possible(share: tuple[int, int]):
    """Of pairs with both sizes and sketches, those that can be similar."""
    num, den = share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, n, m, one, two = (c.to_pylist() for c in batch.columns)
            keep = [i for i in range(len(u)) if num * max(n[i], m[i]) <= den * min(n[i], m[i])
                    and least_difference(one[i], two[i]) * (num + den) <= (n[i] + m[i]) * (den - num)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in keep], pa.int64()) for x in (u, v)], names=["u", "v"])

    return run


def near_links(sizes: np.ndarray, held: list[bytes], part: np.ndarray, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Links (index, index) that tie together all sets which their sizes and sketches let be similar; of two parts, those across.

    A set is compared with those that nothing has reached yet, so a group of near copies takes time in proportion to its size.
    """
    num, den = share
    least = min(map(len, held))
    rows = []
    for one in held:
        while len(one) > least:
            one = folded(one)
        rows.append(one.ljust(8, b"\0"))
    bits = np.frombuffer(b"".join(rows), np.uint64).reshape(len(held), -1).T.copy()
    across = part.min() != part.max()
    rest, todo, u, v, reached = bits, np.arange(len(held)), [], [], []
    while len(todo):
        if reached:
            i = reached.pop()
        else:
            i, rest, todo = todo[0], rest[:, 1:], todo[1:]
        differ = np.zeros(len(todo), np.int64)
        for own, others in zip(bits[:, i], rest):
            differ += np.bitwise_count(others ^ own)
        near = differ * (num + den) <= (sizes[todo] + sizes[i]) * (den - num)
        near &= num * np.maximum(sizes[todo], sizes[i]) <= den * np.minimum(sizes[todo], sizes[i])
        if across:
            near &= part[todo] != part[i]
        if near.any():
            found = todo[near]
            u.append(np.full(len(found), i))
            v.append(found)
            reached += found.tolist()
            rest, todo = rest[:, ~near], todo[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(u), np.concatenate(v)) if u else (none, none)


def _near(share: tuple[int, int]):
    """Sorted by meeting: (u, v), the links that keep the sets of a meeting together by their sketches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows):
            ids, side, sizes, held = zip(*rows)
            own = np.array(ids, dtype=np.int64)
            u, v = near_links(np.array(sizes, dtype=np.int64), held, np.unique(side, return_inverse=True)[1], share)
            u, v = forest(own[u], own[v])
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        key, rows = None, []
        for batch in batches:
            for meeting, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if meeting != key:
                    if len(rows) > 1:
                        yield table(rows)
                    key, rows = meeting, []
                rows.append(row)
        if len(rows) > 1:
            yield table(rows)

    return run


def _elements(width: int):
    """The sets themselves, as sorted hashes, with the columns that came before the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            for first, elements, counts in element_sets(batch.column(last), width):
                ends = np.cumsum(counts)
                packed = [elements[e - c:e].tobytes() for c, e in zip(counts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(first, len(counts)) for i in range(last)] + [pa.array(packed, pa.binary())],
                    names=batch.schema.names[:last] + ["elements"])

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    if len(sets) == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), shared], [shared, len(sets[1])]], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n > 1
    column = np.cumsum(shared) - 1
    use = shared[at]
    rows, columns = owner[use], column[at[use]]
    total = np.zeros((len(sets), len(sets)))
    step = max(1, CELLS // len(sets))
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for lo in range(0, int(shared.sum()), step):
        i, j = np.searchsorted(columns, (lo, lo + step))
        dense = np.zeros((len(sets), min(step, int(shared.sum()) - lo)), dtype=np.float32)
        dense[rows[i:j], columns[i:j] - lo] = 1
        total += dense @ dense.T
    return np.rint(total).astype(np.int64)


def _verified(share: tuple[int, int]):
    """Sorted by meeting: (doc_id, other, links): a forest of the links found, and each set's linked documents as counts."""
    num, den = share

    def settle(rows):
        ids, side, copies, sets, _ = (list(c) for c in zip(*rows))
        both = len(set(side)) > 1
        size = np.array([len(s) for s in sets])
        shared = intersections(sets)
        linked = den * shared >= num * (size[:, None] + size[None, :] - shared)
        np.fill_diagonal(linked, False)
        if both:
            part = np.array(side)
            linked &= part[:, None] != part[None, :]
        own = np.array(ids, dtype=np.int64)
        links = linked @ np.array(copies, dtype=np.int64)
        i, j = np.nonzero(np.triu(linked))
        u, v = forest(own[i], own[j])
        return [*zip(u.tolist(), v.tolist(), [0] * len(u)), *((d, d, n) for d, n in zip(own.tolist(), links.tolist()) if n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(out):
            a, b, c = zip(*out) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)], names=["doc_id", "other", "links"])

        key, rows, out = None, [], []
        for batch in batches:
            for meeting, doc_id, side, copies, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if meeting != key:
                    if len(rows) > 1:
                        out += settle(rows)
                    key, rows = meeting, []
                # A row that is there twice is one set; its copies are counted already.
                if not rows or rows[-1][0] != doc_id or rows[-1][4] != packed:
                    rows.append((doc_id, side, copies, np.frombuffer(packed, np.uint64), packed))
            if len(out) > 10_000:
                yield table(out)
                out = []
        if len(rows) > 1:
            out += settle(rows)
        yield table(out)

    return run


def in_blocks(classes: DataFrame, block: int, purpose: str) -> DataFrame:
    """Blocks of at most about `block` sets of one band, and the meetings of blocks.

    classes: cluster, band, rep and any others; part and meetings are added. Sets that have nothing to meet are left out.
    """
    bands = classes.groupBy("cluster", "band").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"), F.count("*").alias("sets"))
    bands = stored(bands, purpose)
    after = bands.select("cluster", (F.col("band") - 1).alias("band"), F.col("parts").alias("next_parts"))
    before = bands.select("cluster", (F.col("band") + 1).alias("band"), F.col("parts").alias("prior_parts"))
    around = (bands.join(after, ["cluster", "band"], "left").join(before, ["cluster", "band"], "left")
              .where("sets > 1 or next_parts is not null or prior_parts is not null"))
    placed = (classes.join(around, ["cluster", "band"])
              .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts").cast("long")).cast("int")))
    meetings = F.flatten(F.array(
        # With every block of its band: the lower numbered first.
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(
            F.col("band").alias("b1"), F.least(p, F.col("part")).alias("p1"), F.col("band").alias("b2"), F.greatest(p, F.col("part")).alias("p2"))),
        F.when(F.col("next_parts").isNull(), F.array()).otherwise(F.transform(F.sequence(F.lit(0), F.col("next_parts") - 1), lambda p: F.struct(
            F.col("band").alias("b1"), F.col("part").alias("p1"), (F.col("band") + 1).alias("b2"), p.alias("p2")))),
        F.when(F.col("prior_parts").isNull(), F.array()).otherwise(F.transform(F.sequence(F.lit(0), F.col("prior_parts") - 1), lambda p: F.struct(
            (F.col("band") - 1).alias("b1"), p.alias("p1"), F.col("band").alias("b2"), F.col("part").alias("p2")))),
    ))
    return placed.withColumn("meetings", meetings)


def meeting_name() -> Column:
    return F.concat_ws("/", "cluster", "m.b1", "m.p1", "m.b2", "m.p2").alias("meeting")


def smaller_clusters(classes: DataFrame, whole: DataFrame, share: tuple[int, int], block: int) -> DataFrame:
    """The classes, with clusters of more than `block` sets replaced by what their sketches keep together; whole is kept as the first cluster.

    All pairs of a large cluster are compared that its size bands let meet, by sketches alone; no similar pair is parted.
    """
    large = stored(classes.groupBy("cluster").agg(F.count("*").alias("sets")).where(F.col("sets") > block).select("cluster"), "jaccard-large")
    classes = classes.withColumn("whole", F.col("cluster"))
    if large.isEmpty():
        return classes
    placed = in_blocks(classes.join(large, "cluster", "left_semi"), WIDER * block, "jaccard-large-bands")
    met = (placed.join(whole.select(F.col("doc_id").alias("rep"), "n", "a", "b", "sketch"), ["rep", "n", "a", "b"])
           .select("cluster", "rep", F.concat_ws("/", "band", "part").alias("side"), "n", "sketch", F.explode("meetings").alias("m"))
           .select(meeting_name(), "rep", "side", "n", "sketch"))
    near = (met.repartition(2 * partitions(classes.sparkSession), "meeting").sortWithinPartitions("meeting", "rep")
            .mapInArrow(_near(share), "u long, v long"))
    near = components(near, "jaccard-near")
    return (classes.join(large.withColumn("is_large", F.lit(True)), "cluster", "left").join(near, classes["rep"] == near["node"], "left")
            .withColumn("cluster", F.when(F.col("is_large"), F.coalesce("component", "rep")).otherwise(F.col("cluster")))
            .select(*classes.columns))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                      share: tuple[int, int] = (9, 10), block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links: one row per input row with an id.

    Two documents link when den * |A & B| >= num * |A | B| for share = (num, den). component_id is
    the smallest id that links reach; n_links counts the documents linked directly. A text with fewer words
    than `width` is one element; without words (null or empty) its set is empty and it links with
    nothing. Rows of one id and equal text count once for each row. Rows without an id are left
    out, as nothing can name them. Ties do not arise; other columns are not read; an empty table
    gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    whole = stored(source.mapInArrow(_digests(width), "doc_id long, n long, a long, b long, sketch binary"), "jaccard-sets")
    sets = whole.drop("sketch")
    links = (source.mapInArrow(_signatures(width, share), "sig long, doc_id long, many boolean")
             .repartition(2 * partitions(spark), "sig").sortWithinPartitions("sig", "doc_id")
             .mapInArrow(_candidates, "u long, v long, sure boolean"))
    links = stored(links.groupBy("u", "v").agg(F.max("sure").alias("sure")), "jaccard-candidates")
    release(spark)
    one = whole.select(F.col("doc_id").alias("u"), "n", F.col("sketch").alias("one"))
    two = whole.select(F.col("doc_id").alias("v"), F.col("n").alias("m"), F.col("sketch").alias("two"))
    possible = (links.where("not sure").join(one, "u").join(two, "v").select("u", "v", "n", "m", "one", "two")
                .mapInArrow(_possible(share), "u long, v long"))
    links = possible.unionByName(links.where("sure").select("u", "v"))
    cluster = components(links, "jaccard-clusters").withColumnRenamed("component", "cluster")

    # Equal sets of a cluster are one set, under the smallest id.
    top = sets.agg(F.max("n")).first()[0] or 1
    starts = [int(x) for x in band_starts(share, top)]
    members = stored(sets.join(cluster, sets["doc_id"] == cluster["node"]).drop("node"), "jaccard-members")
    classes = members.groupBy("cluster", "n", "a", "b").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes.withColumn("band", F.expr(
        f"size(filter(array({', '.join(f'{s}L' for s in starts)}), s -> s <= n))")), "jaccard-classes")
    classes = stored(smaller_clusters(classes, whole, share, block), "jaccard-smaller")
    placed = in_blocks(classes, block, "jaccard-bands")
    wanted = stored(placed.select(F.col("rep").alias("doc_id"), "copies", "cluster", F.col("band"), F.col("part"), "a", "meetings"),
                    "jaccard-wanted")
    release(spark)
    # One text per id is enough: rows of one id with another text are another set.
    # The texts are joined by a shuffle at every size: what is wanted grows with the corpus.
    held = (source.join(wanted.hint("merge"), "doc_id").select("doc_id", "copies", "cluster", "band", "part", "meetings", "a", "text")
            .mapInArrow(_elements(width), "doc_id long, copies long, cluster long, band int, part int, "
                        "meetings array<struct<b1:int,p1:int,b2:int,p2:int>>, a long, elements binary"))
    # As many sets meet as fit a task; which blocks meet is all that is copied.
    met = held.select("doc_id", "copies", "cluster", F.concat_ws("/", "band", "part").alias("side"), "elements", F.explode("meetings").alias("m"))
    pairs = met.select(meeting_name(), "doc_id", "side", "copies", "elements")
    verified = stored(pairs.repartition(2 * partitions(spark), "meeting").sortWithinPartitions("meeting", "doc_id")
                      .mapInArrow(_verified(share), "doc_id long, other long, links long"), "jaccard-verified")
    release(spark)
    linked = components(verified.where("doc_id <> other").select("doc_id", "other"), "jaccard-components")
    counts = verified.where("doc_id = other").groupBy(F.col("doc_id").alias("rep")).agg(F.sum("links").alias("others"))

    of_class = (classes.join(linked, classes["rep"] == linked["node"], "left").join(counts, "rep", "left")
                .select(F.col("whole").alias("cluster"), "n", "a", "b", F.coalesce("component", "rep").alias("component_id"),
                        (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")))
    of_member = members.join(of_class, ["cluster", "n", "a", "b"]).select("doc_id", "n", "a", "b", "component_id", "n_links").distinct()
    return sets.join(of_member, ["doc_id", "n", "a", "b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))

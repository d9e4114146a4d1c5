"""SimHash near-deduplication with pivot distance tables.

Fingerprints: A-Z lower-cased, words are runs of non-white bytes, shingles of ``shingle`` words
(repeats included); a bit of the 64-bit fingerprint is set if it is set in over half of the
shingles' XXH64 hashes (seed 42).

Search: equal fingerprints are collapsed to one first.  For every distinct fingerprint the Hamming
distances to ``PIVOTS`` reference fingerprints are its row of the pivot distance table, computed once and
stored with it.  By the triangle inequality the distances of two fingerprints within ``max_bits`` of each
other differ by at most ``max_bits`` at every pivot, so a pair whose largest coordinate difference
is greater is discarded, and only survivors are compared bit by bit.

Distances to any reference concentrate near 32 of 64 bits, so coordinate intervals alone leave
every cell about as full as the table and the discards would run over all pairs.  The table is
therefore first split exactly: the 64 bits are cut in ``blocks`` groups; two fingerprints at most
``max_bits`` apart agree on at least ``blocks - max_bits`` whole groups, so they meet in a cell
for some choice of that many groups.  ``blocks`` follows from the number of distinct fingerprints
(more groups give wider keys); every choice finds the same links.

Texts with much in common can crowd a cell all the same.  A cell of more than ``LARGE`` fingerprints is
cut again in the same way: its free bits (those the cell does not fix) make ``max_bits + 1`` groups, two
fingerprints at most ``max_bits`` apart agree on one of them, and the cell becomes the finer cells of
each group.  Fingerprints are distinct, so every cut leaves fewer that can share a cell, and cells end
below ``LARGE`` or with at most ``max_bits`` free bits, where all are linked to any one.

Inside a cell only components matter, so a cell is searched from one centre after another:
fingerprints linked to the centre leave the cell's remaining list, and their own neighbours are
sought only among the remaining ones that pivots (the centre included) do not rule out.  A cell
of near copies of one text takes linear time.  Only spanning links are emitted.

Defined results: a null or empty text has fingerprint zero, linked like any other; texts are taken whole however
long; null doc_ids get
a fingerprint and count as largest when a component's smallest doc_id is taken; repeated rows give
repeated rows; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_split, ship_package, text_bytes, written
from .components import connected_components
from .token_files import _slices

SEED = 42
PIVOTS = 16
CELL_ROWS = 64
LARGE = 4096
PART_SHINGLES = 1 << 15
CHUNK = 1 << 10
ALL_BITS = (1 << 64) - 1


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, in runs of at most PART_SHINGLES."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z only, and exactly the six ASCII white-space bytes
    if not words:
        return
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    width = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    hash_, view = xxhash.xxh64_intdigest, memoryview(joined)
    for i in range(0, n, PART_SHINGLES):
        lows = starts[i: min(i + PART_SHINGLES, n)].tolist()
        highs = ends[i + width - 1: i + width - 1 + len(lows)].tolist()
        yield np.array([hash_(view[a:b], SEED) for a, b in zip(lows, highs, strict=True)], dtype="<u8")


def fingerprint(text: bytes, shingle: int = 4) -> int:
    total, counts = 0, np.zeros(64, dtype=np.int64)
    for hashes in shingle_hashes(text, shingle):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long) of every whole text."""
    ship_package(docs.sparkSession)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch, 1):
                fps = np.array([fingerprint(t, shingle) for t in rows.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
            .mapInArrow(compute, "doc_id long, fp long"))


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints (uint64) to the reference fingerprints, one row each."""
    references = np.random.default_rng(SEED).integers(0, 1 << 63, PIVOTS, dtype=np.uint64) << np.uint64(1)
    return np.bitwise_count(fps[:, None] ^ references[None, :]).astype(np.int8)


def block_masks(n: int, max_bits: int) -> list[int]:
    """Masks of the groups to agree on, wide enough that a cell of n even fingerprints stays small."""
    blocks = max_bits + 1
    while True:
        agree = blocks - max_bits
        if blocks >= 16 or n <= CELL_ROWS << (64 * agree // blocks):
            break
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    groups = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(groups, agree)]


def finer_masks(mask: int, max_bits: int) -> list[int]:
    """``mask`` with one of the ``max_bits + 1`` groups of its free bits added, for each group."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << int(i) for i in group) for group in np.array_split(free, max_bits + 1)]


def cell_links(fps: np.ndarray, table: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that span the components of one cell's distinct fingerprints (uint64) with their pivot rows."""
    left = np.arange(len(fps))
    while len(left) > 1:
        centre, left = left[0], left[1:]
        may = np.flatnonzero(np.abs(table[left] - table[centre]).max(axis=1) <= max_bits)
        near = may[np.bitwise_count(fps[left[may]] ^ fps[centre]) <= max_bits]
        if not len(near):
            continue
        found = left[near]
        yield np.full(len(found), centre), found
        left, queue = np.delete(left, near), [found]
        reach = np.bitwise_count(fps[left] ^ fps[centre])
        # the centre is one more pivot: only what lies within max_bits of a found one's distance can link
        while queue and len(left):
            members = queue.pop()
            for i in range(0, len(members), CHUNK):
                if not len(left):
                    break
                some = members[i: i + CHUNK]
                away = np.bitwise_count(fps[some] ^ fps[centre])
                able = np.flatnonzero(reach <= away.max() + max_bits)
                taken = np.zeros(len(left), dtype=bool)
                for j in range(0, len(able), CHUNK):
                    part = able[j: j + CHUNK]
                    gap = np.zeros((len(some), len(part)), dtype=np.int8)
                    for p in range(PIVOTS):
                        np.maximum(gap, np.abs(table[some, p][:, None] - table[left[part], p][None, :]), out=gap)
                    a, b = np.nonzero(gap <= max_bits)
                    good = np.bitwise_count(fps[some[a]] ^ fps[left[part[b]]]) <= max_bits
                    a, b = a[good], b[good]
                    first = np.unique(b, return_index=True)[1]
                    if len(first):
                        yield some[a[first]], left[part[b[first]]]
                        taken[part[b[first]]] = True
                if taken.any():
                    queue.append(left[taken])
                    left, reach = left[~taken], reach[~taken]


CELL_SCHEMA = "mask long, cell long, fp long, p0 long, p1 long"


def pivot_rows(distinct: DataFrame) -> DataFrame:
    """fp and its row of the pivot distance table: PIVOTS bytes, as the two longs p0 and p1."""
    ship_package(distinct.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                fps = batch.column(0).to_numpy()
                rows = pivot_table(fps.view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy())], ["fp", "p0", "p1"])

    return distinct.select("fp").mapInArrow(measure, "fp long, p0 long, p1 long")


def split_crowded(cells: DataFrame, max_bits: int) -> DataFrame:
    """Cells of more than LARGE fingerprints replaced by the cells of their finer masks, until none is left."""

    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            masks, which = np.unique(batch.column("mask").to_numpy(), return_inverse=True)
            table = np.array([finer_masks(int(m) & ALL_BITS, max_bits) for m in masks], dtype=np.uint64).view(np.int64)
            fps = batch.column("fp").to_numpy()
            for group in range(max_bits + 1):
                mask = table[which, group]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mask), pa.array(fps & mask), *[batch.column(c) for c in ("fp", "p0", "p1")]],
                    ["mask", "cell", "fp", "p0", "p1"])

    done = None
    while True:
        crowded = written(cells.groupBy("mask", "cell").agg(F.count(F.lit(1)).alias("n")).where(
            (F.col("n") > LARGE) & (F.bit_count("mask") < 64 - max_bits)).select("mask", "cell"), "crowded-cells")
        if crowded.isEmpty():
            return cells if done is None else done.unionByName(cells)
        small = cells.join(crowded, ["mask", "cell"], "left_anti")
        done = small if done is None else done.unionByName(small)
        cells = written(cells.join(crowded, ["mask", "cell"], "left_semi").mapInArrow(finer, CELL_SCHEMA), "finer-cells")


def fingerprint_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """a, b: links among the distinct fingerprints (column fp) that span their components."""
    table = written(pivot_rows(distinct), "pivot-table")
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(table.count(), max_bits)])
    cells = table.withColumn("mask", F.explode(masks)).select(
        "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("cell"), "fp", "p0", "p1")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            rows = np.concatenate(held)
            fps, pivots = rows[:, 0].copy(), rows[:, 1:].copy().view(np.int8)
            for a, b in cell_links(fps.view(np.uint64), pivots, max_bits):
                yield pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], ["a", "b"])

        held, last = [], None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            mask, cell, *row = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            rows = np.stack(row, axis=1)
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(cell) != 0)) + 1
            for i, j in itertools.pairwise([0, *cuts.tolist(), len(rows)]):
                if last != (mask[i], cell[i]):
                    if sum(map(len, held)) > 1:
                        yield from emit(held)
                    held, last = [], (mask[i], cell[i])
                held.append(rows[i:j])
        if sum(map(len, held)) > 1:
            yield from emit(held)

    return (split_crowded(cells, max_bits).repartition("mask", "cell").sortWithinPartitions("mask", "cell", "fp")
            .mapInArrow(search, "a long, b long"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable by links) of every row."""
    table = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(table.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(fingerprint_links(distinct, max_bits))
    member = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    member = written(member, "fingerprint-roots")
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = written(join_split(member, smallest, "root").select("fp", "component_id"), "fingerprint-classes")
    return table.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one row of each component: the one of smallest doc_id (nulls last); all columns kept.

    Rows get a number of their own first, so repeated ids stay apart."""
    table = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                                F.monotonically_increasing_id().alias("key")), "simhash-rows")
    groups = near_duplicates(table.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), shingle, max_bits)
    ids = table.select("key", F.col("row.doc_id").alias("id"))
    order = F.struct(F.col("id").isNull().alias("absent"), F.col("id").alias("id"), F.col("key").alias("key"))
    first = (groups.select(F.col("doc_id").alias("key"), "component_id").join(ids, "key")
             .groupBy("component_id").agg(F.min(order)["key"].alias("key")))
    return table.join(first, "key", "left_semi").select("row.*")

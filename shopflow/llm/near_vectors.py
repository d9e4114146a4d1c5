"""Embedding near-deduplication: an exact metric range join.

Vectors are scaled to unit length, so cosine >= c is Euclidean distance <= r = sqrt(2 - 2c), a metric.
Equal vectors become one node first.  Pivots partition the nodes:

* *Balls*: pivots with many sampled vectors around them; a node within r/2 of one lives in the nearest
  ball.  By the triangle inequality all nodes of a ball are linked, so a ball of near copies, however
  large, is counted by its total weight without looking at its pairs.
* *Cells*: every other node lives in the cell of its nearest general pivot.

Boundary replication: a node is copied into a ball of radius R (largest distance of a node in it)
if its distance to the pivot is at most R + r.  A cell's node may link with one in a cell of smaller
number if its distance to that pivot is at most the cell's radius + r, and if it is at most r behind
the hyperplane between the two pivots ((d_other^2 - d_own^2) / (2 |p - q|) <= r).  Copies go one way,
to balls before cells and to smaller numbers, so each pair meets in one place.

Each ball and cell then joins on its own.  Its nodes are split into blocks of about ``BLOCK`` rows, and
a pair of blocks is one task group, so no group outgrows a task.  A group emits per node the linked
weight, and edges that span the components it found, never its pairs.

Pivots come from a sample of at most ``SAMPLE`` nodes (a documented bound); they only steer the
work, results do not depend on them.  Where vectors are spread evenly over many dimensions no
bound prunes, and the join comes near to comparing all blocks with all blocks.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; neither do vectors of different length; repeated rows count each; null ids are kept and
count as largest; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_split, ship_package, written
from .components import connected_components

SAMPLE = 4096
BLOCK = 16384
TILE = 2048
MAX_BALLS = 512
MAX_CELLS = 256
DENSE = 4
SLACK = 1e-7


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (scaled by the largest component first: no overflow)."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def choose_pivots(sample: np.ndarray, n: int, r: float) -> tuple[np.ndarray, np.ndarray]:
    """Ball pivots (dense places of the sample, apart from each other) and general pivots."""
    around = np.concatenate([(distances(sample[i: i + 512], sample) <= r / 2).sum(axis=1)
                             for i in range(0, len(sample), 512)])
    balls: list[int] = []
    free = np.ones(len(sample), dtype=bool)
    for i in np.argsort(-around, kind="stable"):
        if around[i] < DENSE or len(balls) >= MAX_BALLS:
            break
        if free[i]:
            balls.append(int(i))
            free &= distances(sample[[i]], sample)[0] > r / 2
    want = min(MAX_CELLS, max(1, -(-n // BLOCK)))
    rest = np.flatnonzero(free)
    cells: list[int] = []
    for i in [*rest.tolist(), *range(len(sample))]:
        if len(cells) >= want:
            break
        if not cells or distances(sample[[i]], sample[cells]).min() > r:
            cells.append(i)
    return sample[balls], sample[cells]


class Partition:
    """Home, distance and copies of nodes under given pivots."""

    def __init__(self, balls: np.ndarray, cells: np.ndarray, r: float):
        self.r, self.n_balls = r, len(balls)
        self.pivots = np.concatenate([balls, cells])
        self.apart = distances(cells, cells)

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, distance to its pivot, and distances to all pivots of each row."""
        d = distances(x, self.pivots)
        place = self.n_balls + d[:, self.n_balls:].argmin(axis=1)
        if self.n_balls:
            ball = d[:, : self.n_balls].argmin(axis=1)
            inside = d[np.arange(len(x)), ball] <= self.r / 2 - SLACK
            place = np.where(inside, ball, place)
        return place, d[np.arange(len(x)), place], d

    def copies(self, place: np.ndarray, d: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """For each row and place, whether the row is copied there (radius -1: nothing lives there)."""
        out = (d <= radius[None, :] + self.r + SLACK) & (radius >= 0)[None, :]
        out &= np.arange(len(self.pivots))[None, :] < place[:, None]
        rows = np.flatnonzero(place >= self.n_balls)
        own = place[rows] - self.n_balls
        dc = d[rows, self.n_balls:]
        behind = dc ** 2 - (dc[np.arange(len(rows)), own] ** 2)[:, None]
        out[rows, self.n_balls:] &= behind <= 2 * self.apart[own] * (self.r + SLACK)
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def _spanning(a: np.ndarray, b: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) that connect what ``links`` connects between nodes a (rows) and b (columns)."""
    ia, ib = np.nonzero(links)
    ends = np.unique(np.concatenate([a[ia], b[ib]]))
    u, v = np.searchsorted(ends, a[ia]), np.searchsorted(ends, b[ib])
    label = np.arange(len(ends))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(ends))
    return ends[moved], ends[label[moved]]


def join_blocks(nodes: tuple[np.ndarray, np.ndarray], weights: tuple[np.ndarray, np.ndarray],
                vectors: tuple[np.ndarray, np.ndarray], cosine: float, same: bool):
    """Linked weight of each node on both sides, and spanning edges, by tiles of the product matrix."""
    got = [np.zeros(len(nodes[0]), dtype=np.int64), np.zeros(len(nodes[1]), dtype=np.int64)]
    edges = []
    for i in range(0, len(nodes[0]), TILE):
        for j in range(i if same else 0, len(nodes[1]), TILE):
            links = vectors[0][i: i + TILE] @ vectors[1][j: j + TILE].T >= cosine
            if same and i == j:
                links &= ~np.tri(len(links), dtype=bool)
            if not links.any():
                continue
            got[0][i: i + TILE] += links @ weights[1][j: j + TILE]
            got[1][j: j + TILE] += weights[0][i: i + TILE] @ links
            edges.append(_spanning(nodes[0][i: i + TILE], nodes[1][j: j + TILE], links))
    return got, edges


def _links_of_dim(nodes: DataFrame, n: int, cosine: float) -> DataFrame:
    """node, linked (weight of linked nodes), a, b: counts (a null) and spanning edges (linked null)."""
    spark = nodes.sparkSession
    r = math.sqrt(2 - 2 * cosine)
    picked = nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vector").toPandas()["vector"]
    sample = unit(np.frombuffer(b"".join(picked), dtype="<f8").reshape(len(picked), -1))
    part = Partition(*choose_pivots(sample, n, r), r)
    shipped = spark.sparkContext.broadcast(part)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column(2)))
                home, far, _ = shipped.value.home(x)
                packed = pa.array([v.tobytes() for v in x.astype("<f8")], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), packed, pa.array(home), pa.array(far)],
                    ["node", "weight", "vector", "place", "far"])

    placed = written(nodes.select("node", "weight", "vector").mapInArrow(
        place, "node long, weight long, vector binary, place long, far double"), "placed-vectors")
    places = len(part.pivots)
    # one row per pivot
    homes = placed.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"),
                                        F.sum("weight").alias("weight")).collect()
    radius, n_home = np.full(places, -1.0), np.zeros(places, dtype=np.int64)
    for row in homes:
        radius[row["place"]], n_home[row["place"]] = row["radius"], row["n"]

    def guests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                _, _, d = shipped.value.home(_matrix(batch.column(0)))
                total += shipped.value.copies(batch.column(1).to_numpy(), d, radius).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(places)), pa.array(total)], ["place", "n"])

    n_guest = np.zeros(places, dtype=np.int64)
    for row in (placed.select("vector", "place").mapInArrow(guests, "place long, n long")
                .groupBy("place").agg(F.sum("n").alias("n")).collect()):
        n_guest[row["place"]] = row["n"]
    home_blocks, guest_blocks = -(-n_home // BLOCK), -(-n_guest // BLOCK)
    n_balls = part.n_balls

    key = ["place", "kind", "a", "b"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A copy of each node for each pair of blocks it takes part in: group (place, kind, a, b), side."""
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes_, weights = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            home, (_, _, d) = batch.column(3).to_numpy(), shipped.value.home(_matrix(batch.column(2)))
            copied = shipped.value.copies(home, d, radius)
            turn = (nodes_ * 0x9E3779B1 >> 7) & 0x7FFFFFFF  # spreads nodes over blocks
            own = turn % home_blocks[home]
            at, c = np.nonzero(copied)
            every = np.arange(len(home))
            # own rows against own blocks (not in balls), against the guests' blocks, and as a guest
            for kind, rows, place_, mine, times in (
                    (0, every, home, own, np.where(home >= n_balls, home_blocks[home], 0)),
                    (1, every, home, own, guest_blocks[home]),
                    (2, at, c, turn[at] % np.maximum(guest_blocks[c], 1), home_blocks[c])):
                for i, other in _repeated(times):
                    take, one = rows[i], mine[i]
                    a, b, side = ((np.minimum(one, other), np.maximum(one, other), one > other) if kind == 0 else
                                  (one, other, other < 0) if kind == 1 else (other, one, other >= 0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place_[i]), pa.array(np.full(len(i), min(kind, 1))), pa.array(a), pa.array(b),
                         pa.array(side.astype(np.int64)), pa.array(nodes_[take]), pa.array(weights[take]),
                         batch.column(2).take(pa.array(take))], [*key, "side", "node", "weight", "vector"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def group(kind: int, a: int, b: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            side = table.column("side").to_numpy()
            columns = [table.column(c).to_numpy() for c in ("node", "weight")] + [
                np.concatenate([_matrix(c) for c in table.column("vector").chunks])]
            left = [c[side == 0] for c in columns]
            same = kind == 0 and a == b
            right = left if same else [c[side == 1] for c in columns]
            got, edges = join_blocks((left[0], right[0]), (left[1], right[1]), (left[2], right[2]), cosine, same)
            linked = [(left[0], got[0]), (right[0], got[1])]
            for ids, n_linked in linked:
                hit = n_linked > 0
                yield _out(ids[hit], n_linked[hit], None, None)
            for u, v in edges:
                yield _out(None, None, u, v)

        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in key])
            cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            for i, j in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
                now = tuple(keys[:, i].tolist())
                if last is not None and now != last:
                    yield from group(*last[1:], held)
                    held = []
                last = now
                held.append(batch.slice(i, j - i))
        if held:
            yield from group(*last[1:], held)

    schema = "node long, linked long, a long, b long"
    joined = (placed.select("node", "weight", "vector", "place").mapInArrow(
        deal, "place long, kind long, a long, b long, side long, node long, weight long, vector binary")
        .repartition(*key).sortWithinPartitions(*key).mapInArrow(join, schema))
    # nodes of one ball are all linked: by total weight, and by an edge to the ball's smallest node
    balls = placed.where(F.col("place") < n_balls)
    totals = balls.groupBy("place").agg(F.sum("weight").alias("total"), F.min("node").alias("root"))  # a row per ball
    inside = balls.select("node", "weight", "place").join(F.broadcast(totals), "place")
    return joined.unionByName(inside.select("node", (F.col("total") - F.col("weight")).alias("linked"),
                                            F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b"))) \
        .unionByName(inside.select(F.lit(None).cast("long").alias("node"), F.lit(None).cast("long").alias("linked"),
                                   F.col("node").alias("a"), F.col("root").alias("b")))


def _repeated(times: np.ndarray, rows: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Entry i ``times[i]`` times, as (entry, number of the repetition), in runs of at most ``rows``."""
    ends = np.cumsum(times)
    for k in range(0, int(ends[-1]) if len(ends) else 0, rows):
        turn = np.arange(k, min(k + rows, int(ends[-1])))
        i = np.searchsorted(ends, turn, side="right")
        yield i, turn - (ends[i] - times[i])


def _out(node, linked, a, b) -> pa.RecordBatch:
    n = len(node) if node is not None else len(a)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays([none if c is None else pa.array(c, pa.int64()) for c in (node, linked, a, b)],
                                      ["node", "linked", "a", "b"])


def near_duplicate_vectors(vectors: DataFrame, cosine: float = 0.9, vec_id: str = "vec_id",
                           embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links and component_id (smallest vec_id reachable) of every row."""
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    spark = vectors.sparkSession
    ship_package(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            x = lists.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0  # a null component is NaN here
            low, high = lists.offsets.to_numpy()[:-1], lists.offsets.to_numpy()[1:]
            odd, used = (np.concatenate([[0], np.cumsum(c)]) for c in (~np.isfinite(x), x != 0))
            good = lists.is_valid().to_numpy(zero_copy_only=False) & (odd[high] == odd[low]) & (used[high] > used[low])
            raw = memoryview(x.tobytes())
            out = [raw[8 * a: 8 * b] if g else None for g, a, b in zip(good.tolist(), low.tolist(), high.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vector"])

    rows = written(vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                                  F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
                   .mapInArrow(pack, "vec_id long, vector binary")
                   .withColumn("digest", F.sha2("vector", 256)), "vectors")
    nodes = written(rows.where(F.col("vector").isNotNull()).groupBy("digest").agg(
        F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"), F.min("vector").alias("vector"))
        .withColumn("dim", F.length("vector")).withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    sizes = nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per vector length
    found = None
    for row in sizes:
        part = written(_links_of_dim(nodes.where(F.col("dim") == row["dim"]), row["n"], cosine), "vector-links")
        found = part if found is None else found.unionByName(part)
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is None:
        return alone
    counts = found.where(F.col("node").isNotNull()).groupBy("node").agg(F.sum("linked").alias("linked"))
    roots = connected_components(found.where(F.col("a").isNotNull()).select("a", "b"))
    member = written(nodes.select("digest", "node", "weight", "first").join(counts, "node", "left")
                     .join(roots, "node", "left").select(
        "digest", "first", F.coalesce("root", "node").alias("root"),
        (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "vector-members")
    smallest = member.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = written(join_split(member, smallest, "root").select("digest", "n_links", "component_id"), "vector-classes")
    good = rows.where(F.col("vector").isNotNull()).select("vec_id", "digest").join(classes, "digest").select(
        "vec_id", "n_links", "component_id")
    bad = rows.where(F.col("vector").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad)

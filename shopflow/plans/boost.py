"""Rounds of boosting: one regression tree per class, grown level by level from histograms of binned rows.

State: a table with one row per block of up to ``BLOCK_ROWS`` training and validation rows; a block holds the rows'
bins (a byte per feature), labels, weights, keys and one margin per class as packed columns.  A level of all trees of
a round is one job: every task adds up gradient, weight and rows per (class, node, feature, bin) of its blocks, the
sums are shuffled by (class, feature), and a group gives its best split of every node.  The driver sees one row per
(class, feature, node) and the trees.  A round ends with one pass that adds the new leaves' values to the margins.

A table of up to ``ROWS_OF_ONE_TASK`` rows x classes is one task's work: it grows several rounds in one job, by the same functions.

Sums are made per part (a fixed deal of the rows by their hash) in the parts' order: the same rows, settings and
seed give the same trees on any cluster, and a run that goes on from a written state grows the trees of one that did not stop.
"""

from __future__ import annotations

import json
import pickle
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

TINY = 1e-6
BLOCK_ROWS, WORK_ROWS = 16_384, 131_072   # rows of a stored block; rows whose sums are made together
# a part sends classes x nodes x features x bins sums a level whatever its rows, so parts are large
ROWS_PER_PART, MIN_PARTS, ROWS_OF_ONE_TASK = 1_000_000, 12, 1_000_000  # the last: rows x classes
NODES = ("round int, cls int, id int, feature int, split array<double>, categories int, left int, right int, "
         "leaf int, value double, gain double, rows long, g double, h double")
STATE = "part int, block int, n int, bins binary, label binary, w binary, key binary, val binary, margins binary"
REDUCERS = 24   # tasks that add up the parts' sums; classes x features groups are dealt to them
DRIVER_BYTES = 16_000_000   # sums of a level (bins, not rows) the driver adds up itself, which saves a shuffle
CUT_ROUNDS, ONE_TASK_ROUNDS = 10, 50   # rounds after which the state is written (its lineage ends)


@dataclass(frozen=True)
class Settings:
    """What the tasks need to know.  ``loss``: softmax (second order, leaves by Newton steps) or logistic (every class
    against the others, leaves are mean residuals, as in MLlib's boosted trees; its first tree fits the labels -1, 1)."""
    loss: str
    classes: tuple[int, ...]
    widths: tuple[int, ...]      # bins per feature
    nominal: tuple[bool, ...]
    max_depth: int
    min_rows: int
    features_per_node: int
    rate: float                  # share of the rows in a sample
    sample_every: int            # rounds that share a sample
    step: float
    seed: int
    l1: float = 0.0
    l2: float = 0.0
    scored: bool = True          # whether there are validation rows

    @property
    def width(self) -> int:
        return max(self.widths)

    def value(self, g: float, h: float) -> float:
        if self.loss == "logistic":
            return g / h if h > 0 else 0.0
        shrunk = max(abs(g) - self.l1, 0.0)
        return self.step * (shrunk if g > 0 else -shrunk) / (h + self.l2) if h + self.l2 > 0 else 0.0

    def tree_weight(self, round_: int) -> float:
        return self.step if self.loss == "logistic" and round_ > 1 else 1.0


class Tree:
    """Nodes in the order they were made; a leaf (or a node still open) points to itself."""

    def __init__(self, width: int):
        self.width, self.feature, self.child, self.right = width, [-1], [0], [np.zeros(width, np.uint8)]
        self.sums: list[tuple[float, float, float]] = [(0.0, 0.0, 0.0)]
        self.gain, self.level, self.open = [-1.0], [0], [0]

    def split(self, node: int, feature: int, right: np.ndarray, left: tuple, gain: float) -> None:
        total = self.sums[node]
        self.feature[node], self.right[node], self.gain[node], self.child[node] = feature, right, gain, len(self.feature)
        for sums in (left, tuple(t - a for t, a in zip(total, left, strict=True))):
            self.child.append(len(self.feature))
            self.feature.append(-1)
            self.right.append(np.zeros(self.width, np.uint8))
            self.sums.append(sums)
            self.gain.append(-1.0)
            self.level.append(self.level[node] + 1)

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The node each row (a column of ``bins``) has come to."""
        n = bins.shape[1]
        at = np.zeros(n, np.int64)
        if len(self.feature) == 1:
            return at
        feature, child = np.maximum(np.array(self.feature), 0) * n, np.array(self.child)
        right, flat, rows = np.concatenate(self.right), bins.reshape(-1), np.arange(n)
        for _ in range(max(self.level)):
            at = child[at] + right[at * self.width + flat[feature[at] + rows]]
        return at


# ------------------------------------------------------------------ within a task
def sampled(key: np.ndarray, s: Settings, round_: int) -> np.ndarray:
    """Whether rows are in the sample of a round: a hash of the row's key, the seed and the period of rounds."""
    def mix(x):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    if s.rate >= 1.0:
        return np.ones(len(key), bool)
    with np.errstate(over="ignore"):
        period = np.array([((s.seed & 0xFFFFFFFF) << 32) + (round_ - 1) // s.sample_every + 1], np.uint64)
        share = mix(key.view(np.uint64) ^ mix(period * np.uint64(0x9E3779B97F4A7C15)))
    return (share >> np.uint64(11)).astype(np.float64) < s.rate * 2.0**53


def shares(s: Settings, margins: np.ndarray) -> np.ndarray:
    """(classes, rows) probabilities: softmax, or every class's own against the others."""
    if s.loss == "logistic":
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-2 * margins))
    e = np.exp(margins - margins.max(axis=0))
    return e / e.sum(axis=0)


def slopes(s: Settings, y: np.ndarray, w: np.ndarray, margins: np.ndarray, round_: int) -> tuple[np.ndarray, np.ndarray]:
    """(classes, rows) weighted targets and weights of the trees."""
    hit = y[None, :] == np.array(s.classes)[:, None]
    if s.loss == "logistic":
        sign = np.where(hit, 1.0, -1.0)
        with np.errstate(over="ignore"):
            z = sign if round_ == 1 else 4 * sign / (1 + np.exp(2 * sign * margins))
        return w * z, np.broadcast_to(w, z.shape)
    p = shares(s, margins)
    return w * (hit - p), w * np.maximum(p * (1 - p), TINY)


class Block:
    @classmethod
    def joined(cls, blocks: list[Block]) -> Block:
        """The rows of several blocks, in their order."""
        if len(blocks) == 1:
            return blocks[0]
        out = cls.__new__(cls)
        for name in ("bins", "y", "w", "key", "val", "margins"):
            setattr(out, name, np.concatenate([getattr(b, name) for b in blocks], axis=-1))
        return out

    def __init__(self, s: Settings, columns: Sequence):
        n, bins, y, w, key, val, margins = columns
        self.bins = np.frombuffer(bins, np.uint8 if s.width <= 256 else np.uint16).reshape(len(s.widths), n)
        self.y, self.w, self.key = np.frombuffer(y, np.int32), np.frombuffer(w), np.frombuffer(key, np.int64)
        self.val, self.margins = np.frombuffer(val, bool), np.frombuffer(margins).reshape(len(s.classes), n)

    def histograms(self, s: Settings, trees: list[Tree], round_: int) -> list[np.ndarray | None]:
        """Per class (sums, open nodes, features, bins): targets, weights and rows of the sampled training rows."""
        rows = np.flatnonzero(~self.val & sampled(self.key, s, round_))
        bins, width = np.ascontiguousarray(self.bins[:, rows]), s.width
        g, h = slopes(s, self.y[rows], self.w[rows], self.margins[:, rows], round_)
        plain = s.loss == "logistic" and bool((self.w[rows] == 1).all())  # weights add up to the rows
        out: list[np.ndarray | None] = []
        for tree, gk, hk in zip(trees, g, h, strict=True):
            if not tree.open:
                out.append(None)
                continue
            m = len(tree.open)
            slot = np.full(len(tree.feature), -1)
            slot[tree.open] = np.arange(m)
            at, b = slot[tree.nodes_of(bins)], bins
            if (at < 0).any():
                here = np.flatnonzero(at >= 0)
                at, b, gk, hk = at[here], bins[:, here], gk[here], hk[here]
            base, sums = at * width, np.empty((3, m, len(s.widths), width))
            for f in range(len(s.widths)):
                index = base + b[f]
                for i, x in enumerate((gk, None, None) if plain else (gk, hk, None)):
                    if not (plain and i == 1):
                        sums[i, :, f] = np.bincount(index, x, minlength=m * width).reshape(m, width)
            if plain:
                sums[1] = sums[2]
            out.append(sums)
        return out

    def moved(self, s: Settings, trees: list[Tree], round_: int) -> np.ndarray:
        """The margins with the trees of a round added."""
        out = self.margins.copy()
        for k, tree in enumerate(trees):
            values = np.array([s.value(g, h) for g, h, _ in tree.sums]) * s.tree_weight(round_)
            out[k] += values[tree.nodes_of(self.bins)]
        return out

    def scores(self, s: Settings) -> dict[int, tuple[int, int, float]]:
        """label -> validation rows, rows whose likeliest class it is, log loss."""
        if not self.val.any():
            return {}
        y, p = self.y[self.val], shares(s, self.margins[:, self.val])
        hit = y[None, :] == np.array(s.classes)[:, None]
        known = hit.any(axis=0)
        own = np.where(known, (p * hit).sum(axis=0), p[0] if s.loss == "softmax" else 0.0) / p.sum(axis=0)
        loss = -np.log(np.maximum(own, 1e-15))
        right = np.array(s.classes)[p.argmax(axis=0)] == y
        return {int(c): (int((y == c).sum()), int(right[y == c].sum()), float(loss[y == c].sum())) for c in np.unique(y)}


def best_splits(sums: np.ndarray, nominal: Sequence[bool], min_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From (sums, nodes, features, bins): per node and feature the greatest gain, the bins that go right and the sums
    of the rows that go left.  Categories are ordered by their mean target, empty ones last."""
    width = sums.shape[-1]
    order = np.broadcast_to(np.arange(width), sums.shape[1:])
    if any(nominal):
        with np.errstate(all="ignore"):
            mean = np.where(sums[2] > 0, sums[0] / sums[1], np.inf)
        order = np.where(np.array(nominal)[:, None], np.argsort(mean, axis=-1, kind="stable"), order)
        sums = np.take_along_axis(sums, order[None], axis=-1)
    left = np.cumsum(sums, axis=-1)
    total, left = left[..., -1:], left[..., :-1]
    right = total - left
    if width == 1:
        shape = sums.shape[1:3]
        return np.full(shape, -np.inf), np.zeros((*shape, 1), np.uint8), np.zeros((3, *shape))
    with np.errstate(all="ignore"):
        gain = left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - total[0] ** 2 / total[1]
    fits = (left[2] >= max(min_rows, 1)) & (right[2] >= max(min_rows, 1)) & (left[1] > 0) & (right[1] > 0)
    gain = np.where(fits, gain, -np.inf)
    cut = gain.argmax(axis=-1)[..., None]  # the first of equal gains
    goes = np.empty(order.shape, np.uint8)
    np.put_along_axis(goes, order, np.arange(width) > cut, axis=-1)
    return (np.take_along_axis(gain, cut, -1)[..., 0], goes, np.take_along_axis(left, cut[None], -1)[..., 0])


def grow(tree: Tree, cls: int, round_: int, s: Settings, total: np.ndarray, gain: np.ndarray, goes: np.ndarray, left: np.ndarray) -> None:
    """Splits the open nodes by the best of their features; the children are open if they may be split again."""
    nodes, n_features = tree.open, len(s.widths)
    if nodes == [0]:
        tree.sums[0] = tuple(float(x) for x in total[:, 0])
    tree.open = []
    for i, node in enumerate(nodes):
        mine = gain[i]
        if s.features_per_node < n_features:
            chosen = np.random.default_rng([s.seed & 0xFFFFFFFF, round_, cls, node]).permutation(n_features)[:s.features_per_node]
            mine = np.full(n_features, -np.inf)
            mine[chosen] = gain[i][chosen]
        f = int(mine.argmax())
        g, h, _ = tree.sums[node]
        if not mine[f] > 1e-12 * max(1.0, g * g / h if h > 0 else 0.0):  # equal targets: rounding only
            continue
        tree.split(node, f, goes[i, f].copy(), tuple(float(x) for x in left[:, i, f]), float(mine[f]))
        if tree.level[node] + 1 < s.max_depth:
            tree.open += [c for c in (tree.child[node], tree.child[node] + 1) if tree.sums[c][2] >= 2 * max(s.min_rows, 1)]


def add(into: list | None, sums: list) -> list:
    return sums if into is None else [a if b is None else b if a is None else a + b for a, b in zip(into, sums, strict=True)]


def metric_row(counts: Sequence[dict], classes: int) -> dict[str, float] | None:
    """Log loss, error and macro recall of the validation rows."""
    both: dict[int, tuple] = {}
    for part in counts:
        for label, x in part.items():
            both[label] = tuple(a + b for a, b in zip(both.get(label, (0, 0, 0.0)), x, strict=True))
    n = sum(x[0] for x in both.values())
    if not n:
        return None
    return {"multi_logloss": sum(x[2] for x in both.values()) / n, "multi_error": 1 - sum(x[1] for x in both.values()) / n,
            "macro_acc": sum(x[1] / x[0] for x in both.values()) / classes}


# ------------------------------------------------------------------ bins and blocks
def _thresholds(values: np.ndarray, max_bins: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Midpoints between distinct values, or between those at equal strides of the rows' weights if there are too many."""
    distinct, index = np.unique(values, return_inverse=True)
    if len(distinct) <= 1:
        return np.zeros(0)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(distinct) <= max_bins:
        return middle
    seen = np.cumsum(np.bincount(index, weights))
    stride, out = seen[-1] / max_bins, []
    target = stride
    for i in range(1, len(distinct)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out[:max_bins - 1])


def find_thresholds(table: DataFrame, features: Sequence[str], arity: dict[int, int], max_bins: int, n_rows: int) -> list[np.ndarray]:
    """Per feature the upper ends of its bins but the last (none for categories), from max_bins^2 training rows
    (10 000 at least), the number MLlib takes; every row is then binned and used."""
    share = min(1.0, max(max_bins * max_bins, 10_000) / max(n_rows, 1))
    rows = table.where(~F.col("_val"))
    if share < 1.0:
        rows = rows.where(F.pmod(F.xxhash64("_key", F.lit(17)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1))
    at = [f"_x{i}" for i in range(len(features)) if i not in arity]
    found = rows.select("w", *at).toArrow() if at else None
    return [np.zeros(0) if i in arity else _thresholds(found.column(f"_x{i}").to_numpy(), max_bins, found.column("w").to_numpy())
            for i in range(len(features))]


def parts_of(n_rows: int, classes: int) -> int:
    """Parts of a table; their number follows from the rows and classes alone."""
    return 1 if n_rows * classes <= ROWS_OF_ONE_TASK else max(-(-n_rows // ROWS_PER_PART), MIN_PARTS)


def _part_ids(spark: SparkSession, parts: int) -> list[int]:
    """Numbers that ``repartition(parts, "part")`` sends to different partitions."""
    ids = spark.range(50 * parts + 50).select(F.col("id").cast("int").alias("part"))
    seen = {r.p: r.part for r in ids.groupBy(F.pmod(F.hash("part"), F.lit(parts)).alias("p")).agg(F.min("part").alias("part")).collect()}
    return [seen[p] for p in sorted(seen)]


def dealt(state: DataFrame, parts: int) -> DataFrame:
    """A written state, one part a task, blocks in order."""
    return state.repartition(parts, "part").sortWithinPartitions("part", "block")


def rows_of(df: DataFrame, features: Sequence[str], label_col: str, weight, is_val: bool, arity: dict[int, int]) -> DataFrame:
    """label, w, _val and the features as numbers; missing values are -1, missing or unknown codes the last category."""
    def number(i: int, name: str):
        x = F.col(f"`{name}`").cast("double")
        if i in arity:
            return F.when(x.between(0, arity[i] - 2), F.floor(x)).otherwise(F.lit(arity[i] - 1)).cast("double")
        return F.when(x.isNull() | F.isnan(x), F.lit(-1.0)).otherwise(x)

    return df.select(F.col(label_col).cast("int").alias("label"), weight.cast("double").alias("w"), F.lit(is_val).alias("_val"),
                     *[number(i, f).alias(f"_x{i}") for i, f in enumerate(features)])


def blocks_of(table: DataFrame, thresholds: list[np.ndarray], widths: Sequence[int], arity: dict[int, int], parts: int,
              margins: Sequence[float]) -> DataFrame:
    """The state before the first round."""
    import pyarrow as pa

    spark, n_features, start, size = table.sparkSession, len(widths), list(margins), BLOCK_ROWS
    dtype = np.uint8 if max(widths) <= 256 else np.uint16
    ids = F.array(*[F.lit(i) for i in _part_ids(spark, parts)])
    part = F.element_at(ids, (F.pmod("_key", F.lit(parts)) + 1).cast("int")).alias("part")
    rows = table.select(part, "_key", "label", "w", "_val", *[f"_x{i}" for i in range(n_features)])
    rows = rows.repartition(parts, "part").sortWithinPartitions("part", "_key", "label", "w")

    def pack(part_id, number, t):
        n = t.num_rows
        for c in ("label", "w"):
            if t.column(c).null_count:
                raise ValueError(f"training rows have a null {c}")
        bins = np.empty((n_features, n), dtype)
        for i in range(n_features):
            x = t.column(f"_x{i}").to_numpy()
            bins[i] = x if i in arity else np.searchsorted(thresholds[i], x, side="left")
        raw = [bins, t.column("label").to_numpy().astype(np.int32), t.column("w").to_numpy().astype(np.float64),
               t.column("_key").to_numpy().astype(np.int64), t.column("_val").to_numpy().astype(bool),
               np.repeat(np.array(start), n)]
        return pa.RecordBatch.from_arrays([pa.array([part_id], pa.int32()), pa.array([number], pa.int32()), pa.array([n], pa.int32()),
                                           *[pa.array([a.tobytes()], pa.binary()) for a in raw]],
                                          ["part", "block", "n", "bins", "label", "w", "key", "val", "margins"])

    def run(batches):
        held, n, part_id, number = [], 0, None, 0
        for rb in batches:
            t = pa.Table.from_batches([rb])
            ends = np.flatnonzero(np.diff(t.column("part").to_numpy())) + 1
            for a, b in zip([0, *ends], [*ends, t.num_rows], strict=True):
                piece = t.slice(a, b - a)
                if not piece.num_rows:
                    continue
                here = piece.column("part")[0].as_py()
                if held and (here != part_id or n + piece.num_rows > size):
                    yield pack(part_id, number, pa.concat_tables(held))
                    held, n, number = [], 0, number + 1
                part_id = here
                held.append(piece)
                n += piece.num_rows
        if held:
            yield pack(part_id, number, pa.concat_tables(held))

    return rows.mapInArrow(run, STATE)


# ------------------------------------------------------------------ rounds
_COLUMNS = ("n", "bins", "label", "w", "key", "val", "margins")


def _blocks(batches, s: Settings):
    """(record batch, row, part, block number, block) of a task's state."""
    for rb in batches:
        for i in range(rb.num_rows):
            values = [rb.column(rb.schema.get_field_index(c))[i] for c in _COLUMNS]
            yield rb, i, rb.column(0)[i].as_py(), Block(s, [values[0].as_py(), *[v.as_buffer() for v in values[1:]]])


def _work(batches, s: Settings):
    """(part, rows): a part's blocks, put together up to ``WORK_ROWS`` rows."""
    held, at, n = [], None, 0
    for _, _, part, block in _blocks(batches, s):
        if held and (part != at or n + len(block.y) > WORK_ROWS):
            yield at, Block.joined(held)
            held, n = [], 0
        held, at, n = [*held, block], part, n + len(block.y)
    if held:
        yield at, Block.joined(held)


def _sorted_batches(table):
    """One record batch of a small table of sums, in the order in which they are added."""
    table = table.sort_by([("cls", "ascending"), ("feature", "ascending"), ("part", "ascending")]).combine_chunks()
    return table.to_batches()


def _level(state: DataFrame, s: Settings, trees: list[Tree], round_: int, parts: int) -> None:
    """One level of all trees: sums per part, best splits per (class, feature)."""
    import pyarrow as pa

    work, join = _work, add
    n_open, sizes = [len(t.open) for t in trees], s.widths

    def partial(batches):
        def out(part, sums):
            rows = [(c, f, x[:, :, f, :sizes[f]].tobytes()) for c, x in enumerate(sums) if x is not None for f in range(len(sizes))]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                               pa.array([part] * len(rows), pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
                                              ["cls", "feature", "part", "sums"])

        at, sums = None, None
        for part, block in work(batches, s):
            if at is not None and part != at:
                yield out(at, sums)
                sums = None
            at, sums = part, join(sums, block.histograms(s, trees, round_))
        if at is not None:
            yield out(at, sums)

    def best(batches):
        def out(c, f, total):
            total = total.reshape(3, n_open[c], 1, sizes[f])
            gain, goes, left = best_splits(total, [s.nominal[f]], s.min_rows)
            whole = total[:, :, 0].sum(axis=-1)
            return pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([f], pa.int32()), *[
                pa.array([x.tobytes()], pa.binary()) for x in (gain, goes, left, whole)]],
                ["cls", "feature", "gain", "goes", "left", "total"])

        at, total = None, None
        for rb in batches:
            for i in range(rb.num_rows):
                here, x = (rb.column(0)[i].as_py(), rb.column(1)[i].as_py()), np.frombuffer(rb.column(3)[i].as_buffer())
                if here == at:
                    total += x
                    continue
                if at is not None:
                    yield out(*at, total)
                at, total = here, x.copy()
        if at is not None:
            yield out(*at, total)

    sums = state.mapInArrow(partial, "cls int, feature int, part int, sums binary")
    if parts * sum(n_open) * sum(sizes) * 24 <= DRIVER_BYTES:
        found = [out for t in _sorted_batches(sums.toArrow()) for out in best([t])]
        rows = [r for t in found for r in t.to_pylist()]
    else:
        rows = [r.asDict() for r in sums.repartition(REDUCERS, "cls", "feature").sortWithinPartitions("cls", "feature", "part").mapInArrow(
            best, "cls int, feature int, gain binary, goes binary, left binary, total binary").collect()]
    for c, tree in enumerate(trees):
        mine = sorted((r for r in rows if r["cls"] == c), key=lambda r: r["feature"])
        if not tree.open:
            continue
        if not mine:  # no rows at all
            tree.open = []
            continue
        m = len(tree.open)
        goes = np.zeros((m, len(sizes), s.width), np.uint8)
        for r in mine:
            goes[:, r["feature"], :sizes[r["feature"]]] = np.frombuffer(r["goes"], np.uint8).reshape(m, -1)
        grow(tree, c, round_, s, np.frombuffer(mine[0]["total"]).reshape(3, m), np.stack([np.frombuffer(r["gain"]) for r in mine], axis=1),
             goes, np.stack([np.frombuffer(r["left"]).reshape(3, m) for r in mine], axis=2))


def _many_tasks(state: DataFrame, s: Settings, parts: int, first: int, last: int, curve: list, stop, target: str) -> tuple[DataFrame, list]:
    import pyarrow as pa

    blocks, grown, held = _blocks, [], [state.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        for round_ in range(first, last + 1):
            trees = [Tree(s.width) for _ in s.classes]
            while any(t.open for t in trees):
                _level(held[-1], s, trees, round_, parts)  # the first one fills the state
                while len(held) > 1:
                    held.pop(0).unpersist()

            def moved(batches, trees=trees, round_=round_):
                for rb, i, _, block in blocks(batches, s):
                    yield rb.slice(i, 1).set_column(rb.schema.get_field_index("margins"), "margins",
                                                    pa.array([block.moved(s, trees, round_).tobytes()], pa.binary()))

            def scores(batches):
                for _, _, _, block in blocks(batches, s):
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block.scores(s))], pa.binary())], ["counts"])

            held.append(held[-1].mapInArrow(moved, STATE).persist(StorageLevel.MEMORY_AND_DISK))
            grown.append(trees)
            if s.scored:
                counts = held[-1].mapInArrow(scores, "counts binary").collect()  # fills the new state; a row per block
                held.pop(0).unpersist()
                row = metric_row([pickle.loads(r.counts) for r in counts], len(s.classes))
                if row is not None:
                    curve.append(row)
            if stop is not None and stop(curve):
                break
        return _written(held[-1], parts, target), grown
    finally:
        for frame in held:
            frame.unpersist()


def _written(state: DataFrame, parts: int, target: str) -> DataFrame:
    state.write.parquet(target)
    return dealt(state.sparkSession.read.schema(STATE).parquet(target), parts)


def _one_task(state: DataFrame, s: Settings, parts: int, first: int, last: int, curve: list, stop, target: str) -> tuple[DataFrame, list]:
    import pyarrow as pa

    blocks, block, before = _blocks, Block, list(curve)

    def run(batches):
        held = [(rb.slice(i, 1), b) for rb, i, _, b in blocks(batches, s)]
        if not held:
            return
        whole = block.joined([b for _, b in held])
        seen, at = list(before), held[0][0].schema.get_field_index("margins")
        for round_ in range(first, last + 1):
            trees = [Tree(s.width) for _ in s.classes]
            while any(t.open for t in trees):
                sums = whole.histograms(s, trees, round_)
                for c, tree in enumerate(trees):
                    if tree.open:
                        grow(tree, c, round_, s, sums[c][:, :, 0].sum(axis=-1), *best_splits(sums[c], s.nominal, s.min_rows))
            whole.margins = whole.moved(s, trees, round_)
            row = metric_row([whole.scores(s)], len(s.classes))
            if row is not None:
                seen.append(row)
            names = held[0][0].schema
            yield pa.RecordBatch.from_arrays([pa.array([round_], pa.int32()), pa.array([pickle.dumps((trees, row))], pa.binary()),
                                              *[pa.nulls(1, f.type) for f in names]], ["round", "grown", *names.names])
            if stop is not None and stop(seen):
                break
        ends = np.cumsum([len(b.y) for _, b in held])
        for (rb, _), margins in zip(held, np.split(whole.margins, ends[:-1], axis=1), strict=True):
            rb = rb.set_column(at, "margins", pa.array([margins.tobytes()], pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), *rb.columns], ["round", "grown", *rb.schema.names])

    path = scratch_path(state.sparkSession, "boost-rounds")
    state.mapInArrow(run, f"round int, grown binary, {STATE}").write.parquet(path)
    out = state.sparkSession.read.schema(f"round int, grown binary, {STATE}").parquet(path)
    grown = []
    for r in out.where("round is not null").select("round", "grown").orderBy("round").collect():  # the trees of some rounds
        trees, row = pickle.loads(r.grown)
        grown.append(trees)
        if row is not None:
            curve.append(row)
    return _written(out.where("round is null").drop("round", "grown"), parts, target), grown


def advance(state: DataFrame, s: Settings, parts: int, first: int, last: int, curve: list,
            stop: Callable[[list], bool] | None = None, target: str | None = None) -> tuple[DataFrame, list[list[Tree]]]:
    """Rounds ``first`` to ``last``, ended early by ``stop(curve)``: (state, written to ``target``; trees per round and
    class).  Metrics of the validation rows are appended to ``curve``.  ``last - first`` is bounded by the caller."""
    target = target or scratch_path(state.sparkSession, "boost-state")
    return (_one_task if parts == 1 else _many_tasks)(state, s, parts, first, last, curve, stop, target)


def chunk_rounds(parts: int) -> int:
    return ONE_TASK_ROUNDS if parts == 1 else CUT_ROUNDS


# ------------------------------------------------------------------ trees as tables and as MLlib models
def ordered_nodes(tree: Tree, thresholds: list[np.ndarray], s: Settings) -> tuple[list[dict], list[int]]:
    """Nodes in pre-order (the order of MLlib's node ids), leaves counted from the left, and each one's number in ``tree``."""
    nodes: list[dict] = []
    made: list[int] = []
    leaves = 0

    def read(i: int) -> int:
        nonlocal leaves
        me, f = len(nodes), tree.feature[i]
        node = {"feature": f, "split": [], "categories": -1, "left": -1, "right": -1, "leaf": -1}
        nodes.append(node)
        made.append(i)
        if f < 0:
            node["leaf"], leaves = leaves, leaves + 1
            return me
        left = np.flatnonzero(tree.right[i][:s.widths[f]] == 0)
        if s.nominal[f]:
            node["split"], node["categories"] = [float(c) for c in left], 0
        else:
            node["split"] = [float(thresholds[f][left[-1]])]
        node["left"] = read(tree.child[i])
        node["right"] = read(tree.child[i] + 1)
        return me

    read(0)
    return nodes, made


def node_rows(tree: Tree, round_: int, cls: int, thresholds: list[np.ndarray], s: Settings) -> list[tuple]:
    """Rows of ``NODES``; gains are per weight, as MLlib's."""
    nodes, made = ordered_nodes(tree, thresholds, s)
    rows = []
    for i, (n, m) in enumerate(zip(nodes, made, strict=True)):
        g, h, count = tree.sums[m]
        gain = tree.gain[m] / h if n["leaf"] < 0 else -1.0
        arity = s.widths[n["feature"]] if n["categories"] >= 0 else -1
        rows.append((round_, cls, i, n["feature"], n["split"], arity, n["left"], n["right"], n["leaf"], s.value(g, h), gain, int(count), g, h))
    return rows


def write_nodes(spark: SparkSession, rows: list[tuple], path: str) -> None:
    spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(path)


def _metadata(cls: str, uid: str, spark: SparkSession, **more) -> str:
    return json.dumps({"class": cls, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
                       "paramMap": {}, "defaultParamMap": {}, **more})


def save_model(spark: SparkSession, nodes: DataFrame, rounds: int, n_features: int, path: str, kind: str, uid: str,
               param_map: dict | None = None, later_weight: float = 1.0) -> None:
    """The trees of the first ``rounds`` rounds of one class as a saved MLlib ensemble (``kind``: its class)."""
    leaf, tree_params = F.col("leaf") >= 0, {"impurity": "variance"}
    node = F.struct(F.col("id"), F.col("value").alias("prediction"), F.lit(0.0).alias("impurity"),
                    F.array("h", "g", F.lit(0.0)).alias("impurityStats"), F.col("rows").alias("rawCount"), F.col("gain").alias("gain"),
                    F.col("left").alias("leftChild"), F.col("right").alias("rightChild"),
                    F.struct(F.col("feature").alias("featureIndex"),
                             F.when(leaf, F.array().cast("array<double>")).otherwise(F.col("split")).alias("leftCategoriesOrThreshold"),
                             F.col("categories").alias("numCategories")).alias("split"))
    kept = nodes.where(F.col("round") <= rounds)
    kept.select((F.col("round") - 1).alias("treeID"), node.alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    tree = _metadata("org.apache.spark.ml.regression.DecisionTreeRegressionModel", f"dtr_{uid}", spark, paramMap=tree_params)
    weight = F.when(F.col("id") == 0, F.lit(1.0)).otherwise(F.lit(float(later_weight)))
    (spark.range(rounds).select(F.col("id").cast("int").alias("_1"), F.lit(tree).alias("_2"), weight.alias("_3"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/treesMetadata"))
    whole = _metadata(kind, uid, spark, paramMap=tree_params | (param_map or {}), numFeatures=n_features, numTrees=rounds)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

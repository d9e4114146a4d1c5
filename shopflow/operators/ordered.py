"""Exact order-dependent results without a single-partition window.

Spark windows need every row of a partition key in one task, and a window with no
partition key runs in one task.  For global ranks, running sums and "previous row
of the same key" we instead:

1. range-partition on the full ordering (so a hot key is spread over many blocks),
2. sort each block and tag rows with ``_blk`` (block number) and ``_seq`` (position in the block),
3. write the tagged rows as a Parquet table in the shared folder, so the tags stay fixed if a task is
   re-run or an executor is lost, and later scans read only the columns they need,
4. combine per-block totals (one row per block, broadcast) into offsets.

The ordering columns must identify a row uniquely within a group, so the result is
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

BLK, SEQ = "_blk", "_seq"


def range_blocks(df: DataFrame, order_cols: Sequence[str], num_blocks: int | None = None) -> DataFrame:
    """Range-partitioned, block-sorted copy of ``df`` tagged with ``_blk`` and ``_seq``, as a written table.

    Without ``num_blocks`` the range exchange is left to AQE, which merges small
    neighbouring ranges (order is kept: merged blocks stay contiguous), so the block
    count follows the data size; tags are taken after that, inside the writing stage.
    """
    pid = F.spark_partition_id()
    parted = (df.repartitionByRange(num_blocks, *order_cols) if num_blocks
              else df.repartitionByRange(*order_cols))
    tagged = (parted
              .sortWithinPartitions(*order_cols)
              .withColumn(BLK, pid)
              .withColumn(SEQ, F.monotonically_increasing_id() - pid.cast("long") * F.lit(1 << 33)))
    path = scratch_path(df.sparkSession, "range-blocks")
    tagged.write.parquet(path)
    return df.sparkSession.read.schema(tagged.schema).parquet(path)


def _exclusive_running(df: DataFrame, order: str | list, cols: dict[str, Column]) -> DataFrame:
    """Exclusive running sums over a small table (one row per block or per group)."""
    w = Window.orderBy(*([order] if isinstance(order, str) else order)).rowsBetween(Window.unboundedPreceding, -1)
    return df.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(name) for name, c in cols.items()])


def _join_groups(df: DataFrame, small: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    cond = None
    renamed = small
    for g in group_cols:
        renamed = renamed.withColumnRenamed(g, f"_g_{g}")
    for g in group_cols:
        c = df[g].eqNullSafe(renamed[f"_g_{g}"])
        cond = c if cond is None else cond & c
    out = df.join(F.broadcast(renamed), cond, "left")
    return out.drop(*[f"_g_{g}" for g in group_cols])


def positions(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
              pos_col: str = "_pos", num_blocks: int | None = None) -> DataFrame:
    """Add the 1-based position of each row within its group, in ``order_cols`` order.

    ``group_cols`` must have few distinct values (their offsets are broadcast).
    """
    keys = [*group_cols, *order_cols]
    tagged = range_blocks(df, keys, num_blocks)
    blk = _exclusive_running(tagged.groupBy(BLK).agg(F.count(F.lit(1)).alias("_bn")), BLK,
                             {"_boff": F.col("_bn")}).drop("_bn")
    out = tagged.join(F.broadcast(blk), BLK)
    pos = F.col("_boff") + F.col(SEQ) + 1
    if group_cols:
        grp = _exclusive_running(tagged.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_gn")),
                                 list(group_cols), {"_goff": F.col("_gn")}).drop("_gn")
        out = _join_groups(out, grp, group_cols)
        pos = pos - F.col("_goff")
    return out.withColumn(pos_col, pos).drop(BLK, SEQ, "_boff", "_goff")


def prefix_sums(df: DataFrame, order_cols: Sequence[str], value_cols: Sequence[str],
                group_cols: Sequence[str] = (), prefix: str = "before_",
                num_blocks: int | None = None) -> DataFrame:
    """Add ``before_<v>``: the sum of ``v`` over earlier rows of the same group (exclusive)."""
    keys = [*group_cols, *order_cols]
    tagged = range_blocks(df, keys, num_blocks)
    w_in = Window.partitionBy(BLK).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, -1)
    inner = tagged.select("*", *[F.coalesce(F.sum(v).over(w_in), F.lit(0)).alias(f"_in_{v}") for v in value_cols])
    blk_tot = tagged.groupBy(BLK).agg(*[F.sum(v).alias(f"_bt_{v}") for v in value_cols])
    blk = _exclusive_running(blk_tot, BLK, {f"_bo_{v}": F.col(f"_bt_{v}") for v in value_cols})
    out = inner.join(F.broadcast(blk.drop(*[f"_bt_{v}" for v in value_cols])), BLK)
    exprs = {v: F.col(f"_in_{v}") + F.col(f"_bo_{v}") for v in value_cols}
    if group_cols:
        grp_tot = tagged.groupBy(*group_cols).agg(*[F.sum(v).alias(f"_gt_{v}") for v in value_cols])
        grp = _exclusive_running(grp_tot, list(group_cols), {f"_go_{v}": F.col(f"_gt_{v}") for v in value_cols})
        out = _join_groups(out, grp.drop(*[f"_gt_{v}" for v in value_cols]), group_cols)
        exprs = {v: e - F.col(f"_go_{v}") for v, e in exprs.items()}
    out = out.select("*", *[e.alias(f"{prefix}{v}") for v, e in exprs.items()])
    drop = [BLK, SEQ] + [f"_in_{v}" for v in value_cols] + [f"_bo_{v}" for v in value_cols] \
        + [f"_go_{v}" for v in value_cols]
    return out.drop(*[c for c in drop if c in out.columns])


def previous_in_group(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str],
                      value_cols: Sequence[str], prefix: str = "prev_",
                      num_blocks: int | None = None) -> DataFrame:
    """Add ``prev_<v>``: ``v`` of the previous row with the same key in ``order_cols`` order.

    Skew-safe replacement for ``lag(v).over(partitionBy(key).orderBy(order))``: a key
    holding a third of all rows is spread over many range blocks.  Inside a block the
    lag is an ordinary window on ``_blk``; only the first row of a block can have its
    predecessor in an earlier block, and that comes from a one-row-per-block table.
    """
    keys = [*key_cols, *order_cols]
    tagged = range_blocks(df, keys, num_blocks)
    key = F.struct(*[F.col(k) for k in key_cols])
    vals = F.struct(*[F.col(v).alias(v) for v in value_cols])
    w = Window.partitionBy(BLK).orderBy(SEQ)
    inner = tagged.withColumns({"_pkey": F.lag(key).over(w), "_pval": F.lag(vals).over(w)})
    last = tagged.groupBy(BLK).agg(F.max_by(F.struct(key.alias("k"), vals.alias("v")), F.col(SEQ)).alias("_last"))
    carry = last.select(BLK, F.lag("_last").over(Window.orderBy(BLK)).alias("_carry"))
    out = inner.join(F.broadcast(carry), BLK)
    first = F.col(SEQ) == 0
    key_known = F.lit(True)
    for k in key_cols:
        key_known = key_known & F.col(k).isNotNull()
    same_in = key_known & F.col("_pkey").eqNullSafe(key)
    same_carry = key_known & F.col("_carry.k").eqNullSafe(key)
    cols = {}
    for v in value_cols:
        cols[f"{prefix}{v}"] = (F.when(~first & same_in, F.col(f"_pval.{v}"))
                                .when(first & same_carry, F.col(f"_carry.v.{v}")))
    return out.withColumns(cols).drop(BLK, SEQ, "_pkey", "_pval", "_carry")

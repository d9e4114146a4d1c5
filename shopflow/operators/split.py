"""Exact, seeded, two-stage stratified split without a global sort.

Each row gets a key ``md5('<seed>:<row_id>')``.  Within a stratum rows are taken in key
order; the rank of a row is (rows of the stratum in smaller hash buckets) + its row
number inside its bucket.  Buckets are the first five hex digits of the key, so they
are uniform, never larger than about N / 1M rows, and the per-bucket count table is
bounded by 2^20 rows per stratum.

Sizes follow the usual stratified rule: the first stage keeps ``floor(train * N)``
rows, shared over strata by largest remainder (ties to the lower stratum); the rest
is split again with ``test / (test + val)``.

Rows with a NULL id are keyed by the hash of their other columns and their place in the order of those
hashes, so equal rows spread over buckets like any others, and which of them goes where makes no difference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .ordered import positions

BUCKET_HEX_DIGITS = 5


def split_key(row_id: Column, seed: int, fallback: Column | None = None) -> Column:
    """Key of a row; a NULL id takes ``fallback`` (a text made from the row itself) in its place."""
    text = row_id.cast("string")
    if fallback is not None:
        text = F.coalesce(text, F.concat(F.lit("null:"), fallback))
    return F.md5(F.concat(F.lit(f"{seed}:"), text))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other; the right side's key columns are dropped."""
    named = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(named, cond, how).drop(*[f"_r_{k}" for k in keys])


def _allocate(counts: DataFrame, stratum: str, n_col: str, total_draws: Column, out: str) -> DataFrame:
    """Largest-remainder share of ``total_draws`` over strata (tiny table, one row per stratum)."""
    w_all = Window.partitionBy()
    cont = F.col(n_col).cast("double") / F.sum(n_col).over(w_all).cast("double") * total_draws.cast("double")
    t = counts.withColumn("_cont", cont).withColumn("_base", F.floor("_cont").cast("long"))
    t = t.withColumn("_extra", total_draws.cast("long") - F.sum("_base").over(w_all))
    t = t.withColumn("_rr", F.row_number().over(Window.orderBy(F.desc(F.col("_cont") - F.col("_base")), F.col(stratum))))
    t = t.withColumn(out, F.col("_base") + F.when(F.col("_rr") <= F.col("_extra"), 1).otherwise(0))
    return t.drop("_cont", "_base", "_extra", "_rr")


def _number_null_ids(df: DataFrame, id_col: str) -> DataFrame:
    """``df`` with ``_null_no``: for rows with a NULL id their place in hash order, else NULL.

    Only those rows are written and ranked; a log without them costs one look at its ids.
    """
    plain = df.where(F.col(id_col).isNotNull()).withColumn("_null_no", F.lit(None).cast("string"))
    nulls = df.where(F.col(id_col).isNull())
    if nulls.isEmpty():
        return plain
    others = [F.col(f"`{c}`") for c in df.columns if c != id_col]
    tagged = nulls.withColumns({"_h": F.xxhash64(*others) if others else F.lit(0).cast("long"),
                                "_m": F.monotonically_increasing_id()})
    path = scratch_path(df.sparkSession, "null-ids")
    tagged.write.parquet(path)
    numbered = positions(df.sparkSession.read.schema(tagged.schema).parquet(path), ["_h", "_m"], pos_col="_null_no")
    return plain.unionByName(numbered.withColumn("_null_no", F.concat_ws(":", "_h", "_null_no")).drop("_h", "_m"))


def stratified_split(df: DataFrame, ratios: tuple[float, float, float] = (0.7, 0.15, 0.15),
                     stratum: str = "target", seed: int = 42, id_col: str = "row_id",
                     split_col: str = "split") -> DataFrame:
    """Add ``split`` in {'train', 'test', 'val'} with exact per-stratum sizes.

    Every input row is in the result: a NULL stratum is a stratum of its own, and rows with a NULL id
    are keyed by the hash of their other columns and their place in its order.
    """
    train, test, val = ratios
    if abs(train + test + val - 1.0) >= 1e-10:
        raise ValueError("train, test and val ratios must sum to 1")
    keyed = _number_null_ids(df, id_col).withColumn(
        "_key", split_key(F.col(id_col), seed, F.col("_null_no")))
    keyed = keyed.withColumn(
        "_bucket", F.conv(F.substring("_key", 1, BUCKET_HEX_DIGITS), 16, 10).cast("long"))
    # one row per (stratum, bucket): exclusive prefix of earlier buckets in the stratum
    buckets = keyed.groupBy(stratum, "_bucket").agg(F.count(F.lit(1)).alias("_bn"))
    # per-stratum sizes for both stages, from the bucket counts (no further pass over the rows)
    strata = buckets.groupBy(stratum).agg(F.sum("_bn").alias("_n"))
    wb = Window.partitionBy(stratum).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("_bn").over(wb), F.lit(0))).drop("_bn")
    total = F.sum("_n").over(Window.partitionBy())
    strata = _allocate(strata, stratum, "_n", F.floor(F.lit(train) * total), "_n_train")
    strata = strata.withColumn("_n_rest", F.col("_n") - F.col("_n_train"))
    rest_total = F.sum("_n_rest").over(Window.partitionBy())
    strata = _allocate(strata, stratum, "_n_rest", F.floor(F.lit(test / (test + val)) * rest_total), "_n_test")
    ranked = null_safe_join(keyed, buckets, [stratum, "_bucket"])
    rn = F.row_number().over(Window.partitionBy(stratum, "_bucket").orderBy("_key", id_col))
    ranked = ranked.withColumn("_rank", F.col("_before") + rn)
    ranked = null_safe_join(ranked, F.broadcast(strata.select(stratum, "_n_train", "_n_test")), [stratum])
    label = (F.when(F.col("_rank") <= F.col("_n_train"), F.lit("train"))
             .when(F.col("_rank") <= F.col("_n_train") + F.col("_n_test"), F.lit("test"))
             .otherwise(F.lit("val")))
    return ranked.withColumn(split_col, label).drop("_key", "_bucket", "_before", "_rank", "_n_train", "_n_test", "_null_no")


def split_report(df: DataFrame, split_col: str = "split", target: str = "target") -> DataFrame:
    """Rows and positive share per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"), F.avg(target).alias("positive_ratio"))

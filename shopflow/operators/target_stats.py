"""Ordered target statistics: a category column with many values as numbers that do not leak a row's own target.

Rows are put in a seeded order; a row's value is the smoothed mean of the target over the earlier rows of its
category only.  Rows that are scored later get the mean over all training rows.

The running sums need no window over a category: rows are range-partitioned by (category, order), so a category that holds a
third of all rows lies in many blocks, running sums over all rows come from block totals, and what lies before a
category is the running sum over the (one row per category) totals, joined so that hot categories can be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import prefix_sums
from .stats import attach

KEY = "_category"


def _category(col: str) -> Column:
    """The column as a key in which a missing value is a category of its own."""
    return F.coalesce(F.concat(F.lit("v"), F.col(col).cast("string")), F.lit("n"))


def category_totals(df: DataFrame, col: str, target: str = "target") -> DataFrame:
    """(_category, target_sum, rows) per category."""
    return df.groupBy(_category(col).alias(KEY)).agg(F.sum(target).cast("double").alias("target_sum"), F.count(F.lit(1)).alias("rows"))


def running_target_sums(df: DataFrame, col: str, target: str = "target", id_col: str = "row_id", seed: int = 42) -> DataFrame:
    """``df`` with ``sum_before`` and ``rows_before``: target sum and number of earlier rows of the row's category, in the order
    of ``md5(seed:id)`` (ties by id; ids must be unique)."""
    keyed = df.select("*", _category(col).alias(KEY), F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))).alias("_order"),
                      F.col(target).cast("double").alias("_y"), F.lit(1).cast("long").alias("_one"))
    running = prefix_sums(keyed, [KEY, "_order", id_col], ["_y", "_one"])
    offsets = prefix_sums(category_totals(df, col, target), [KEY], ["target_sum", "rows"]).select(
        KEY, F.col("before_target_sum").alias("_y0"), F.col("before_rows").alias("_n0"))
    out = attach(running, offsets, KEY)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("before__y") - F.col("_y0")).alias("sum_before"),
                      (F.col("before__one") - F.col("_n0")).cast("long").alias("rows_before"))


def smoothed(total: Column, n: Column, prior: float, weight: float = 1.0) -> Column:
    return (total + F.lit(prior * weight)) / (n + F.lit(weight))


def encode_ordered(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str], target: str = "target", id_col: str = "row_id",
                   seed: int = 42, weight: float = 1.0) -> list[DataFrame]:
    """``train`` and ``others`` with ``<col>_target``: the ordered statistic for training rows, the whole training
    category's for the others (the prior, the training mean, for categories they alone have)."""
    prior = float(train.agg(F.avg(target)).first()[0] or 0.0)
    out = [train, *others]
    for col in cols:
        first = running_target_sums(out[0], col, target, id_col, seed)
        first = first.withColumn(f"{col}_target", smoothed(F.col("sum_before"), F.col("rows_before"), prior, weight))
        totals = category_totals(train, col, target)
        rest = []
        for df in out[1:]:
            joined = attach(df.withColumn(KEY, _category(col)), totals, KEY)
            value = smoothed(F.coalesce("target_sum", F.lit(0.0)), F.coalesce("rows", F.lit(0)), prior, weight)
            rest.append(joined.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(f"{col}_target")))
        out = [first.drop("sum_before", "rows_before"), *rest]
    return out

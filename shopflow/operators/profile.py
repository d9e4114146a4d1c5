"""Class balance, class weights and dataset profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fill import numeric_columns, text_columns
from ..functions.labels import action_name
from .ordered import positions, prefix_sums


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per class, with the class name."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    share = F.col("count") / F.sum("count").over(Window.partitionBy())
    return counts.select(label, action_name(F.col(label)).alias("action_name"), "count", share.alias("share"))


def positive_ratio(df: DataFrame, target: str = "target") -> DataFrame:
    return df.agg(F.avg(target).alias("positive_ratio"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``sqrt(N / (K * n_c)) * (1 + ln(N / n_c))`` with K the number of classes present."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_count"))
    w = Window.partitionBy()
    n, k = F.sum("class_count").over(w), F.count(F.lit(1)).over(w)
    ratio = n.cast("double") / F.col("class_count").cast("double")
    weight = F.sqrt(n.cast("double") / (k.cast("double") * F.col("class_count").cast("double"))) * (1 + F.log(ratio))
    return counts.select(label, "class_count", weight.alias("weight"))


def row_weights(df: DataFrame, label: str = "label", weight_col: str = "weight") -> DataFrame:
    """Attach the class weight to every row (the weight table has one row per class)."""
    weights = class_weights(df, label).select(label, F.col("weight").alias(weight_col))
    return df.join(F.broadcast(weights), label, "left")


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """min, max, mean and exact median per numeric column (missing values skipped).

    The median comes from per-value counts and range-partitioned prefix sums, so no
    column's values are ever gathered in one task.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                         for c in cols])).alias("_cv")).select("_cv.column", "_cv.value")
    long = long.where(F.col("value").isNotNull())
    basic = long.groupBy("column").agg(F.min("value").alias("min"), F.max("value").alias("max"),
                                       F.avg("value").alias("mean"), F.count(F.lit(1)).alias("_n"))
    per_value = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))
    cum = prefix_sums(per_value, ["value"], ["_c"], ["column"], prefix="_b")
    cum = cum.join(F.broadcast(basic.select("column", "_n")), "column")
    # 1-based middle ranks lo = floor((n+1)/2), hi = ceil((n+1)/2)
    lo = F.floor((F.col("_n") + 1) / 2)
    hi = F.ceil((F.col("_n") + 1) / 2)
    covers = lambda r: (F.col("_b_c") < r) & (F.col("_b_c") + F.col("_c") >= r)
    mids = cum.where(covers(lo) | covers(hi)).groupBy("column").agg(
        F.max(F.when(covers(lo), F.col("value"))).alias("_lo"),
        F.max(F.when(covers(hi), F.col("value"))).alias("_hi"))
    med = mids.select("column", ((F.col("_lo") + F.col("_hi")) / 2).alias("median"))
    return basic.join(med, "column", "left").select("column", "min", "max", "mean", "median")


def categorical_profile(df: DataFrame, cols: Sequence[str] | None = None, order_col: str = "row_id") -> DataFrame:
    """Distinct values per text column in first-seen order: (column, value, position)."""
    cols = list(cols) if cols is not None else [c for c in text_columns(df)]
    parts = [df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.col(order_col).alias("_o"))
             for c in cols]
    vals = reduce(lambda a, b: a.unionByName(b), parts)
    first = vals.groupBy("column", "value").agg(F.min("_o").alias("_first"))
    ranked = positions(first, ["_first"], ["column"], pos_col="position")
    return ranked.select("column", "value", (F.col("position") - 1).cast("int").alias("position"))


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))

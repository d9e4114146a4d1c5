"""Categorical label encoding: fit a dictionary (value -> code), apply it with joins.

Dictionaries hold the distinct values of a few columns.  Codes are exact ranks from
``positions`` (range-partitioned, no single-partition window).  A dictionary is
broadcast only when its measured size is under ``BROADCAST_MAX_ENTRIES``; larger ones
use a shuffle join, with AQE splitting hot values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import positions

BROADCAST_MAX_ENTRIES = 2_000_000

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _finish(ranked: DataFrame) -> DataFrame:
    """Final (column, value, code) table, checkpointed: small, scanned by every column's join."""
    out = ranked.select("column", "value", (F.col("_pos") - 1).cast("int").alias("code"))
    return out.checkpoint(eager=True)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def fit_sorted_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, code): values cast to text, code = rank of the byte-order sorted values - 1."""
    cols = _present(df, cols)
    vals = _union([df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    vals = vals.where(F.col("value").isNotNull()).distinct()
    return _finish(positions(vals, ["value"], ["column"], pos_col="_pos"))


def fit_native_dictionary(dfs: Sequence[DataFrame], cols: Sequence[str]) -> DataFrame:
    """Dictionary over the union of ``dfs`` ordered by the column's own type (numbers numerically).

    Missing values get the code after the last value (``null_code``).
    """
    first = dfs[0]
    cols = _present(first, cols)
    types = {f.name: f.dataType for f in first.schema.fields}
    parts = []
    for c in cols:
        numeric = isinstance(types[c], _NUMERIC)
        for d in dfs:
            parts.append(d.select(
                F.lit(c).alias("column"),
                (F.col(c).cast("double") if numeric else F.lit(None).cast("double")).alias("num"),
                (F.lit(None).cast("string") if numeric else F.col(c).cast("string")).alias("txt"),
                F.col(c).cast("string").alias("value")))
    vals = _union(parts).where(F.col("value").isNotNull()).distinct()
    return _finish(positions(vals, ["num", "txt"], ["column"], pos_col="_pos"))


def fit_first_seen_dictionary(df: DataFrame, cols: Sequence[str], order_col: str = "row_id") -> DataFrame:
    """(column, value, code): code = order of first appearance by ``order_col``."""
    cols = _present(df, cols)
    vals = _union([df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                             F.col(order_col).alias("_o")) for c in cols])
    first = vals.groupBy("column", "value").agg(F.min("_o").alias("_first"))
    return _finish(positions(first, ["_first", "value"], ["column"], pos_col="_pos"))


def dictionary_sizes(dictionary: DataFrame) -> dict[str, int]:
    """Entries per column (a tiny aggregate) -- the size check behind each broadcast."""
    return {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}


def apply_dictionary(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], unseen: int = -1,
                     null_code: str | None = None, sizes: dict[str, int] | None = None) -> DataFrame:
    """Replace each column by its code; values not in the dictionary get ``unseen``.

    ``null_code='last'`` gives missing values the code after the last entry.
    """
    cols = _present(df, cols)
    sizes = sizes if sizes is not None else dictionary_sizes(dictionary)
    out = df
    for c in cols:
        d = dictionary.where(F.col("column") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_k_{c}"))
        if sizes.get(c, 0) <= BROADCAST_MAX_ENTRIES:
            d = F.broadcast(d)
        out = out.join(d, out[c].cast("string") == d[f"_v_{c}"], "left")
        code = F.col(f"_k_{c}")
        if null_code == "last":
            code = F.when(F.col(c).isNull(), F.lit(sizes.get(c, 0))).otherwise(code)
        out = out.withColumn(c, F.coalesce(code, F.lit(unseen)).cast("int")).drop(f"_v_{c}", f"_k_{c}")
    return out


def label_encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sorted text encoding fitted on ``df`` itself (one dictionary per call)."""
    dictionary = fit_sorted_dictionary(df, cols)
    return apply_dictionary(df, dictionary, cols)


def label_encode_joint(dfs: Sequence[DataFrame], cols: Sequence[str]) -> list[DataFrame]:
    """One native-order dictionary over all ``dfs``, applied to each of them."""
    dictionary = fit_native_dictionary(dfs, cols)
    sizes = dictionary_sizes(dictionary)
    return [apply_dictionary(d, dictionary, cols, null_code="last", sizes=sizes) for d in dfs]


def label_encode_frozen(df: DataFrame, reference: DataFrame, cols: Sequence[str], order: str = "sorted",
                        order_col: str = "row_id") -> DataFrame:
    """Encode ``df`` with a dictionary fitted on ``reference``; unseen values -> -1."""
    if order == "sorted":
        dictionary = fit_sorted_dictionary(reference, cols)
    elif order == "first_seen":
        dictionary = fit_first_seen_dictionary(reference, cols, order_col)
    else:
        raise ValueError(f"unknown order {order!r}")
    return apply_dictionary(df, dictionary, cols)

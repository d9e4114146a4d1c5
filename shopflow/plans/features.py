"""Whole feature pipelines, each built once.

``base_features``  the 22-feature path: clean time text -> parse -> time parts -> typed
fill -> sorted label encoding -> user and item statistics -> fixed projection.
``rich_features``  the rich path: time parts, weekend, hour bucket -> user / item /
shop statistic families -> ratios -> per-user sequence features -> numeric zero fill.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fill import fill_missing_typed, fill_missing_zero
from ..functions.time import (LOG_SHAPE, clean_time_text, hour_bucket, infer_time_shape, parse_time_coerce,
                              parse_time_free, parse_time_strict, time_parts, weekend_flag)
from ..operators.encode import apply_dictionary, label_encode
from ..operators.stats import (attach, attach_leave_one_out_means, attach_rich_stats, item_stats, ratio_features,
                               user_stats)
from ..operators.stats_state import attach_state
from ..operators.windows import DEFAULT_ORDER, sequence_features, sequence_features_after
from ..schema import CATEGORICALS, FEATURES, RICH_EXCLUDED, TIME_FORMAT

LOG_TIME = f"{TIME_FORMAT}[.SSSSSS]"


def prepare_time(df: DataFrame, mode: str = "coerce", time_col: str = "action_time") -> DataFrame:
    """Normalise ``action_time`` to a timestamp and add time parts.

    Text input is cleaned (trailing ``.0``) and parsed, with or without microseconds: ``coerce`` turns bad text into
    NULL, ``fixed`` fails the job on it.  ``raise`` takes the format of the first text (``T`` or space, dashes or slashes, date
    only, offsets; one aggregate over the log finds it) and fails the job on any other; streams have the
    fixed format.  Timestamp input is used as is.
    """
    if time_col not in df.columns:
        return df
    dtype = df.schema[time_col].dataType
    if isinstance(dtype, T.StringType):
        text = clean_time_text(time_col)
        shape = LOG_SHAPE
        if mode == "raise" and not df.isStreaming:
            shape = infer_time_shape(df.withColumn(time_col, text), time_col) or LOG_SHAPE
        if mode == "coerce":
            parsed = parse_time_coerce(text, LOG_TIME)
        else:
            parsed = parse_time_strict(text, LOG_TIME) if shape == LOG_SHAPE else parse_time_free(text, shape)
        df = df.withColumn(time_col, parsed)
    elif isinstance(dtype, T.TimestampType):
        df = df.withColumn(time_col, F.col(time_col).cast("timestamp_ntz"))
    return time_parts(df, time_col)


def select_features(df: DataFrame, features=FEATURES) -> DataFrame:
    """The fixed feature projection; features absent from ``df`` are skipped."""
    return df.select(*[c for c in features if c in df.columns])


def base_statistics(df: DataFrame, mode: str = "coerce") -> dict[str, DataFrame]:
    """The user and item statistic tables of a log (what a bundle freezes for serving)."""
    filled = fill_missing_typed(prepare_time(df, mode))
    return {"user": user_stats(filled), "item": item_stats(filled)}


def base_features(df: DataFrame, mode: str = "coerce", keep: tuple[str, ...] = (),
                  dictionary: DataFrame | None = None, leave_one_out: bool = False,
                  statistics: dict[str, DataFrame] | None = None) -> DataFrame:
    """22-feature matrix (plus ``keep`` columns, e.g. ids and target).

    ``statistics`` (from ``base_statistics``) replaces the per-file user / item statistics.
    Without ``dictionary`` the categories are encoded by a dictionary fitted on ``df``
    itself (the reference's per-file behaviour); with one (e.g. fitted on the training
    split) every split shares its codes and unseen values get -1.
    """
    filled = fill_missing_typed(prepare_time(df, mode))
    # Statistics are taken on the filled values before encoding: codes are a bijection
    # of the values, so counts and nunique agree, and these branches scan only the few
    # columns they need instead of repeating the dictionary joins.
    if statistics is not None:
        # frozen (e.g. training-time) statistics: serving a few records cannot recompute them
        u, i = statistics["user"], statistics["item"]
    else:
        u, i = user_stats(filled), item_stats(filled)
    if dictionary is None:
        out = label_encode(filled, CATEGORICALS)
    else:
        out = apply_dictionary(filled, dictionary, CATEGORICALS)
    if leave_one_out:
        # the two action means without the row's own action (the reference's means include it)
        u, i = u.drop("user_action_mean"), i.drop("item_action_mean")
    out = attach(attach(out, u, "user_log_acct"), i, "item_sku_id")
    if leave_one_out:
        out = attach_leave_one_out_means(out)
    return out.select(*keep, *[c for c in FEATURES if c in out.columns])


def rich_features(df: DataFrame, order_by=DEFAULT_ORDER, skipped: list[str] | None = None) -> DataFrame:
    """All rich features; families whose source columns are absent are skipped (listed in ``skipped``)."""
    out = prepare_time(df, mode="raise")
    if "dayofweek" in out.columns:
        out = out.withColumn("is_weekend", weekend_flag("dayofweek"))
    if "hour" in out.columns:
        out = out.withColumn("hour_category", hour_bucket("hour"))
    # Sequence features come before the statistic joins, which keeps their range blocks narrow; the
    # statistics are aggregated from the log itself, so their scans do not touch the blocks.
    log = out
    if all(c in out.columns for c in ("user_log_acct", "hour", "action_time")):
        out = sequence_features(out, order_by=order_by)
    elif skipped is not None:
        skipped.append("sequence")
    out = attach_rich_stats(out, skipped, ratio_inputs=True, source=log)
    out = ratio_features(out)
    return fill_missing_zero(out)


def rich_features_frozen(df: DataFrame, state: DataFrame, history: DataFrame, mode: str = "raise") -> DataFrame:
    """Rich features of a new log from a training log's statistics state and last actions (keys they do not know get 0)."""
    out = prepare_time(df, mode=mode)
    out = out.withColumns({"is_weekend": weekend_flag("dayofweek"), "hour_category": hour_bucket("hour")})
    out = sequence_features_after(out, history)
    return fill_missing_zero(ratio_features(attach_state(out, state, ratio_inputs=True)))


def rich_feature_matrix(features: DataFrame) -> DataFrame:
    """Everything but the identifier columns; ``target`` and ``label`` are left out too."""
    drop = [*RICH_EXCLUDED, "target", "label", "row_id"]
    return features.select(*[c for c in features.columns if c not in drop])

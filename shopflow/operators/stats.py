"""Per-entity statistics and enrichment joins.

Every statistic is a grouped aggregate (partial aggregation absorbs hot keys before
the shuffle; several ``count(DISTINCT)`` share one Expand-based plan whose first
shuffle is keyed by (key, value), so one hot key is still spread out).  Statistics
are attached with left joins: a NULL key never matches, so its rows get no values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


HASHED_KEY = "_hashed_key"


def _std(c: str) -> Column:
    return F.stddev_samp(c)


def user_stats(df: DataFrame) -> DataFrame:
    """Five user statistics of the 22-feature path."""
    return df.where(F.col("user_log_acct").isNotNull()).groupBy("user_log_acct").agg(
        F.count("item_sku_id").alias("user_item_count"),
        F.avg("action_type").alias("user_action_mean"),
        F.countDistinct("shop_id").alias("user_shop_nunique"),
        F.countDistinct("brand_code").alias("user_brand_nunique"),
        F.countDistinct("item_third_cate_cd").alias("user_cate_nunique"),
    )


def leave_one_out_mean(total: str, n: str, own: str) -> Column:
    """Mean of the other rows of the group: (sum - own) / (n - 1); NULL for a group of one."""
    return F.try_divide(F.col(total) - F.col(own), (F.col(n) - 1).cast("double"))


def attach_leave_one_out_means(df: DataFrame, value: str = "action_type") -> DataFrame:
    """``user_action_mean`` and ``item_action_mean`` without the row's own value (label-leak free).

    One aggregate per key carries (sum, count); the per-row correction is a projection.
    """
    out = df
    for key, name in (("user_log_acct", "user_action_mean"), ("item_sku_id", "item_action_mean")):
        agg = df.where(F.col(key).isNotNull()).groupBy(key).agg(
            F.sum(value).alias(f"_s_{name}"), F.count(value).alias(f"_n_{name}"))
        out = attach(out.drop(name) if name in out.columns else out, agg, key)
        out = out.withColumn(name, leave_one_out_mean(f"_s_{name}", f"_n_{name}", value)).drop(
            f"_s_{name}", f"_n_{name}")
    return out


def item_stats(df: DataFrame) -> DataFrame:
    """Two item statistics of the 22-feature path."""
    return df.where(F.col("item_sku_id").isNotNull()).groupBy("item_sku_id").agg(
        F.count("user_log_acct").alias("item_user_count"),
        F.avg("action_type").alias("item_action_mean"),
    )


# Rich statistic families: key -> (prefix, [(source column, [aggregations])]).
RICH_FAMILIES = {
    "user_log_acct": ("user", [("item_sku_id", ["count", "nunique"]), ("action_type", ["mean", "std", "count"]),
                               ("shop_id", ["nunique"]), ("brand_code", ["nunique"]),
                               ("item_third_cate_cd", ["nunique"]), ("hour", ["mean", "std"])]),
    "item_sku_id": ("item", [("user_log_acct", ["count", "nunique"]), ("action_type", ["mean", "std", "count"]),
                             ("shop_id", ["nunique"]), ("brand_code", ["nunique"]), ("hour", ["mean", "std"])]),
    "shop_id": ("shop", [("user_log_acct", ["count", "nunique"]), ("action_type", ["mean", "std", "count"]),
                         ("item_sku_id", ["nunique"]), ("brand_code", ["nunique"]), ("hour", ["mean", "std"])]),
}

_AGG = {
    "count": lambda c: F.count(c),
    "nunique": lambda c: F.countDistinct(c),
    "mean": lambda c: F.avg(c),
    "std": _std,
}


def family_columns(key: str) -> list[str]:
    prefix, spec = RICH_FAMILIES[key]
    return [f"{prefix}_{src}_{how}" for src, hows in spec for how in hows]


def family_available(df: DataFrame, key: str) -> bool:
    _, spec = RICH_FAMILIES[key]
    return key in df.columns and all(src in df.columns for src, _ in spec)


# Ratio inputs a family does not publish: computed in the same aggregate, used by the
# ratios, then dropped (saves a separate aggregate and a full join-back per ratio).
RATIO_INPUTS = {"user_log_acct": [("shop_id", "count")]}


def rich_stats(df: DataFrame, key: str, ratio_inputs: bool = False) -> DataFrame:
    """One rich statistics family (user: 10, item: 9, shop: 9 columns)."""
    prefix, spec = RICH_FAMILIES[key]
    aggs = [_AGG[how](src).alias(f"{prefix}_{src}_{how}") for src, hows in spec for how in hows]
    if ratio_inputs:
        aggs += [_AGG[how](src).alias(f"_{prefix}_{src}_{how}") for src, how in RATIO_INPUTS.get(key, [])
                 if src in df.columns]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def rich_user_stats(df: DataFrame) -> DataFrame:
    return rich_stats(df, "user_log_acct")


def rich_item_stats(df: DataFrame) -> DataFrame:
    return rich_stats(df, "item_sku_id")


def rich_shop_stats(df: DataFrame) -> DataFrame:
    return rich_stats(df, "shop_id")


def attach(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Left equi-join of a per-key statistics table, safe against hot keys.

    A statistics table is the output of an aggregate on ``key`` and already partitioned by it, so
    a join on ``key`` alone would put the aggregate right under the join, where AQE cannot split
    a skewed partition of the event side.  Joining on (key, hash of key) makes Spark exchange the
    (small) statistics once more: both sides are then plain shuffles, and AQE splits hot keys.
    """
    hashed = stats.withColumn(HASHED_KEY, F.xxhash64(key))
    return df.withColumn(HASHED_KEY, F.xxhash64(key)).join(hashed, [key, HASHED_KEY], "left").drop(HASHED_KEY)


def attach_base_stats(df: DataFrame) -> DataFrame:
    """User then item statistics, both aggregated from ``df`` itself (the join adds no rows)."""
    return attach(attach(df, user_stats(df), "user_log_acct"), item_stats(df), "item_sku_id")


def attach_rich_stats(df: DataFrame, skipped: list[str] | None = None, ratio_inputs: bool = False,
                      source: DataFrame | None = None) -> DataFrame:
    """User, item and shop families in that order; a family whose columns are absent is skipped.

    ``source`` (the same rows before columns were added) is aggregated instead of ``df`` if given.

    ``ratio_inputs`` also attaches the hidden ``_``-prefixed ratio inputs (``ratio_features`` drops them).
    """
    out, log = df, df if source is None else source
    for key in ("user_log_acct", "item_sku_id", "shop_id"):
        if family_available(log, key):
            out = attach(out, rich_stats(log, key, ratio_inputs), key)
        elif skipped is not None:
            skipped.append(key)
    return out


def group_transform(df: DataFrame, key: str, col: str, hows: Sequence[str] = ("count", "nunique"),
                    prefix: str | None = None) -> DataFrame:
    """Per-group count / nunique of ``col`` broadcast back to every row (agg + join)."""
    prefix = prefix or f"{key}_{col}"
    aggs = [_AGG[h](col).alias(f"{prefix}_{h}") for h in hows]
    stats = df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    return attach(df, stats, key)


# Ratio features: name -> (key, column); ratio = count(column) / nunique(column) within the key.
RATIOS = {
    "user_item_ratio": ("user_log_acct", "item_sku_id"),
    "user_shop_ratio": ("user_log_acct", "shop_id"),
    "item_user_ratio": ("item_sku_id", "user_log_acct"),
}


def _ratio_from_family(df: DataFrame, name: str) -> Column | None:
    key, col = RATIOS[name]
    prefix = RICH_FAMILIES[key][0]
    nun = f"{prefix}_{col}_nunique"
    for cnt in (f"{prefix}_{col}_count", f"_{prefix}_{col}_count"):
        if cnt in df.columns and nun in df.columns:
            return F.try_divide(F.col(cnt).cast("double"), F.col(nun).cast("double"))
    return None


def ratio_features(df: DataFrame, names: Sequence[str] = tuple(RATIOS)) -> DataFrame:
    """count / nunique ratios; reuses family columns when present, else one grouped aggregate per key.

    A zero ``nunique`` (all values missing) gives NULL.
    """
    out = df
    per_key: dict[str, list[tuple[str, str]]] = {}
    for name in names:
        key, col = RATIOS[name]
        if key not in out.columns or col not in out.columns:
            continue
        expr = _ratio_from_family(out, name)
        if expr is not None:
            out = out.withColumn(name, expr)
        else:
            per_key.setdefault(key, []).append((name, col))
    for key, items in per_key.items():
        aggs = []
        for name, col in items:
            aggs += [F.count(col).alias(f"_c_{name}"), F.countDistinct(col).alias(f"_n_{name}")]
        stats = out.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
        stats = stats.select(key, *[F.try_divide(F.col(f"_c_{n}").cast("double"), F.col(f"_n_{n}").cast("double"))
                                    .alias(n) for n, _ in items])
        out = attach(out, stats, key)
    hidden = [f"_{RICH_FAMILIES[k][0]}_{src}_{how}" for k, items in RATIO_INPUTS.items() for src, how in items]
    return out.drop(*[c for c in hidden if c in out.columns])

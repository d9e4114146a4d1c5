"""Binary and multi-class evaluation as aggregates over (label, prediction[, probability]).

Zero divisions give 0 (never an error).  Multi-class metrics use the classes that
appear in the labels or the predictions, sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import prefix_sums


def _safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _safe_div(2 * p * r, p + r)


def confusion_binary(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def binary_metrics(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall and F1 of the positive class."""
    return _with_binary_metrics(confusion_binary(df, label, prediction)).drop("tn", "fp", "fn", "tp")


def _with_binary_metrics(counts: DataFrame) -> DataFrame:
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    precision, recall = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    return counts.select(_safe_div(tp + tn, tn + fp + fn + tp).alias("accuracy"), precision.alias("precision"),
                         recall.alias("recall"), _f1(precision, recall).alias("f1"), "tn", "fp", "fn", "tp")


def roc_auc(df: DataFrame, label: str = "target", score: str = "probability",
            group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC with ties counted one half (Mann-Whitney), optionally per group.

    Rows are first reduced to one row per distinct score (positives, negatives);
    the negatives below each score come from range-partitioned prefix sums.
    ``group_cols`` must have few values (e.g. boosting rounds).
    """
    g = list(group_cols)
    per_score = df.groupBy(*g, score).agg(F.count_if(F.col(label) == 1).alias("_pos"),
                                          F.count_if(F.col(label) != 1).alias("_neg"))
    return roc_auc_from_counts(per_score, score, g)


def roc_auc_from_counts(per_score: DataFrame, score: str, group_cols: Sequence[str] = (),
                        extra: dict[str, Column] | None = None) -> DataFrame:
    """AUC from one row per (group, distinct score) with ``_pos`` / ``_neg`` counts.

    ``extra`` adds more per-group sums over the same count rows (e.g. a loss), so
    callers need only one pass over the scored rows.
    """
    g = list(group_cols)
    cum = prefix_sums(per_score, [score], ["_neg"], group_cols=g, prefix="_below")
    wins = F.col("_pos").cast("double") * (F.col("_below_neg").cast("double") + F.col("_neg").cast("double") / 2)
    extra = extra or {}
    agg = cum.groupBy(*g).agg(F.sum(wins).alias("_w"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"),
                              *[F.sum(e).alias(f"_x_{k}") for k, e in extra.items()])
    return agg.select(*g, F.try_divide(F.col("_w"), F.col("_p").cast("double") * F.col("_n").cast("double"))
                      .alias("auc"), *[F.col(f"_x_{k}").alias(k) for k in extra])


def metrics_long(metrics: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """One row per metric: (metric, value)."""
    values = [c for c in metrics.columns if c not in id_cols]
    return metrics.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in values]).unpivot(
        list(id_cols), values, "metric", "value")


def evaluation_report(df: DataFrame, label: str = "target", prediction: str = "prediction",
                      score: str = "probability") -> DataFrame:
    """The binary evaluation set as (metric, value): accuracy, precision, recall, f1, auc, tn, fp, fn, tp."""
    auc = roc_auc(df, label, score).select(F.lit("auc").alias("metric"), F.col("auc").cast("double").alias("value"))
    rest = confusion_binary(df, label, prediction)
    return metrics_long(_with_binary_metrics(rest)).unionByName(auc)


def pair_counts(df: DataFrame, label: str, prediction: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group, label, prediction, n): at most K x K rows a group, from which every metric below follows."""
    return df.groupBy(*group_cols, F.col(label).alias("_y"), F.col(prediction).alias("_q")).agg(
        F.count(F.lit(1)).alias("_n"))


def _class_rows(pairs: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per class in labels or predictions: support, tp, predicted count.

    Each pair row is exploded to its two sides, so the counted rows are read once and not joined.
    """
    sides = F.array(
        F.struct(F.col("_y").alias("class"), F.col("_n").alias("s"), F.lit(0).cast("long").alias("p")),
        F.struct(F.col("_q").alias("class"), F.lit(0).cast("long").alias("s"), F.col("_n").alias("p")))
    hit = F.when(F.col("_y") == F.col("_q"), F.col("_side.s")).otherwise(0)
    return pairs.withColumn("_side", F.explode(sides)).groupBy(*group_cols, F.col("_side.class").alias("class")).agg(
        F.sum("_side.s").alias("support"), F.sum(hit).alias("tp"), F.sum("_side.p").alias("predicted"))


def _class_counts(df: DataFrame, label: str, prediction: str, group_cols: Sequence[str] = ()) -> DataFrame:
    return _class_rows(pair_counts(df, label, prediction, group_cols), group_cols)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """(label, prediction, count) for every pair of observed classes, zeros included.

    Observed pairs are counted once; the K x K zero grid comes from the (tiny) class
    list exploded twice; both are unioned and summed -- no join.
    """
    g = list(group_cols)
    classes = _class_counts(df, label, prediction, g).select(*g, "class")
    grid = (classes.groupBy(*g).agg(F.sort_array(F.collect_list("class")).alias("_cls"))
            .select(*g, F.explode("_cls").alias(label), "_cls")
            .select(*g, label, F.explode("_cls").alias(prediction), F.lit(0).cast("long").alias("count")))
    counts = df.groupBy(*g, label, prediction).agg(F.count(F.lit(1)).alias("count"))
    return grid.unionByName(counts).groupBy(*g, label, prediction).agg(F.sum("count").cast("long").alias("count"))


def per_class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """precision, recall, F1 and support per class."""
    g = list(group_cols)
    t = _class_counts(df, label, prediction, g)
    precision = _safe_div(F.col("tp"), F.col("predicted"))
    recall = _safe_div(F.col("tp"), F.col("support"))
    return t.select(*g, "class", precision.alias("precision"), recall.alias("recall"),
                    _f1(precision, recall).alias("f1"), F.col("support").cast("long").alias("support"))


def macro_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                  group_cols: Sequence[str] = ()) -> DataFrame:
    g = list(group_cols)
    pc = per_class_metrics(df, label, prediction, g)
    return pc.groupBy(*g).agg(F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
                              F.avg("f1").alias("macro_f1"))


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    g = list(group_cols)
    pc = per_class_metrics(df, label, prediction, g)
    tot = F.sum("support").cast("double")
    return pc.groupBy(*g).agg(
        _safe_div(F.sum(F.col("precision") * F.col("support")), tot).alias("weighted_precision"),
        _safe_div(F.sum(F.col("recall") * F.col("support")), tot).alias("weighted_recall"),
        _safe_div(F.sum(F.col("f1") * F.col("support")), tot).alias("weighted_f1"))


def multiclass_accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction",
                        group_cols: Sequence[str] = ()) -> DataFrame:
    g = list(group_cols)
    return df.groupBy(*g).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def macro_accuracy(df: DataFrame, num_classes: int, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean per-class recall over classes 0..K-1; a class absent from the labels counts 0."""
    per = df.groupBy(F.col(label).alias("class")).agg(
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("_acc"))
    classes = df.sparkSession.range(num_classes).select(F.col("id").cast("int").alias("class"))
    return classes.join(F.broadcast(per), "class", "left").agg(
        F.avg(F.coalesce("_acc", F.lit(0.0))).alias("macro_acc"))


def averaged_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     group_cols: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and weighted precision / recall / F1 per group, in one pass over the rows."""
    g = list(group_cols)
    t = _class_counts(df, label, prediction, g)
    precision, recall = _safe_div(F.col("tp"), F.col("predicted")), _safe_div(F.col("tp"), F.col("support"))
    pc = t.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1", _f1(F.col("precision"), F.col("recall")))
    total = F.sum("support").cast("double")
    kinds = ("precision", "recall", "f1")
    return pc.groupBy(*g).agg(
        F.try_divide(F.sum("tp").cast("double"), total).alias("accuracy"),
        *[F.avg(k).alias(f"macro_{k}") for k in kinds],
        *[_safe_div(F.sum(F.col(k) * F.col("support")), total).alias(f"weighted_{k}") for k in kinds])


def split_metrics(df: DataFrame, split_col: str = "split", label: str = "label",
                  prediction: str = "prediction") -> DataFrame:
    """Accuracy, macro and weighted averages per split (validation vs test report)."""
    return averaged_metrics(df, label, prediction, [split_col])


def model_comparison(predictions: DataFrame, model_col: str = "model", label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """One row per model: accuracy and weighted precision / recall / F1."""
    return averaged_metrics(predictions, label, prediction, [model_col]).select(
        model_col, "accuracy", F.col("weighted_precision").alias("precision"),
        F.col("weighted_recall").alias("recall"), F.col("weighted_f1").alias("f1"))


def stacked_models(df: DataFrame, predictions: dict[str, Column], label: str = "label") -> DataFrame:
    """(model, label, prediction): each row once per model, from one pass over ``df`` (no union of scans)."""
    each = F.array(*[F.struct(F.lit(name).alias("model"), p.cast("int").alias("prediction"))
                     for name, p in predictions.items()])
    return df.select(F.col(label).alias("label"), F.explode(each).alias("_m")).select(
        "_m.model", "label", "_m.prediction")


def score_summary(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Rows, predicted positives and their share."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(prediction).cast("long").alias("positives"),
                  F.avg(prediction).alias("positive_share"))


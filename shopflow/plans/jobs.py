"""End-to-end jobs in the shape of the reference's scripts, composed from the operators.

split   -> a split table (train / test / val) plus its report
train   -> a saved model bundle plus the held-out evaluation
evaluate / predict -> metrics or a prediction table for any log file

Paths name shared storage; every hand-off is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fill import fill_missing_typed
from ..functions.labels import argmax, binary_target, multiclass_label
from ..operators.encode import (apply_dictionary, dictionary_sizes, fit_native_dictionary, fit_sorted_dictionary,
                                label_encode_joint)
from ..operators.metrics import evaluation_report, model_comparison, score_summary, split_metrics, stacked_models
from ..operators.profile import row_weights
from ..operators.split import split_report, stratified_split
from ..operators.stats_state import last_actions, statistics_state
from ..schema import CATEGORICALS, FEATURES, NUM_CLASSES, RICH_CATEGORICALS
from ..sources import io
from . import train as T
from .features import base_features, base_statistics, prepare_time, rich_feature_matrix, rich_features, rich_features_frozen
from .joint import JointParams, fit_joint

SPLITS = ("train", "test", "val")


def split_job(spark: SparkSession, input_path: str, output_dir: str, fmt: str = "csv",
              ratios: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 42,
              sample_size: int | None = None, out_fmt: str = "parquet", mode: str = "coerce") -> DataFrame:
    """Load, clean (time parse by ``mode``, lenient by default; typed fill), label purchase, split exactly,
    write; returns the report."""
    log = io.load_behavior(spark, input_path, fmt, time_text=fmt == "csv")
    if sample_size:
        log = io.head_n(log, sample_size)
    labeled = fill_missing_typed(prepare_time(log, mode=mode)).withColumn("target", binary_target())
    io.write_splits(stratified_split(labeled, ratios, seed=seed), output_dir, out_fmt)
    return split_report(io.read_splits(spark, output_dir, out_fmt))


def _split_features(spark: SparkSession, data_dir: str, frozen: bool, keep: tuple[str, ...], fmt: str, mode: str):
    parts = {n: io.read_split(spark, data_dir, n, fmt=fmt).withColumn("label", multiclass_label()) for n in SPLITS}
    dictionary = fit_sorted_dictionary(parts["train"], CATEGORICALS) if frozen else None
    feats = {n: base_features(df, mode=mode, keep=keep, dictionary=dictionary) for n, df in parts.items()}
    return feats, dictionary, base_statistics(parts["train"], mode)


def train_binary_job(spark: SparkSession, data_dir: str, model_dir: str, params: T.BoostParams = T.BINARY_PARAMS,
                     frozen: bool = True, fmt: str = "parquet", mode: str = "coerce") -> DataFrame:
    """22 features per split, boosted trees with patience on validation AUC, bundle saved; test metrics."""
    feats, dictionary, stats = _split_features(spark, data_dir, frozen, ("row_id", "target"), fmt, mode)
    model = T.fit_binary(feats["train"], feats["val"], FEATURES, params, path=f"{model_dir}/work")
    T.save_bundle(spark, model, f"{model_dir}/bundle", dictionary, stats)
    return evaluation_report(model.transform(feats["test"]))


def train_multiclass_job(spark: SparkSession, data_dir: str, model_dir: str,
                         params: T.BoostParams | None = None, frozen: bool = True, fmt: str = "parquet",
                         mode: str = "fixed", resume: bool = False) -> DataFrame:
    """Class-weighted joint softmax boosting (``JointParams``, the default) or, with plain ``BoostParams``,
    one-vs-rest boosted trees; validation and test report.  Times must have the log's format (``mode``);
    ``resume`` continues an interrupted run of the same data and parameters."""
    params = params or JointParams()
    feats, dictionary, stats = _split_features(spark, data_dir, frozen, ("row_id", "label"), fmt, mode)
    if isinstance(params, JointParams):
        categories = dictionary_sizes(dictionary) if frozen else {}
        model = fit_joint(row_weights(feats["train"]), feats["val"], FEATURES, params, num_classes=NUM_CLASSES,
                          path=f"{model_dir}/work", resume=resume, categories=categories)
    else:
        model = T.fit_multiclass(row_weights(feats["train"]), feats["val"], FEATURES, params, num_classes=NUM_CLASSES,
                                 path=f"{model_dir}/work", resume=resume)
    T.save_bundle(spark, model, f"{model_dir}/bundle", dictionary, stats)
    held_out = [model.transform(feats[n]).withColumn("split", F.lit(n)) for n in ("val", "test")]
    return split_metrics(held_out[0].unionByName(held_out[1]))


def train_ensemble_job(spark: SparkSession, data_dir: str, model_dir: str, params: T.BoostParams = T.MULTICLASS_PARAMS,
                       fmt: str = "parquet", resume: bool = False, num_trees: int = 100,
                       max_iter_linear: int = 100) -> DataFrame:
    """The rich path: features per split, joint encoding of train and validation, three learners and their
    vote, all saved as one bundle; validation accuracy and weighted averages of each member and the vote."""
    parts = {n: io.read_split(spark, data_dir, n, fmt=fmt).drop("split", "target", "hour", "day", "month", "dayofweek")
             .withColumn("label", multiclass_label()) for n in ("train", "val")}
    rich = {n: rich_features(df) for n, df in parts.items()}
    train, val = label_encode_joint([rich["train"], rich["val"]], RICH_CATEGORICALS)
    dictionary = fit_native_dictionary([rich["train"], rich["val"]], RICH_CATEGORICALS)
    log = prepare_time(parts["train"])
    frozen = {"state": statistics_state(log), "last_actions": last_actions(log)}
    features = rich_feature_matrix(train).columns
    model = T.fit_ensemble(train, val, features, params, path=f"{model_dir}/work", num_trees=num_trees,
                           max_iter_linear=max_iter_linear, resume=resume)
    T.save_bundle(spark, model, f"{model_dir}/bundle", dictionary, frozen)
    out = model.transform(val)
    members = {"boosted": argmax("p_boosted"), "forest": argmax("p_forest"), "linear": argmax("p_linear"),
               "voting": F.col("prediction")}
    return model_comparison(stacked_models(out, members))


def _features_for(spark: SparkSession, bundle_dir: str, input_path: str, fmt: str, keep: tuple[str, ...],
                  training_statistics: bool = False, mode: str = "raise"):
    model, dictionary = T.load_bundle(spark, bundle_dir)
    log = (io.read_splits(spark, input_path) if fmt == "split"
           else io.load_behavior(spark, input_path, fmt, time_text=fmt == "csv"))
    if isinstance(model, T.Ensemble):
        return model, ensemble_features(spark, bundle_dir, dictionary, log, mode).select(*keep, *[
            c for c in model.features if c not in keep])
    stats = T.load_statistics(spark, bundle_dir) if training_statistics else None
    return model, base_features(log, mode=mode, keep=keep, dictionary=dictionary, statistics=stats)


def ensemble_features(spark: SparkSession, bundle_dir: str, dictionary: DataFrame, log: DataFrame, mode: str = "raise") -> DataFrame:
    """The rich features of a new log by an ensemble bundle: training statistics, users' last actions and dictionary."""
    state, history = T.load_rich_statistics(spark, bundle_dir)
    rich = rich_features_frozen(log, state, history, mode)
    return apply_dictionary(rich, dictionary, RICH_CATEGORICALS, null_code="last")


def evaluate_job(spark: SparkSession, bundle_dir: str, input_path: str, fmt: str = "csv",
                 threshold: float = 0.5, mode: str = "raise") -> DataFrame:
    """Binary bundle on a labelled log: (metric, value).  Unparsable times fail the job unless ``mode='coerce'``."""
    model, feats = _features_for(spark, bundle_dir, input_path, fmt, ("row_id", "action_type"), mode=mode)
    feats = feats.withColumn("target", binary_target())
    return evaluation_report(model.transform(feats, threshold))


def predict_job(spark: SparkSession, bundle_dir: str, input_path: str, output_path: str, fmt: str = "csv",
                threshold: float = 0.5, out_fmt: str = "csv", training_statistics: bool = False,
                mode: str = "raise") -> DataFrame:
    """Score a log, write (user, item, time, prediction, probability); returns the score summary.

    ``training_statistics`` uses the bundle's frozen user / item statistics instead of the
    scored file's own (the reference recomputes them per file).  With an ensemble bundle the prediction is the vote's
    class, the probability its own, and statistics are always the bundle's."""
    model, feats = _features_for(spark, bundle_dir, input_path, fmt,
                                 ("user_log_acct", "item_sku_id", "action_time"), training_statistics, mode)
    if isinstance(model, T.Ensemble):
        scored = model.transform(feats).withColumn("probability", F.array_max("p_vote"))
    else:
        scored = model.transform(feats, threshold)
    io.write_predictions(scored, output_path, out_fmt)
    written = spark.read.parquet(output_path) if out_fmt == "parquet" else spark.read.options(
        **io.CSV_OPTIONS).schema("user_log_acct string, item_sku_id long, action_time timestamp_ntz, "
                                 "prediction int, probability double").csv(output_path)
    return score_summary(written)

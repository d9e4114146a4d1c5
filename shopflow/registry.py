"""Named queries over the given tables: one per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column names
match the DuckDB statement of the same name in ``shopflow.oracle``.  Doubles are
rounded to 6 places at the very end (both engines sum in different orders).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import labels as L
from .functions.fill import fill_missing_typed, fill_missing_zero
from .functions.request import request_defaults
from .functions.time import (clean_time_text, hour_bucket, infer_time_shape, parse_time_coerce, parse_time_free,
                             parse_time_strict, weekend_flag)
from .operators import encode, metrics, profile, stats, stats_state, target_stats
from .operators.ensemble import soft_vote
from .operators.split import split_report, stratified_split
from .operators.windows import sequence_features, sequence_features_after
from .plans import features as P
from .plans.score import request_backfill
from .schema import BEHAVIOR_SCHEMA, CATEGORICALS, NUM_CLASSES, RICH_CATEGORICALS
from .session import scratch_path
from .sources import fixtures as FX
from .sources import io

Query = Callable[[SparkSession, str], DataFrame]

HEAD_N = 500
THRESHOLD = 0.5
SEED = 42
RATIOS = (0.7, 0.15, 0.15)
# fixed clock for blank request times
REQUEST_CLOCK = _dt.datetime(2024, 2, 1, 12, 0, 0)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def _behavior(spark, sf):
    return FX.behavior(spark, sf)


def _filled(spark, sf):
    return fill_missing_typed(_behavior(spark, sf))


def _labeled(spark, sf):
    """Splitter input: time parts, typed fill, binary target."""
    b = P.prepare_time(_behavior(spark, sf))
    return fill_missing_typed(b).withColumn("target", L.binary_target())


def _split(spark, sf):
    return stratified_split(_labeled(spark, sf), RATIOS, seed=SEED)


_SPLIT_TABLES: dict[tuple, str] = {}


def _split_table(spark, sf) -> str:
    """The split written once per session as a table partitioned by ``split`` (the train/test/val hand-off)."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _SPLIT_TABLES:
        path = scratch_path(spark, "split-table")
        io.write_splits(_split(spark, sf), path)
        _SPLIT_TABLES[key] = path
    return _SPLIT_TABLES[key]


def _scored_pred(spark, sf):
    s = FX.scored(spark, sf)
    return s.withColumn("prediction", L.argmax(L.prob_array("p0", "p1", "p2", "p3", "p4")))


# ---------------------------------------------------------------- A: sources and sinks
def q_load_behavior(spark, sf):
    path = scratch_path(spark, "behavior-csv")
    io.write_table(_behavior(spark, sf), path, fmt="csv")
    return io.load_behavior(spark, path, fmt="csv")


def q_load_behavior_messy(spark, sf):
    """A CSV log with reordered, extra and missing columns, whole numbers written as floats and bad times."""
    b = FX.behavior_text(spark, sf).drop("vender_id")
    messy = b.select(*[F.col(c).cast("double").cast("string").alias(c) if c in ("sex", "user_level", "shop_id") else F.col(c)
                       for c in reversed(b.columns)], F.lit("x").alias("note"))
    path = scratch_path(spark, "behavior-messy")
    io.write_table(messy, path, fmt="csv")
    log = io.load_behavior(spark, path, fmt="csv", time_text=True)
    return log.withColumn("action_time", parse_time_coerce(clean_time_text("action_time")))


def q_load_behavior_quoted(spark, sf):
    """A log without ids whose brands and cities hold quotes, commas and line ends, written to several files."""
    b = _behavior(spark, sf)
    n = F.col("row_id") % 7
    brand = (F.when(n == 0, F.concat(F.lit('He said "hi", ok '), F.col("brand_code"))).when(n == 1, F.lit("two\nlines"))
             .when(n == 2, F.lit("one\r\ntwo,\n\n\"three\"")).when(n == 3, F.lit('"')).otherwise(F.col("brand_code")))
    city = F.when(n == 4, F.concat(F.lit('5" '), F.col("city"))).when(n == 5, F.concat(F.col("city"), F.lit(' "x"\n'))).otherwise(F.col("city"))
    log = b.withColumns({"brand_code": brand, "city": city, "sku_copy": F.col("row_id")}).drop("row_id")
    path = scratch_path(spark, "behavior-quoted")
    io.write_table(log.repartition(3), path, fmt="csv")
    wide = T.StructType([*BEHAVIOR_SCHEMA.fields, T.StructField("sku_copy", T.LongType())])
    back = io.load_behavior(spark, path, fmt="csv", schema=wide, strict=True)
    return back.drop("row_id").withColumnRenamed("sku_copy", "row_id")


def q_file_order_ids(spark, sf):
    """A log without ids, numbered in file order: the ids are 0..n-1, each once."""
    path = scratch_path(spark, "behavior-no-id")
    io.write_table(_behavior(spark, sf).drop("row_id").repartition(3), path, fmt="csv")
    return io.load_behavior(spark, path, fmt="csv").select("row_id")


def q_head_n(spark, sf):
    return io.head_n(_behavior(spark, sf), HEAD_N)


def q_split_roundtrip(spark, sf):
    path = scratch_path(spark, "splits")
    io.write_splits(_split(spark, sf).select("row_id", "target", "split"), path)
    back = io.read_splits(spark, path)
    return back.select("row_id", F.col("target").cast("int").alias("target"), "split")


def q_prediction_output(spark, sf):
    path = scratch_path(spark, "predictions")
    s = FX.scored(spark, sf).select("row_id", "probability")
    rows = _behavior(spark, sf).join(s, "row_id").withColumn("prediction", L.threshold_predict("probability", THRESHOLD))
    io.write_predictions(rows, path, fmt="csv")
    schema = "user_log_acct string, item_sku_id long, action_time timestamp_ntz, prediction int, probability double"
    return spark.read.schema(schema).options(**io.CSV_OPTIONS).csv(path)


# ---------------------------------------------------------------- B: row-level functions
def q_time_text_clean(spark, sf):
    t = FX.behavior_text(spark, sf)
    return t.select("row_id", clean_time_text("action_time").alias("action_time"))


def q_parse_time_coerce(spark, sf):
    t = FX.behavior_text(spark, sf)
    return t.select("row_id", parse_time_coerce(clean_time_text("action_time")).alias("action_time"))


def q_parse_time_strict(spark, sf):
    t = FX.behavior_text(spark, sf, with_bad=False)
    return t.select("row_id", parse_time_strict(clean_time_text("action_time")).alias("action_time"))


# ways to write a log's times; each column has one of them
FREE_TIMES = {"iso": "yyyy-MM-dd'T'HH:mm:ss", "slashes": "yyyy/M/d H:mm", "offset": "yyyy-MM-dd HH:mm:ss'+08:00'",
              "month_first": "MM/dd/yyyy HH:mm:ss", "date_only": "yyyy-MM-dd", "compact": "yyyyMMdd"}


def q_parse_time_free(spark, sf):
    """One time in six formats, each found from its column's first text."""
    b = _behavior(spark, sf)
    path = scratch_path(spark, "free-times")
    b.select("row_id", *[F.date_format(F.col("action_time"), f).alias(n) for n, f in FREE_TIMES.items()]).write.parquet(path)
    log = spark.read.parquet(path)
    return log.select("row_id", *[parse_time_free(n, infer_time_shape(log, n)).alias(n) for n in FREE_TIMES])


def q_time_parts(spark, sf):
    return P.prepare_time(_behavior(spark, sf)).select("row_id", "hour", "day", "month", "dayofweek")


def q_weekend_flag(spark, sf):
    return P.prepare_time(_behavior(spark, sf)).select("row_id", "dayofweek", weekend_flag("dayofweek").alias("is_weekend"))


def q_hour_bucket(spark, sf):
    return P.prepare_time(_behavior(spark, sf)).select("row_id", "hour", hour_bucket("hour").alias("hour_category"))


def q_fill_missing_typed(spark, sf):
    return _filled(spark, sf)


def q_fill_missing_zero(spark, sf):
    return fill_missing_zero(_behavior(spark, sf))


def q_binary_target(spark, sf):
    return _behavior(spark, sf).select("row_id", "action_type", L.binary_target().alias("target"))


def q_multiclass_label(spark, sf):
    return _behavior(spark, sf).select("row_id", L.multiclass_label().alias("label"))


def q_base_feature_matrix(spark, sf):
    prepared = fill_missing_typed(P.prepare_time(_behavior(spark, sf)))
    return prepared.select("row_id", *P.select_features(prepared).columns)


def q_rich_feature_matrix(spark, sf):
    feats = P.rich_features(_filled(spark, sf))
    return feats.select("row_id", *P.rich_feature_matrix(feats).columns)


def q_action_name(spark, sf):
    b = _behavior(spark, sf)
    return b.select("row_id", "action_type", L.action_name("action_type", one_based=True).alias("action_name"),
                    L.multiclass_label().alias("label"),
                    L.action_name(L.multiclass_label()).alias("label_name"))


def q_threshold_predict(spark, sf):
    s = FX.scored(spark, sf)
    return s.select("row_id", "probability", L.threshold_predict("probability", THRESHOLD).alias("prediction"))


def q_argmax_predict(spark, sf):
    s = _scored_pred(spark, sf)
    return s.select("row_id", "prediction", (F.col("prediction") + 1).alias("action_type"))


def q_binary_outcome(spark, sf):
    s = FX.scored(spark, sf)
    outcome, prob = L.binary_outcome("probability", THRESHOLD)
    return s.select("row_id", outcome.alias("outcome"), prob.alias("outcome_probability"))


def q_confidence_binary(spark, sf):
    s = FX.scored(spark, sf)
    return s.select("row_id", L.confidence_binary("probability").alias("confidence"))


def q_confidence_multiclass(spark, sf):
    s = FX.scored(spark, sf)
    p = L.prob_array("p0", "p1", "p2", "p3", "p4")
    return s.select("row_id", F.array_max(p).alias("max_probability"), L.confidence_multiclass(p).alias("confidence"))


def _binary_row(s: DataFrame) -> DataFrame:
    """A binary model's output row [1 - p, p]."""
    return s.withColumn("_p", F.array(1 - F.col("probability"), F.col("probability")))


def q_pad_probabilities(spark, sf):
    s = _binary_row(FX.scored(spark, sf)).withColumn("_pad", L.pad_probabilities("_p"))
    return s.select("row_id", F.size("_pad").alias("n"),
                    *[F.element_at("_pad", i + 1).alias(f"pad_{i}") for i in range(NUM_CLASSES)])


def q_class_probability_rows(spark, sf):
    s = FX.scored(spark, sf).select("row_id", L.prob_array("p0", "p1", "p2", "p3", "p4").alias("_p"))
    e = s.select("row_id", F.posexplode("_p").alias("_i", "probability"))
    return e.select("row_id", (F.col("_i") + 1).cast("int").alias("action_type"),
                    L.action_name(F.col("_i")).alias("action_name"), "probability")


def q_two_valued_flag(spark, sf):
    s = _binary_row(FX.scored(spark, sf))
    return s.select("row_id", L.two_valued(L.pad_probabilities("_p")).alias("two_valued"))


def q_request_defaults(spark, sf):
    return request_defaults(FX.requests(spark, sf), now=REQUEST_CLOCK)


def q_request_backfill(spark, sf):
    req = request_defaults(FX.requests(spark, sf), now=REQUEST_CLOCK)
    sample = _filled(spark, sf)
    stats_sample = P.base_features(_behavior(spark, sf))
    return request_backfill(req, sample, stats_sample, keep=("row_id",))


# ---------------------------------------------------------------- C: encoding
def q_label_encode(spark, sf):
    return encode.label_encode(_filled(spark, sf), CATEGORICALS).select("row_id", *CATEGORICALS)


def _rich_prepared(df):
    out = P.prepare_time(df)
    return out.withColumn("hour_category", hour_bucket("hour"))


def q_label_encode_joint(spark, sf):
    path = _split_table(spark, sf)
    train = _rich_prepared(io.read_split(spark, path, "train"))
    val = _rich_prepared(io.read_split(spark, path, "val"))
    enc_train, enc_val = encode.label_encode_joint([train, val], RICH_CATEGORICALS)
    return enc_train.unionByName(enc_val).select("row_id", "split", *RICH_CATEGORICALS)


def q_label_encode_frozen(spark, sf):
    path = _split_table(spark, sf)
    train, test = io.read_split(spark, path, "train"), io.read_split(spark, path, "test")
    return encode.label_encode_frozen(test, train, CATEGORICALS).select("row_id", *CATEGORICALS)


def q_ordered_target_statistics(spark, sf):
    """Users (a category with many values) by the purchases of their earlier rows, in a seeded order."""
    b = _behavior(spark, sf).withColumn("target", L.binary_target())
    out = target_stats.running_target_sums(b, "user_log_acct", seed=SEED)
    return out.select("row_id", "sum_before", "rows_before",
                      target_stats.smoothed(F.col("sum_before"), F.col("rows_before"), 0.5).alias("user_target"))


def q_frozen_target_statistics(spark, sf):
    """Validation and test rows by their brand's purchases in the training split (a missing brand is a brand)."""
    path = _split_table(spark, sf)
    train, val, test = (io.read_split(spark, path, n) for n in ("train", "val", "test"))
    _, a, b = target_stats.encode_ordered(train, [val, test], ["brand_code", "shop_id"])
    return a.unionByName(b).select("row_id", "split", "brand_code_target", "shop_id_target")


# ---------------------------------------------------------------- D: statistics and joins
def _with_hour(spark, sf):
    return P.prepare_time(_behavior(spark, sf))


def q_user_stats(spark, sf):
    return stats.user_stats(_behavior(spark, sf))


def q_item_stats(spark, sf):
    return stats.item_stats(_behavior(spark, sf))


def q_rich_user_stats(spark, sf):
    return stats.rich_user_stats(_with_hour(spark, sf))


def q_rich_item_stats(spark, sf):
    return stats.rich_item_stats(_with_hour(spark, sf))


def q_rich_shop_stats(spark, sf):
    return stats.rich_shop_stats(_with_hour(spark, sf))


def _merged_stats(spark, sf, key):
    """A family's statistics from the merged states of two halves of the log."""
    log = _with_hour(spark, sf)
    halves = []
    for k in (0, 1):
        path = scratch_path(spark, "statistics-state")
        stats_state.statistics_state(log.where(F.col("row_id") % 2 == k)).write.parquet(path)
        halves.append(spark.read.schema(stats_state.STATE).parquet(path))
    return stats_state.state_statistics(stats_state.merge_states(*halves), key, log.schema[key].dataType.simpleString())


def q_merged_user_stats(spark, sf):
    return _merged_stats(spark, sf, "user_log_acct")


def q_merged_item_stats(spark, sf):
    return _merged_stats(spark, sf, "item_sku_id")


def q_merged_shop_stats(spark, sf):
    return _merged_stats(spark, sf, "shop_id")


def q_sequence_after_history(spark, sf):
    """Sequence features of the later half of a log's time, whose users' last actions in the first half are kept in a table."""
    log = _with_hour(spark, sf)
    span = log.agg(F.min("action_time").alias("a"), F.max("action_time").alias("b")).first()
    cut = F.lit(span.a + (span.b - span.a) // 2).cast("timestamp_ntz")
    new = log.where(F.col("action_time") > cut)
    history = stats_state.last_actions(log.where(F.col("action_time") <= cut))
    return sequence_features_after(new, history).select("row_id", "hour_diff", "action_frequency")


def q_attach_base_stats(spark, sf):
    return stats.attach_base_stats(_behavior(spark, sf))


def q_attach_rich_stats(spark, sf):
    return stats.attach_rich_stats(_with_hour(spark, sf))


def _ratio(spark, sf, name):
    return stats.ratio_features(_behavior(spark, sf), [name]).select("row_id", name)


def q_user_item_ratio(spark, sf):
    return _ratio(spark, sf, "user_item_ratio")


def q_user_shop_ratio(spark, sf):
    return _ratio(spark, sf, "user_shop_ratio")


def q_item_user_ratio(spark, sf):
    return _ratio(spark, sf, "item_user_ratio")


def q_rich_features_partial(spark, sf):
    return P.rich_features(_filled(spark, sf).drop("item_third_cate_cd"))


def q_rich_features(spark, sf):
    return P.rich_features(_filled(spark, sf))


def q_leave_one_out_means(spark, sf):
    out = stats.attach_leave_one_out_means(_behavior(spark, sf))
    return out.select("row_id", "user_action_mean", "item_action_mean")


def q_base_features(spark, sf):
    return P.base_features(_behavior(spark, sf), keep=("row_id",))


# ---------------------------------------------------------------- E: windows
def _seq(spark, sf):
    # only the columns the differences need go into the range blocks
    return sequence_features(_with_hour(spark, sf).select("row_id", "user_log_acct", "action_time", "hour"))


def q_hour_diff(spark, sf):
    return _seq(spark, sf).select("row_id", "hour_diff")


def q_action_gap_seconds(spark, sf):
    return _seq(spark, sf).select("row_id", F.col("action_frequency").alias("action_gap_seconds"))


def q_group_transform(spark, sf):
    b = _behavior(spark, sf)
    out = stats.group_transform(b, "item_sku_id", "user_log_acct", prefix="item_user")
    return out.select("row_id", "item_user_count", "item_user_nunique")


# ---------------------------------------------------------------- F: splitting
def q_stratified_split(spark, sf):
    return _split(spark, sf).select("row_id", "target", "split")


def q_split_null_keys(spark, sf):
    """Rows with NULL strata and NULL ids stay in the split: rows per stratum and per split."""
    rid = F.col("row_id")
    rows = _labeled(spark, sf).withColumns({
        "target": F.when(rid % 7 != 3, F.col("target")), "row_id": F.when(rid % 10 != 0, rid)})
    sp = stratified_split(rows, RATIOS, seed=SEED)
    by_stratum = sp.groupBy(F.coalesce(F.col("target").cast("string"), F.lit("none")).alias("name")).agg(
        F.count(F.lit(1)).alias("rows"))
    return by_stratum.unionByName(sp.groupBy(F.col("split").alias("name")).agg(F.count(F.lit(1)).alias("rows")))


def q_split_report(spark, sf):
    return split_report(_split(spark, sf))


# ---------------------------------------------------------------- G: class balance and profiles
def q_class_distribution(spark, sf):
    b = _behavior(spark, sf).withColumn("label", L.multiclass_label())
    return profile.class_distribution(b)


def q_positive_ratio(spark, sf):
    return profile.positive_ratio(_behavior(spark, sf).withColumn("target", L.binary_target()))


def q_class_weights(spark, sf):
    return profile.class_weights(FX.scored(spark, sf))


def q_row_weights(spark, sf):
    return profile.row_weights(FX.scored(spark, sf)).select("row_id", "label", "weight")


NUMERIC_PROFILE_COLS = ["item_sku_id", "action_type", "shop_id", "vender_id", "shop_score", "age", "sex", "user_level"]


def q_numeric_profile(spark, sf):
    return profile.numeric_profile(_behavior(spark, sf), NUMERIC_PROFILE_COLS)


def q_categorical_profile(spark, sf):
    return profile.categorical_profile(_behavior(spark, sf))


def q_dataset_shape(spark, sf):
    return profile.dataset_shape(_behavior(spark, sf))


# ---------------------------------------------------------------- H: learned-model helpers checkable exactly
def q_macro_accuracy(spark, sf):
    return metrics.macro_accuracy(_scored_pred(spark, sf), NUM_CLASSES)


def _members(spark, sf):
    """Three ensemble members' probability rows side by side, joined on the record id."""
    cols = ["row_id", "label"]
    base = FX.scored(spark, sf).select(*cols, L.prob_array("p0", "p1", "p2", "p3", "p4").alias("m0"))
    for r in (1, 2):
        m = FX.scored(spark, sf, rotation=r).select("row_id", L.prob_array("p0", "p1", "p2", "p3", "p4").alias(f"m{r}"))
        base = base.join(m, "row_id")
    return base


def q_soft_vote(spark, sf):
    m = _members(spark, sf)
    mean, pred = soft_vote([F.col("m0"), F.col("m1"), F.col("m2")])
    m = m.withColumn("_mean", mean)
    return m.select("row_id", pred.alias("prediction"),
                    *[F.element_at("_mean", i + 1).alias(f"p{i}") for i in range(NUM_CLASSES)])


# ---------------------------------------------------------------- I: scoring summaries
def q_score_summary(spark, sf):
    s = FX.scored(spark, sf).withColumn("prediction", L.threshold_predict("probability", THRESHOLD))
    return metrics.score_summary(s)


# ---------------------------------------------------------------- J: evaluation
def _binary_scored(spark, sf):
    return FX.scored(spark, sf).withColumn("prediction", L.threshold_predict("probability", THRESHOLD))


def q_binary_metrics(spark, sf):
    return metrics.binary_metrics(_binary_scored(spark, sf))


def q_roc_auc(spark, sf):
    return metrics.roc_auc(FX.scored(spark, sf))


def q_confusion_binary(spark, sf):
    return metrics.confusion_binary(_binary_scored(spark, sf))


def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_scored_pred(spark, sf))


def q_per_class_metrics(spark, sf):
    return metrics.per_class_metrics(_scored_pred(spark, sf))


def q_macro_metrics(spark, sf):
    return metrics.macro_metrics(_scored_pred(spark, sf))


def q_weighted_metrics(spark, sf):
    return metrics.weighted_metrics(_scored_pred(spark, sf))


def q_multiclass_accuracy(spark, sf):
    return metrics.multiclass_accuracy(_scored_pred(spark, sf))


def q_model_comparison(spark, sf):
    m = _members(spark, sf)
    mean, _ = soft_vote([F.col("m0"), F.col("m1"), F.col("m2")])
    models = {name: L.argmax(F.col(name)) for name in ("m0", "m1", "m2")} | {"voting": L.argmax(mean)}
    return metrics.model_comparison(metrics.stacked_models(m, models))


def q_metrics_long(spark, sf):
    return metrics.metrics_long(metrics.binary_metrics(_binary_scored(spark, sf)))


def q_evaluation_report(spark, sf):
    return metrics.evaluation_report(_binary_scored(spark, sf))


def q_split_metrics(spark, sf):
    s = _scored_pred(spark, sf)
    sp = stratified_split(s, RATIOS, seed=SEED)
    return metrics.split_metrics(sp.where(F.col("split") != "train"))


T2_QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def all_queries() -> dict[str, Query]:
    from .plans import learned  # here, because learned imports this package's plans at load

    out = T2_QUERIES | learned.LEARNED_QUERIES
    return {k: (lambda fn: (lambda spark, sf: round_doubles(fn(spark, sf))))(v) for k, v in out.items()}

"""Named queries whose output is learned.

Models are trained once per (session, table folder) and reused by the queries: the binary and the one-vs-rest
five-class one with the reference's settings, the ensemble and the joint one with a shorter schedule.  Scores of two engines' models cannot be compared, so the
queries return what must hold whatever the trees are: rows and labels scored, ranges, sums,
agreement of saved and live models, the patience rule; DuckDB derives the same from the tables.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.fill import fill_missing_typed
from ..functions.request import request_defaults
from ..operators.encode import dictionary_sizes, fit_first_seen_dictionary, fit_native_dictionary, fit_sorted_dictionary
from ..operators.metrics import model_comparison, stacked_models
from ..operators.profile import row_weights
from ..operators.split import stratified_split
from ..operators.stats_state import last_actions, statistics_state
from ..schema import CATEGORICALS, FEATURES, NUM_CLASSES
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources import io
from . import joint as J
from . import train as T
from ..operators.encode import label_encode_joint
from ..schema import RICH_CATEGORICALS
from ..streaming.score_stream import run_request_stream
from .features import base_features, base_statistics, prepare_time, rich_feature_matrix, rich_features
from .score import request_backfill

SEED = 42
RATIOS = (0.7, 0.15, 0.15)
BINARY_QUERY_PARAMS = T.BINARY_PARAMS
MULTICLASS_QUERY_PARAMS = T.MULTICLASS_PARAMS
# the ensemble's boosted member: a larger step and fewer rounds than the reference's, see README
ENSEMBLE_QUERY_PARAMS = T.BoostParams(step_size=0.1, max_depth=6, min_instances_per_node=10, subsampling_rate=0.7,
                                      feature_fraction=0.7, max_iter=30, patience=10)
# the resume check fits every member up to twice and only compares what was fitted and what was loaded
RESUME_PARAMS = T.BoostParams(step_size=0.1, max_depth=3, min_instances_per_node=10, max_iter=5)
JOINT_QUERY_PARAMS = J.JointParams(step_size=0.1, max_iter=30, patience=4, snapshot_every=5)
JOINT_CHECK_PARAMS = J.JointParams(step_size=0.1, max_depth=4, max_iter=3, subsampling_rate=1.0)
JOINT_RESUME_PARAMS = J.JointParams(step_size=0.1, max_depth=3, max_iter=5, snapshot_every=2)
REQUEST_CLOCK = _dt.datetime(2024, 2, 1, 12, 0, 0)

_CACHE: dict[tuple, object] = {}


def _key(spark: SparkSession, sf: str, what: str) -> tuple:
    return (spark.sparkContext.applicationId, sf, what)


def _cached(spark, sf, what, build):
    k = _key(spark, sf, what)
    if k not in _CACHE:
        _CACHE[k] = build()
    return _CACHE[k]


def splits(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Split rows -> per-split 22-feature tables sharing the training dictionary (stats per split)."""
    def build():
        b = FX.behavior(spark, sf)
        labeled = fill_missing_typed(prepare_time(b)).withColumns(
            {"target": L.binary_target(), "label": L.multiclass_label()})
        sp = stratified_split(labeled, RATIOS, seed=SEED)
        path = scratch_path(spark, "split-log")
        io.write_splits(sp, path)   # hand-off table: cuts lineage, survives executor loss
        parts = {name: io.read_split(spark, path, name).drop("split") for name in ("train", "val", "test")}
        dictionary = fit_sorted_dictionary(parts["train"], CATEGORICALS)
        keep = ("row_id", "user_log_acct", "item_sku_id", "action_time", "target", "label")
        # written once: every fit, curve and score reads them again
        feats = {name: T.training_table(base_features(df, keep=keep, dictionary=dictionary)) for name, df in parts.items()}
        return {"raw": parts, "features": feats, "dictionary": dictionary}
    return _cached(spark, sf, "splits", build)


def binary_model(spark: SparkSession, sf: str) -> T.BinaryModel:
    def build():
        f = splits(spark, sf)["features"]
        return T.fit_binary(f["train"], f["val"], FEATURES, BINARY_QUERY_PARAMS, label_col="target")
    return _cached(spark, sf, "binary", build)


def multiclass_model(spark: SparkSession, sf: str) -> T.MultiClassModel:
    def build():
        f = splits(spark, sf)["features"]
        train = row_weights(f["train"], "label", "weight")
        return T.fit_multiclass(train, f["val"], FEATURES, MULTICLASS_QUERY_PARAMS, label_col="label",
                                weight_col="weight", num_classes=NUM_CLASSES)
    return _cached(spark, sf, "multiclass", build)


def rich_sets(spark: SparkSession, sf: str) -> dict:
    """The rich path: features per split file, one joint dictionary over train and validation (8 columns)."""
    def build():
        raw = splits(spark, sf)["raw"]
        rich = {n: T.training_table(rich_features(raw[n])) for n in ("train", "val")}
        enc_train, enc_val = map(T.training_table, label_encode_joint([rich["train"], rich["val"]], RICH_CATEGORICALS))
        cols = [c for c in rich_feature_matrix(enc_train).columns]
        return {"train": enc_train, "val": enc_val, "features": cols, "rich": rich}
    return _cached(spark, sf, "rich_sets", build)


def ensemble(spark: SparkSession, sf: str, path: str | None = None) -> T.Ensemble:
    def build():
        r = rich_sets(spark, sf)
        return T.fit_ensemble(r["train"], r["val"], r["features"], ENSEMBLE_QUERY_PARAMS, label_col="label",
                              path=path)
    return _cached(spark, sf, f"ensemble:{path}", build)


def bundles(spark: SparkSession, sf: str) -> dict[str, str]:
    def build():
        s = splits(spark, sf)
        root = scratch_path(spark, "bundles")
        stats = base_statistics(s["raw"]["train"])
        T.save_bundle(spark, binary_model(spark, sf), f"{root}/binary", s["dictionary"], stats)
        T.save_bundle(spark, multiclass_model(spark, sf), f"{root}/multiclass", s["dictionary"], stats)
        return {"binary": f"{root}/binary", "multiclass": f"{root}/multiclass", "missing": f"{root}/none"}
    return _cached(spark, sf, "bundles", build)


# ------------------------------------------------------------------ queries
def _unit(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.between(0, 1)


def q_train_binary(spark, sf):
    """Validation rows per label, and how many got a probability in [0, 1] and the prediction it implies."""
    m = binary_model(spark, sf)
    out = m.transform(splits(spark, sf)["features"]["val"])
    return out.groupBy("target").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(_unit("probability")).alias("in_range"),
        F.count_if((F.col("probability") > 0.5).cast("int") == F.col("prediction")).alias("consistent"))


def q_early_stopping(spark, sf):
    """The patience rule on the binary curve: the kept round is the best one seen, and the run ended
    ``patience`` rounds after it (or at the last allowed round)."""
    m = binary_model(spark, sf)
    p = BINARY_QUERY_PARAMS
    best = m.best_iteration
    rows = [("kept_round_is_best", m.curve[best - 1] == max(m.curve) and best == m.curve.index(max(m.curve)) + 1),
            ("stopped_by_patience", m.stop_round - best == p.patience or m.stop_round == p.max_iter),
            ("model_has_kept_rounds", m.model.getNumTrees == best),
            ("fitted_at_most_twice_the_stop", m.fitted_rounds <= max(2 * m.stop_round, 2 * p.patience))]
    return spark.createDataFrame(rows, "rule string, holds boolean")


def _curve_shape(curve: DataFrame) -> DataFrame:
    """Per split and metric: rounds 1..n each once, and all values in the metric's range."""
    in_range = F.when(F.col("metric").endswith("logloss"), F.col("value") >= 0).otherwise(_unit("value"))
    return curve.groupBy("split", "metric").agg(
        ((F.count(F.lit(1)) == F.max("iteration")) & (F.countDistinct("iteration") == F.max("iteration"))).alias("gapless"),
        F.every(in_range).alias("in_range"))


def q_learning_curve(spark, sf):
    m = binary_model(spark, sf)
    f = splits(spark, sf)["features"]
    return _curve_shape(T.learning_curve(m.path, spark, {"train": f["train"], "valid": f["val"]}, FEATURES,
                                         last_round=m.stop_round))


def q_multiclass_learning_curve(spark, sf):
    m = multiclass_model(spark, sf)
    f = splits(spark, sf)["features"]
    return _curve_shape(T.multiclass_learning_curve(m, {"train": f["train"], "valid": f["val"]}, NUM_CLASSES,
                                                    last_round=m.stop_round))


def q_train_multiclass(spark, sf):
    """Validation rows per label, and how many got class probabilities that sum to 1 and their argmax."""
    m = multiclass_model(spark, sf)
    out = m.transform(splits(spark, sf)["features"]["val"])
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    return out.groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        F.count_if(F.element_at("probabilities", F.col("prediction") + 1) == F.array_max("probabilities")).alias("consistent"))


def ensemble_predictions(spark, sf) -> DataFrame:
    e = ensemble(spark, sf)
    out = e.transform(rich_sets(spark, sf)["val"])
    return out.select("row_id", "label", L.argmax("p_boosted").alias("boosted"), L.argmax("p_forest").alias("forest"),
                      L.argmax("p_linear").alias("linear"), F.col("prediction").alias("voting"), "p_vote")


def q_train_ensemble_members(spark, sf):
    """Validation rows per label: each member and the vote name a class, the vote's probabilities sum to 1."""
    total = F.aggregate("p_vote", F.lit(0.0), lambda a, b: a + b)
    classes = [F.count_if(F.col(n).between(0, NUM_CLASSES - 1)).alias(n) for n in ("boosted", "forest", "linear", "voting")]
    return ensemble_predictions(spark, sf).groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), *classes, F.count_if(F.abs(total - 1) < 1e-9).alias("sums_to_one"))


def q_ensemble_comparison(spark, sf):
    """Validation accuracy and weighted precision / recall / F1 of each member and of the vote are in [0, 1];
    weighted recall is accuracy."""
    m = ensemble_predictions(spark, sf)
    out = model_comparison(stacked_models(m, {n: F.col(n) for n in ("boosted", "forest", "linear", "voting")}))
    ok = _unit("accuracy") & _unit("precision") & _unit("recall") & _unit("f1")
    return out.select("model", ok.alias("in_range"), (F.abs(F.col("recall") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"))


def q_resume_training(spark, sf):
    """Per member: the first run fits it, a second run with the same data and parameters loads it, and a
    third with other parameters fits it anew."""
    path = scratch_path(spark, "resumable-ensemble")
    r = rich_sets(spark, sf)
    fitted = []
    for params, trees, iterations in ((RESUME_PARAMS, 10, 20), (RESUME_PARAMS, 10, 20),
                                      (replace(RESUME_PARAMS, max_iter=4), 9, 19)):
        events: list[tuple[str, bool]] = []
        T.fit_ensemble(r["train"], None, r["features"], params, label_col="label", path=path, num_trees=trees,
                       max_iter_linear=iterations, resume=True, events=events)
        fitted.append(dict(events))
    rows = [(m, fitted[0][m], not fitted[1][m], fitted[2][m]) for m in sorted(fitted[0])]
    return spark.createDataFrame(rows, "member string, first_run_fitted boolean, second_run_loaded boolean, "
                                       "refit_on_change boolean")


def q_model_roundtrip(spark, sf):
    """Test rows, and how many score the same with the trained and the saved and loaded model."""
    m = binary_model(spark, sf)
    loaded, _ = T.load_bundle(spark, bundles(spark, sf)["binary"])
    test = splits(spark, sf)["features"]["test"]
    a = m.transform(test).select("row_id", F.col("probability").alias("p_trained"))
    b = loaded.transform(test).select("row_id", F.col("probability").alias("p_loaded"))
    return a.join(b, "row_id").agg(F.count(F.lit(1)).alias("rows"),
                                   F.count_if(F.col("p_trained") == F.col("p_loaded")).alias("equal_rows"))


def q_score_batch(spark, sf):
    """The written prediction table of the test log: every row's ids, with a valid and consistent score."""
    model, dictionary = T.load_bundle(spark, bundles(spark, sf)["binary"])
    raw_test = splits(spark, sf)["raw"]["test"]
    keep = ("user_log_acct", "item_sku_id", "action_time")
    scored = model.transform(base_features(raw_test, keep=keep, dictionary=dictionary))
    path = scratch_path(spark, "scores")
    io.write_predictions(scored, path, fmt="parquet")
    return spark.read.parquet(path).select(
        *keep, _unit("probability").alias("in_range"),
        ((F.col("probability") > 0.5).cast("int") == F.col("prediction")).alias("consistent"))


def q_score_ensemble(spark, sf):
    """The prediction table of the test log by a saved ensemble: every row's ids, a class and the vote's probability of it
    (the greatest of five that sum to 1)."""
    from . import jobs

    r, raw = rich_sets(spark, sf), splits(spark, sf)["raw"]
    root = scratch_path(spark, "ensemble-scoring")
    log = prepare_time(raw["train"])
    dictionary = fit_native_dictionary([r["rich"]["train"], r["rich"]["val"]], RICH_CATEGORICALS)
    T.save_bundle(spark, ensemble(spark, sf), f"{root}/bundle", dictionary,
                  {"state": statistics_state(log), "last_actions": last_actions(log)})
    io.write_table(raw["test"].drop("target", "label"), f"{root}/log", fmt="csv")
    jobs.predict_job(spark, f"{root}/bundle", f"{root}/log", f"{root}/out", out_fmt="parquet")
    return spark.read.parquet(f"{root}/out").select(
        "user_log_acct", "item_sku_id", "action_time", F.col("probability").between(1 / NUM_CLASSES, 1).alias("in_range"),
        F.col("prediction").between(0, NUM_CLASSES - 1).alias("consistent"))


def _importance_check(spark, models: list, importance: DataFrame) -> DataFrame:
    """Features listed, and whether all splits of the models' trees are counted (inner nodes of binary trees
    are half of the nodes, rounded down)."""
    inner = sum((t.numNodes - 1) // 2 for m in models for t in m.trees)
    return importance.agg(F.count(F.lit(1)).alias("features"), (F.sum("splits") == F.lit(inner)).alias("all_splits"))


def q_feature_importance(spark, sf):
    m = binary_model(spark, sf)
    best = f"{m.path}/best" if T.path_exists(spark, f"{m.path}/best/metadata") else f"{m.path}/full"
    return _importance_check(spark, [m.model], T.feature_importance(spark, best, FEATURES, top_n=len(FEATURES)))


def q_multiclass_feature_importance(spark, sf):
    m = multiclass_model(spark, sf)
    kind = "best" if T.path_exists(spark, f"{m.path}/best/class_0/metadata") else "full"
    paths = [f"{m.path}/{kind}/class_{c}" for c in m.classes]
    return _importance_check(spark, list(m.members.values()),
                             T.feature_importance(spark, paths, FEATURES, top_n=len(FEATURES)))


def joint_model(spark: SparkSession, sf: str) -> J.JointModel:
    def build():
        s = splits(spark, sf)
        f = s["features"]
        return J.fit_joint(row_weights(f["train"]), f["val"], FEATURES, JOINT_QUERY_PARAMS, num_classes=NUM_CLASSES,
                           categories=dictionary_sizes(s["dictionary"]))
    return _cached(spark, sf, "joint", build)


def q_train_joint(spark, sf):
    """Every training and validation row: its softmax gradients (label indicator minus probability) sum to 0, are
    positive for the row's own class only, and the prediction is the class of the greatest probability."""
    m = joint_model(spark, sf)
    f = splits(spark, sf)["features"]
    out = f["train"].select("row_id", "label", *FEATURES).unionByName(f["val"].select("row_id", "label", *FEATURES))
    out = m.transform(out)
    slopes = F.transform("probabilities", lambda p, i: F.when(i == F.col("label"), 1 - p).otherwise(-p))
    return out.select("row_id", "label", F.abs(F.round(F.aggregate(slopes, F.lit(0.0), lambda a, b: a + b), 6)).alias("gradient_sum"),
                      (F.size(F.filter(slopes, lambda g: g > 0)) == 1).alias("one_positive"),
                      (F.element_at("probabilities", F.col("prediction") + 1) == F.array_max("probabilities")).alias("consistent"))


def q_joint_leaf_values(spark, sf):
    """Per (round, class) of a short run on all rows: rows and, in the first round, the sums of gradient and curvature at
    the root; whether children add up to their parents and every leaf's value follows from its sums."""
    p = JOINT_CHECK_PARAMS
    train = row_weights(splits(spark, sf)["features"]["train"])
    m = J.fit_joint(train, None, FEATURES, p, num_classes=NUM_CLASSES)
    nodes = m.nodes(spark)
    shrunk = F.signum("g") * F.greatest(F.abs("g") - p.lambda_l1, F.lit(0.0))
    rule = (F.col("leaf") < 0) | (F.abs(F.col("value") - p.step_size * shrunk / (F.col("h") + p.lambda_l2)) < 1e-9)
    child = nodes.select(F.col("round").alias("_r"), F.col("cls").alias("_c"), F.col("id").alias("_i"), F.col("g").alias("_g"),
                         F.col("rows").alias("_n"))
    inner = nodes.where("leaf < 0").select("round", "cls", "g", "rows", F.explode(F.array("left", "right")).alias("_i"), "id")
    sums = (inner.join(child, (F.col("round") == F.col("_r")) & (F.col("cls") == F.col("_c")) & (inner["_i"] == child["_i"]))
            .groupBy("round", "cls", "id").agg(((F.abs(F.sum("_g") - F.max("g")) < 1e-6) & (F.sum("_n") == F.max("rows"))).alias("ok"))
            .groupBy("round", "cls").agg(F.every("ok").alias("children_add_up")))
    first = F.col("round") == 1
    root = nodes.groupBy("round", "cls").agg(
        F.max_by("rows", -F.col("id")).alias("rows"), F.max_by("g", -F.col("id")).alias("g"), F.max_by("h", -F.col("id")).alias("h"),
        F.every(rule).alias("leaf_rule"))
    return root.join(sums, ["round", "cls"], "left").select(
        "round", "cls", "rows", F.when(first, F.abs(F.round("g", 5))).alias("root_gradient"),
        F.when(first, F.round("h", 3)).alias("root_curvature"), "leaf_rule",
        F.coalesce("children_add_up", F.lit(True)).alias("children_add_up"))


def q_joint_early_stopping(spark, sf):
    """One run: the trees fitted are the rounds until the stop, the model has those up to the best round, and the metric
    that stalled had its best value there."""
    m = joint_model(spark, sf)
    p = JOINT_QUERY_PARAMS
    best, metric = J.stalled(m.curve, p.patience, tuple(J.METRICS))
    values = [r[metric or "multi_logloss"] for r in m.curve]
    fitted = J.all_nodes(spark, m.run).agg(F.max("round")).first()[0]
    rows = [("trees_fitted_are_rounds_run", fitted == len(m.curve) == m.fitted_rounds),
            ("stopped_by_patience", m.fitted_rounds - m.best_iteration == p.patience or m.fitted_rounds == p.max_iter),
            ("kept_round_is_best", m.best_iteration == best == 1 + values.index((max if J.METRICS.get(metric) else min)(values))),
            ("model_has_kept_rounds", all(t.getNumTrees == m.best_iteration for t in m.members.values()))]
    return spark.createDataFrame(rows, "rule string, holds boolean")


def q_joint_resume(spark, sf):
    """Per (round, class): a run that died after the third round and went on from its snapshot grew the same tree as a
    run that did not die."""
    train = T.training_table(row_weights(splits(spark, sf)["features"]["train"]))
    whole = J.fit_joint(train, None, FEATURES, JOINT_RESUME_PARAMS, num_classes=NUM_CLASSES).nodes(spark)
    path = scratch_path(spark, "joint-resume")
    try:
        J.fit_joint(train, None, FEATURES, JOINT_RESUME_PARAMS, num_classes=NUM_CLASSES, path=path, fail_after=3)
    except InterruptedError:
        pass
    again = J.fit_joint(train, None, FEATURES, JOINT_RESUME_PARAMS, num_classes=NUM_CLASSES, path=path, resume=True).nodes(spark)
    same = ["round", "cls", "id", "feature", "split", "left", "right", "rows"]
    a, b = (n.select(*same, F.round("value", 9).alias("value")) for n in (whole, again))
    both = a.withColumn("_run", F.lit(1)).unionByName(b.withColumn("_run", F.lit(2)))
    per_node = both.groupBy(*same, "value").agg(F.collect_set("_run").alias("_runs"))
    return per_node.groupBy("round", "cls").agg(F.every(F.size("_runs") == 2).alias("same_tree"))


def score_requests(spark: SparkSession, requests: DataFrame, sample: DataFrame, stats_sample: DataFrame,
                   multiclass_path: str, binary_path: str, now: _dt.datetime | None = None,
                   first_seen: bool = False) -> DataFrame:
    """Request rows -> (action_type, name, class probabilities, confidence, two-valued flag).

    Uses the five-class bundle, or the binary one when it is missing, with the bundle's training dictionary
    and frozen user and item statistics; users and items it does not know get the sample's means.
    ``first_seen`` encodes in the sample's first-seen order instead.  Blank times are ``now`` (the
    current time if None).  Works on batch and streaming ``requests`` alike.
    """
    path = T.scoring_bundle(spark, multiclass_path, binary_path)
    model, dictionary = T.load_bundle(spark, path)
    if first_seen or dictionary is None:
        dictionary = fit_first_seen_dictionary(sample, CATEGORICALS)
    feats = request_backfill(request_defaults(requests, now=now), sample, stats_sample,
                             keep=("row_id",), dictionary=dictionary, statistics=T.load_statistics(spark, path))
    if isinstance(model, (T.MultiClassModel, J.JointModel)):
        out = model.class_probabilities(feats).withColumn("_p", F.col("probabilities"))
    else:
        # a binary model gives one probability per record; it is padded like any short row
        out = model.transform(feats).withColumn("_p", F.array(F.col("probability")))
    out = out.withColumn("_p", L.pad_probabilities("_p"))
    pred = L.argmax("_p") + 1
    return out.select("row_id", pred.alias("action_type"), L.action_name(pred, one_based=True).alias("action_name"),
                      L.confidence_multiclass("_p").alias("confidence"), L.two_valued("_p").alias("two_valued"),
                      *[F.element_at("_p", i + 1).alias(f"p{i + 1}") for i in range(NUM_CLASSES)])


def _scorer(spark, sf, fallback: bool = False):
    b, s = bundles(spark, sf), splits(spark, sf)
    sample, stats_sample = s["raw"]["val"], s["features"]["val"]
    return lambda requests: score_requests(spark, requests, sample, stats_sample,
                                           b["missing" if fallback else "multiclass"], b["binary"], now=REQUEST_CLOCK)


def _record_check(scored: DataFrame) -> DataFrame:
    """Every request once, its action the argmax of its probabilities; their sum (1 for a five-class model)."""
    p = F.array(*[F.col(f"p{i + 1}") for i in range(NUM_CLASSES)])
    total = F.aggregate(p, F.lit(0.0), lambda a, b: a + b)
    return scored.select("row_id", F.round(total, 6).alias("p_sum"),
                         (F.element_at(p, F.col("action_type")) == F.array_max(p)).alias("consistent"),
                         F.col("action_name").isNotNull().alias("named"))


def q_score_records(spark, sf):
    return _record_check(_scorer(spark, sf)(FX.requests(spark, sf)))


def q_score_records_fallback(spark, sf):
    """A binary model's records: one probability in [0, 1] padded with zeros, so two-valued."""
    out = _scorer(spark, sf, fallback=True)(FX.requests(spark, sf))
    return _record_check(out).drop("p_sum").join(out.select("row_id", "two_valued", _unit("p1").alias("in_range")), "row_id")


def q_score_records_stream(spark, sf):
    inbox, sink, ckpt = (scratch_path(spark, n) for n in ("request-inbox", "request-scores", "request-stream-ckpt"))
    requests = FX.requests(spark, sf)
    requests.write.parquet(inbox)
    return _record_check(run_request_stream(spark, inbox, requests.schema, sink, ckpt, _scorer(spark, sf)))


LEARNED_QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)}

"""Boosted-tree training, early stopping, learning curves, ensembles and persistence (MLlib).

* Binary and one-vs-rest five-class models are MLlib ``GBTClassificationModel``s; their trees are grown by ``boost`` from
  binned rows with the settings and the rules of MLlib's ``GBTClassifier`` (first tree on the labels, then mean residuals of
  the log loss, variance gain, a sample of rows per round and of features per node), all classes of a round together.
  Class probabilities are the members' positive probabilities divided by their sum.
* Patience: margins are carried forward, so a run goes on where it is.  Five classes are checked after every round; the
  binary model after twice the patience, then after every doubling; the kept model is the trees up to the best round.
* Resume: every member is saved as its fit ends, with a marker written last that names its
  parameters, features, label and data; a member is loaded only if the marker says the same.
* Persistence: a bundle folder on the shared file system holds the models, the
  feature list and (optionally) the frozen category dictionary.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       LogisticRegressionModel, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import argmax
from ..session import checkpoint_root, scratch_path
from . import boost as B

FEATURES_COL = "features"


# ------------------------------------------------------------------ parameters
@dataclass
class BoostParams:
    """Reference knobs mapped to MLlib: leaves -> depth (31 -> 5, 63 -> 6), min leaf -> minInstancesPerNode,
    feature / bagging fraction -> featureSubsetStrategy / subsamplingRate.  L1/L2 on leaves has no MLlib twin."""
    step_size: float = 0.05
    max_depth: int = 5
    min_instances_per_node: int = 20
    subsampling_rate: float = 0.8
    feature_fraction: float = 0.8
    max_iter: int = 1000
    patience: int = 50
    max_bins: int = 255
    checkpoint_interval: int = 10
    seed: int = 42

    def estimator(self, label_col: str, weight_col: str | None = None) -> GBTClassifier:
        est = GBTClassifier(
            featuresCol=FEATURES_COL, labelCol=label_col, maxIter=self.max_iter, stepSize=self.step_size,
            maxDepth=self.max_depth, minInstancesPerNode=self.min_instances_per_node,
            subsamplingRate=self.subsampling_rate, featureSubsetStrategy=str(self.feature_fraction),
            maxBins=self.max_bins, checkpointInterval=self.checkpoint_interval, seed=self.seed)
        if weight_col:
            est = est.setWeightCol(weight_col)
        return est


# The reference's settings for its three trainers.
BINARY_PARAMS = BoostParams(step_size=0.05, max_depth=5, min_instances_per_node=20, subsampling_rate=0.8,
                            feature_fraction=0.8, max_iter=1000, patience=50)
DEMO_PARAMS = BoostParams(step_size=0.05, max_depth=5, min_instances_per_node=20, subsampling_rate=0.8,
                          feature_fraction=0.8, max_iter=100, patience=20)
MULTICLASS_PARAMS = BoostParams(step_size=0.01, max_depth=6, min_instances_per_node=10, subsampling_rate=0.7,
                                feature_fraction=0.7, max_iter=2000, patience=100)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature columns stay flat until here; NULLs become NaN-free -1 like the reference's fill."""
    filled = df.na.fill(-1, subset=list(features))
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES_COL, handleInvalid="keep").transform(filled)


# a task of a tree's level sends bins x features x nodes sums whatever its rows, and the driver hears of every task
# of every level: tasks are large, few rows still make up to MIN_TRAINING_TASKS of them
ROWS_PER_TRAINING_TASK, MIN_TRAINING_TASKS, MIN_ROWS_PER_TRAINING_TASK = 500_000, 12, 20_000


def training_table(df: DataFrame) -> DataFrame:
    """The feature pipeline's result written once; fits and fingerprints read the table."""
    path = scratch_path(df.sparkSession, "training-table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def training_tasks(n_rows: int) -> int:
    """Partitions of a training frame; their number follows from the rows alone."""
    return max(-(-n_rows // ROWS_PER_TRAINING_TASK),
               min(MIN_TRAINING_TASKS, -(-n_rows // MIN_ROWS_PER_TRAINING_TASK)), 1)


def training_frame(table: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature vectors with the other columns (label, weight), in partitions that depend on the rows alone.

    MLlib samples rows per partition in their order, so partitions are dealt by the rows' hash, sorted,
    and as many as the row count asks for: the same data and seed give the same model on any cluster.
    """
    key = F.xxhash64(*[F.col(f"`{c}`") for c in table.columns])
    dealt = table.withColumn("_deal", key).repartition(training_tasks(table.count()), "_deal").sortWithinPartitions("_deal")
    return assemble(dealt, features).drop("_deal", *features)


def data_id(table: DataFrame) -> str:
    """Count and order-free hash of a table's rows."""
    row = table.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in table.columns])),
                                                  F.lit(0))).first()
    return f"{row[0]}:{row[1]}"


def positive_probability(col: str = "probability"):
    return vector_to_array(F.col(col))[1]


# ------------------------------------------------------------------ tree-prefix models
def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a saved leaf folder (e.g. a model's ``metadata``) exists: a file listing through
    the text source, without partition inference; no job runs."""
    try:
        spark.read.option("recursiveFileLookup", "true").text(path)
        return True
    except AnalysisException:
        return False


def fingerprint(estimator, features: Sequence[str], data: str) -> str:
    """What a saved member was fitted with: class, parameters, feature columns and data."""
    params = {p.name: str(v) for p, v in estimator.extractParamMap().items()}
    return json.dumps([type(estimator).__name__, params, list(features), data], sort_keys=True)


def save_member(spark: SparkSession, model, path: str, mark: str) -> None:
    """The model, then its marker: a member without a marker was not saved in full."""
    model.write().overwrite().save(path)
    spark.createDataFrame([(mark,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.done")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def saved_text(spark: SparkSession, path: str) -> str | None:
    line = spark.read.option("wholetext", "true").text(path).first() if path_exists(spark, path) else None
    return line[0].strip() if line is not None and line[0].strip() else None


def saved_member(spark: SparkSession, cls, path: str, mark: str):
    """The saved member if it is complete and was fitted with the same things, else None."""
    return cls.load(path) if saved_text(spark, f"{path}.done") == mark.rstrip("\n") else None


def save_prefix(spark: SparkSession, saved: str, rounds: int, path: str) -> None:
    """The first ``rounds`` trees of a saved boosted model as a saved model: boosting is sequential, so these are the
    trees that a run of ``rounds`` rounds fits."""
    for part, tree in (("data", "treeID"), ("treesMetadata", "_1")):
        spark.read.parquet(f"{saved}/{part}").where(F.col(tree) < rounds).write.mode("overwrite").parquet(f"{path}/{part}")
    meta = json.loads(spark.read.option("wholetext", "true").text(f"{saved}/metadata").first()[0])
    meta["numTrees"], meta["paramMap"] = rounds, meta["paramMap"] | {"maxIter": rounds}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def _fit_or_load(spark: SparkSession, estimator, cls, data: DataFrame, path: str, mark: str, resume: bool,
                 events: list | None = None):
    name = path.rstrip("/").rsplit("/", 1)[-1]
    found = saved_member(spark, cls, path, mark) if resume else None
    if events is not None:
        events.append((name, found is None))
    if found is None:
        found = estimator.fit(data)
        save_member(spark, found, path, mark)
    return found


def _patience_scan(curve: Sequence[float], patience: int, higher_is_better: bool) -> tuple[int, int | None]:
    """(index of the best round, index of the round where the patience rule stops or None)."""
    best_i, best_v = 0, None
    for i, v in enumerate(curve):
        better = best_v is None or (v > best_v if higher_is_better else v < best_v)
        if better:
            best_i, best_v = i, v
        elif i - best_i >= patience:
            return best_i, i
    return best_i, None


def best_prefix(curve: Sequence[float], patience: int, higher_is_better: bool = False) -> int:
    """Number of trees kept by patience-based early stopping on a validation curve.

    Scans rounds in order, tracks the best value, stops once ``patience`` rounds pass
    without improvement, and returns 1 + the best round.
    """
    return _patience_scan(curve, patience, higher_is_better)[0] + 1


EVAL_CHUNK_ROUNDS = 100


def patience_curve(score_rounds: Callable[[list[int]], list[float]], n_rounds: int, patience: int,
                   eval_every: int = 1, higher_is_better: bool = False) -> tuple[list[float], int]:
    """Validation curve scored in chunks of rounds until the patience rule stops.

    ``score_rounds(rounds)`` returns the metric of each given round (one Spark job
    over the validation rows per chunk).  A chunk holds at least one patience window
    and ``EVAL_CHUNK_ROUNDS`` rounds, so rounds after the stop are scored at most one
    chunk ahead and the staged rows per job stay bounded.  Returns the curve up to and
    including the round where training would have stopped, and the trees kept.
    """
    rounds = list(range(eval_every, n_rounds + 1, eval_every))
    p = max(1, patience // eval_every)
    step = max(p, EVAL_CHUNK_ROUNDS // eval_every, 1)
    curve: list[float] = []
    best_i = 0
    for start in range(0, len(rounds), step):
        curve += score_rounds(rounds[start:start + step])
        best_i, stop = _patience_scan(curve, p, higher_is_better)
        if stop is not None:
            curve = curve[:stop + 1]
            break
    return curve, (best_i + 1) * eval_every


# ------------------------------------------------------------------ binary
@dataclass
class BinaryModel:
    model: GBTClassificationModel
    features: list[str]
    best_iteration: int
    path: str
    curve: list[float] = field(default_factory=list)
    fitted_rounds: int = 0
    stop_round: int = 0   # last round scored by the patience rule (all fitted rounds without validation)

    def transform(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        out = self.model.transform(assemble(df, self.features))
        p = positive_probability("probability")
        return (out.withColumn("probability", p)
                .withColumn("prediction", (F.col("probability") > F.lit(threshold)).cast("int"))
                .drop(FEATURES_COL, "rawPrediction"))


def _stop_rule(metric: str, every: int, patience: int, higher: bool):
    """Whether a curve of metric rows has stalled, asked after every round."""
    scan = _patience_scan
    return lambda curve: scan([row[metric] for row in curve[every - 1::every]], patience, higher)[1] is not None


class _Run:
    """One run of boosting, every class against the others: binned rows, their margins and the trees so far.  Rounds go on
    from the margins; nothing is fitted twice."""

    def __init__(self, train: DataFrame, val: DataFrame | None, features: Sequence[str], params: BoostParams, label_col: str,
                 weight_col: str | None, classes: tuple[int, ...]):
        self.spark, self.params, self.features = train.sparkSession, params, list(features)
        table = B.rows_of(train, features, label_col, F.col(weight_col) if weight_col else F.lit(1.0), False, {})
        if val is not None:
            table = table.unionByName(B.rows_of(val, features, label_col, F.lit(1.0), True, {}))
        self.table = training_table(table.withColumn("_key", F.xxhash64(*[F.col(f"`{c}`") for c in table.columns])))
        self.done, self.curve, self.state, self.path = 0, [], None, scratch_path(self.spark, "boost-nodes")
        self.only(classes)

    def only(self, classes: Sequence[int]) -> None:
        """The classes to grow (before the first round)."""
        self.classes = tuple(classes)

    def _start(self) -> None:
        p = self.params
        n = {r["_val"]: r.n for r in self.table.groupBy("_val").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.thresholds = B.find_thresholds(self.table, self.features, {}, p.max_bins, n.get(False, 0))
        widths = tuple(len(t) + 1 for t in self.thresholds)
        self.parts = B.parts_of(sum(n.values()), len(self.classes))
        self.settings = B.Settings("logistic", self.classes, widths, (False,) * len(widths), p.max_depth, p.min_instances_per_node,
                                   math.ceil(p.feature_fraction * len(widths)), p.subsampling_rate, 1, p.step_size, p.seed,
                                   scored=True in n)
        state = B.blocks_of(self.table, self.thresholds, widths, {}, self.parts, [0.0] * len(self.classes))
        self.state = B.dealt(training_table(state), self.parts)

    def grow(self, rounds: int, stop=None) -> int:
        """Goes on up to round ``rounds`` or until ``stop(curve)``; returns the rounds grown so far."""
        if self.state is None:
            self._start()
        while self.done < rounds:
            last = min(rounds, self.done + B.chunk_rounds(self.parts))
            self.state, grown = B.advance(self.state, self.settings, self.parts, self.done + 1, last, self.curve, stop)
            B.write_nodes(self.spark, [row for r, trees in enumerate(grown, self.done + 1) for c, tree in enumerate(trees)
                                       for row in B.node_rows(tree, r, c, self.thresholds, self.settings)], f"{self.path}/part={last}")
            self.done += len(grown)
            if self.done < last:
                break
            if stop is not None and stop(self.curve):
                break
        return self.done

    def save(self, member: int, rounds: int, path: str, est: GBTClassifier) -> None:
        """The trees of one class as a saved ``GBTClassificationModel`` with the estimator's parameters."""
        nodes = self.spark.read.schema(f"{B.NODES}, part int").parquet(self.path).where(F.col("cls") == member)
        params = {p.name: v for p, v in est.extractParamMap().items() if est.isSet(p)}
        B.save_model(self.spark, nodes, rounds, len(self.features), path, "org.apache.spark.ml.classification.GBTClassificationModel",
                     est.uid, params, self.params.step_size)


def _rounds_until_stop(params: BoostParams, fit, curve_of, every: int = 1) -> tuple[object, int, list[float], int]:
    """(model, rounds fitted, curve, best round): twice the patience first, doubled until the rule stops (a longer run goes
    on from the shorter one); all ``max_iter`` rounds at once where the first doubling would reach them."""
    rounds = min(params.max_iter, max(2 * params.patience, 1))
    if 2 * rounds >= params.max_iter:
        rounds = params.max_iter
    while True:
        model = fit(rounds)
        curve, best = curve_of(model, rounds)
        if len(curve) < rounds // every or rounds >= params.max_iter:
            return model, rounds, curve, best
        rounds = min(params.max_iter, 2 * rounds)


def fit_binary(train: DataFrame, val: DataFrame | None, features: Sequence[str], params: BoostParams = BINARY_PARAMS,
               label_col: str = "target", path: str | None = None, stop_metric: str = "auc",
               eval_every: int = 1) -> BinaryModel:
    """Boost until ``params.patience`` rounds bring nothing on the validation curve; keep the best round's model.

    ``stop_metric='auc'`` (the reference's) scores every ``eval_every``-th round exactly from staged
    margins; ``'logloss'`` adds up losses per batch (no row is repeated per round; for large validation sets).
    """
    from .staged import binary_round_loss, binary_round_scores, curve_from_metrics

    if stop_metric not in ("auc", "logloss"):
        raise ValueError(f"unknown stop metric {stop_metric!r}")
    spark = train.sparkSession
    checkpoint_root(spark)
    path = path or scratch_path(spark, "binary-model")
    run = _Run(train, None, features, params, label_col, None, (1,))
    every = eval_every if stop_metric == "auc" else 1
    scored: dict[int, float] = {}  # round -> metric

    def fit(rounds: int) -> GBTClassificationModel:
        run.grow(rounds)
        run.save(0, rounds, f"{path}/full", replace(params, max_iter=rounds).estimator(label_col))
        return GBTClassificationModel.load(f"{path}/full")

    def curve_of(model: GBTClassificationModel, n: int) -> tuple[list[float], int]:
        def score(rounds: list[int]) -> list[float]:
            new = [r for r in rounds if r not in scored]
            if new and stop_metric == "logloss":
                scored.update(zip(new, curve_from_metrics(binary_round_loss(val, model, features, new, label_col), "logloss"), strict=True))
            elif new:
                scored.update(zip(new, curve_from_metrics(binary_round_scores(val, model, features, new, label_col), "auc"), strict=True))
            return [scored[r] for r in rounds]

        return patience_curve(score, n, params.patience, every, higher_is_better=stop_metric == "auc")

    if val is None:
        full, n, curve, best = fit(params.max_iter), params.max_iter, [], params.max_iter
    else:
        full, n, curve, best = _rounds_until_stop(params, fit, curve_of, every)
    model = full
    if best < full.getNumTrees:
        save_prefix(spark, f"{path}/full", best, f"{path}/best")
        model = GBTClassificationModel.load(f"{path}/best")
    stop = n if val is None else len(curve) * every
    return BinaryModel(model, list(features), best, path, curve, fitted_rounds=full.getNumTrees, stop_round=stop)


# ------------------------------------------------------------------ five classes
@dataclass
class MultiClassModel:
    members: dict[int, GBTClassificationModel]
    features: list[str]
    best_iteration: int
    path: str
    curve: list[float] = field(default_factory=list)
    stop_round: int = 0   # last round scored by the patience rule (all fitted rounds without validation)

    @property
    def classes(self) -> list[int]:
        return sorted(self.members)

    def class_probabilities(self, df: DataFrame) -> DataFrame:
        """Adds ``probabilities``: normalised one-vs-rest positive probabilities (chained transforms, no joins)."""
        out = assemble(df, self.features)
        for c in self.classes:
            m = self.members[c].copy()
            m.setRawPredictionCol(f"_raw{c}").setProbabilityCol(f"_prob{c}").setPredictionCol(f"_pred{c}")
            out = m.transform(out).withColumn(f"_pos{c}", positive_probability(f"_prob{c}")).drop(
                f"_raw{c}", f"_prob{c}", f"_pred{c}")
        pos = F.array(*[F.col(f"_pos{c}") for c in self.classes])
        total = F.aggregate(pos, F.lit(0.0), lambda a, b: a + b)
        n = float(len(self.classes))
        probs = F.when(total > 0, F.transform(pos, lambda x: x / total)).otherwise(
            F.array_repeat(F.lit(1.0 / n), len(self.classes)))
        return out.withColumn("probabilities", probs).drop(FEATURES_COL, *[f"_pos{c}" for c in self.classes])

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.class_probabilities(df)
        return out.withColumn("prediction", argmax("probabilities"))


def fit_multiclass(train: DataFrame, val: DataFrame | None, features: Sequence[str],
                   params: BoostParams = MULTICLASS_PARAMS, label_col: str = "label", weight_col: str | None = "weight",
                   num_classes: int = 5, path: str | None = None, resume: bool = False, stop_metric: str = "multi_logloss", eval_every: int = 1,
                   events: list | None = None) -> MultiClassModel:
    """One weighted boosted model per class, grown together and saved as the run ends.

    With ``resume``, members saved under ``path`` with the same parameters, features and data are loaded
    (``events`` collects (member, fitted)); with validation rows all of them or none.  The patience rule runs on the validation ``multi_logloss``
    (or ``macro_acc``) of the normalised one-vs-rest probabilities.
    """
    spark = train.sparkSession
    checkpoint_root(spark)
    path = path or scratch_path(spark, "multiclass-model")
    higher, every = stop_metric == "macro_acc", eval_every
    run = _Run(train, val, features, params, label_col, weight_col, tuple(range(num_classes)))
    data = data_id(run.table)
    ests = [params.estimator("_y", weight_col) for _ in range(num_classes)]
    marks = [json.dumps([fingerprint(e, features, data), stop_metric, every, params.patience] if val is not None else
                        fingerprint(e, features, data)) for e in ests]
    names = [f"class_{c}" for c in range(num_classes)]
    members = {c: saved_member(spark, GBTClassificationModel, f"{path}/full/{n}", marks[c]) for c, n in enumerate(names)} if resume else {}
    members = {c: m for c, m in members.items() if m is not None}
    curve_mark = saved_text(spark, f"{path}/full/curve") if len(members) == num_classes and val is not None else None
    if val is not None and curve_mark is None:
        members = {}  # the patience rule needs the margins of all classes
    if events is not None:
        events += [(n, c not in members) for c, n in enumerate(names)]
    missing = [c for c in range(num_classes) if c not in members]
    n, rounds_curve = params.max_iter, json.loads(curve_mark) if curve_mark else []
    if missing:
        run.only(missing)
        patience = max(1, params.patience // every)
        stops = _stop_rule(stop_metric, every, patience, higher) if val is not None else None
        n = run.grow(params.max_iter, stops)
        rounds_curve = run.curve
        for i, c in enumerate(missing):
            run.save(i, n, f"{path}/full/{names[c]}", ests[c].copy().setMaxIter(n))
            members[c] = GBTClassificationModel.load(f"{path}/full/{names[c]}")
        if val is not None:
            write_text(spark, json.dumps(rounds_curve), f"{path}/full/curve")
        for c in missing:
            write_text(spark, marks[c], f"{path}/full/{names[c]}.done")
    members = dict(sorted(members.items()))
    if val is None:
        curve, best, stop = [], params.max_iter, params.max_iter
    else:
        n = len(rounds_curve)
        curve, best = patience_curve(lambda rounds: [rounds_curve[r - 1][stop_metric] for r in rounds], n, params.patience, every,
                                     higher_is_better=higher)
        stop = len(curve) * every
        if best < n:
            for c in members:
                save_prefix(spark, f"{path}/full/class_{c}", best, f"{path}/best/class_{c}")
            members = {c: GBTClassificationModel.load(f"{path}/best/class_{c}") for c in members}
    return MultiClassModel(members, list(features), best, path, curve, stop_round=stop)


# ------------------------------------------------------------------ learning curves
def learning_curve(model_path: str, spark: SparkSession, sets: dict[str, DataFrame], features: Sequence[str],
                   label_col: str = "target", every: int = 1, last_round: int | None = None) -> DataFrame:
    """Binary model: (iteration, split, metric, value) with log loss and exact AUC per round.

    ``last_round`` (e.g. the model's ``stop_round``) ends the curve where training with
    early stopping would have ended; by default every fitted round is scored.
    """
    from .staged import binary_round_scores

    full = GBTClassificationModel.load(f"{model_path}/full")
    n = min(full.getNumTrees, last_round or full.getNumTrees)
    rounds = list(range(every, n + 1, every))
    out = None
    for name, df in sets.items():
        m = binary_round_scores(df, full, features, rounds, label_col)
        part = m.select(F.col("round").alias("iteration"), F.lit(name).alias("split"),
                        F.create_map(F.lit("auc"), F.col("auc"), F.lit("binary_logloss"), F.col("logloss"))
                        .alias("_m")).select("iteration", "split", F.explode("_m").alias("metric", "value"))
        out = part if out is None else out.unionByName(part)
    return out


def multiclass_learning_curve(model: "MultiClassModel", sets: dict[str, DataFrame], num_classes: int = 5,
                              label_col: str = "label", every: int = 1, last_round: int | None = None) -> DataFrame:
    """Five-class model: (iteration, split, metric, value) with macro accuracy and multi-class log loss.

    ``last_round`` ends the curve early (e.g. at ``model.stop_round``); by default every fitted round.
    """
    from .staged import multiclass_round_metrics

    full = {c: GBTClassificationModel.load(f"{model.path}/full/class_{c}") for c in model.members}
    n = min(m.getNumTrees for m in full.values())  # all fitted rounds
    n = min(n, last_round or n)
    rounds = list(range(every, n + 1, every))
    out = None
    for name, df in sets.items():
        m = multiclass_round_metrics(df, full, model.features, rounds, num_classes, label_col)
        part = m.select(F.col("round").alias("iteration"), F.lit(name).alias("split"),
                        F.create_map(F.lit("macro_acc"), F.col("macro_acc"), F.lit("multi_logloss"),
                                     F.col("multi_logloss")).alias("_m")).select(
            "iteration", "split", F.explode("_m").alias("metric", "value"))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ ensemble members
@dataclass
class Ensemble:
    boosted: MultiClassModel
    forest: RandomForestClassificationModel
    linear: LogisticRegressionModel
    features: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """Member probabilities side by side (chained transforms of one DataFrame) and the soft vote."""
        from ..operators.ensemble import soft_vote
        out = self.boosted.class_probabilities(df).withColumnRenamed("probabilities", "p_boosted")
        out = assemble(out, self.features)
        rf = self.forest.copy()
        rf.setProbabilityCol("_rfp").setRawPredictionCol("_rfr").setPredictionCol("_rfy")
        out = rf.transform(out).withColumn("p_forest", vector_to_array("_rfp")).drop("_rfp", "_rfr", "_rfy")
        lr = self.linear.copy()
        lr.setProbabilityCol("_lrp").setRawPredictionCol("_lrr").setPredictionCol("_lry")
        out = lr.transform(out).withColumn("p_linear", vector_to_array("_lrp")).drop("_lrp", "_lrr", "_lry",
                                                                                     FEATURES_COL)
        mean, pred = soft_vote([F.col("p_boosted"), F.col("p_forest"), F.col("p_linear")])
        return out.withColumn("p_vote", mean).withColumn("prediction", pred)


def fit_ensemble(train: DataFrame, val: DataFrame | None, features: Sequence[str], params: BoostParams,
                 label_col: str = "label", path: str | None = None, num_trees: int = 100,
                 max_iter_linear: int = 100, resume: bool = False, events: list | None = None) -> Ensemble:
    """Boosted one-vs-rest members, a random forest and a multinomial logistic regression.

    Each member is saved when its fit ends; a re-run with ``resume`` loads the members saved with the same
    parameters, features and data (``events`` collects (member, fitted)).
    """
    spark = train.sparkSession
    path = path or scratch_path(spark, "ensemble")
    boosted = fit_multiclass(train, val, features, params, label_col=label_col, weight_col=None,
                             path=f"{path}/boosted", resume=resume, events=events)
    table = training_table(train.select(F.col(label_col).cast("double").alias(label_col), *features))
    data, tr = data_id(table), training_frame(table, features).persist(StorageLevel.MEMORY_AND_DISK)
    est = RandomForestClassifier(featuresCol=FEATURES_COL, labelCol=label_col, numTrees=num_trees,
                                 maxDepth=params.max_depth, maxBins=params.max_bins, seed=params.seed,
                                 checkpointInterval=params.checkpoint_interval)
    try:
        forest = _fit_or_load(spark, est, RandomForestClassificationModel, tr, f"{path}/forest",
                              fingerprint(est, features, data), resume, events)
        est = LogisticRegression(featuresCol=FEATURES_COL, labelCol=label_col, family="multinomial",
                                 maxIter=max_iter_linear, standardization=True)
        linear = _fit_or_load(spark, est, LogisticRegressionModel, tr, f"{path}/linear",
                              fingerprint(est, features, data), resume, events)
    finally:
        tr.unpersist()
    return Ensemble(boosted, forest, linear, list(features))


# ------------------------------------------------------------------ persistence
def save_bundle(spark: SparkSession, model: BinaryModel | MultiClassModel | Ensemble, path: str,
                dictionary: DataFrame | None = None, statistics: dict[str, DataFrame] | None = None) -> None:
    """Models, feature list, best iteration and optional frozen dictionary / statistics under one folder."""
    from .joint import JointModel, bundle_meta

    boosted = model.boosted if isinstance(model, Ensemble) else model
    kind = {BinaryModel: "binary", MultiClassModel: "multiclass", JointModel: "joint", Ensemble: "ensemble"}[type(model)]
    meta = {"kind": kind, "features": model.features, "best_iteration": boosted.best_iteration}
    if isinstance(model, JointModel):
        meta = bundle_meta(model)
    if isinstance(boosted, BinaryModel):
        boosted.model.write().overwrite().save(f"{path}/model")
    else:
        meta["classes"] = boosted.classes
        for c, m in boosted.members.items():
            m.write().overwrite().save(f"{path}/class_{c}")
    if isinstance(model, Ensemble):
        model.forest.write().overwrite().save(f"{path}/forest")
        model.linear.write().overwrite().save(f"{path}/linear")
    if dictionary is not None:
        dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
    for name, table in (statistics or {}).items():
        table.write.mode("overwrite").parquet(f"{path}/statistics/{name}")
    # last, so that a bundle with its meta file is complete
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_statistics(spark: SparkSession, path: str) -> dict[str, DataFrame] | None:
    """The frozen statistics of a bundle, or None when it has none."""
    if not path_exists(spark, f"{path}/statistics/user"):
        return None
    return {n: spark.read.parquet(f"{path}/statistics/{n}") for n in ("user", "item")}


def load_rich_statistics(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """(statistics state, last actions) of an ensemble bundle, or None when it has none."""
    if not path_exists(spark, f"{path}/statistics/state"):
        return None
    return spark.read.parquet(f"{path}/statistics/state"), spark.read.parquet(f"{path}/statistics/last_actions")


def load_bundle(spark: SparkSession, path: str) -> tuple[BinaryModel | MultiClassModel | Ensemble, DataFrame | None]:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    dictionary = spark.read.parquet(f"{path}/dictionary") if path_exists(spark, f"{path}/dictionary") else None
    if meta["kind"] == "joint":
        from .joint import from_bundle

        return from_bundle(spark, path, meta), dictionary
    if meta["kind"] == "binary":
        return BinaryModel(GBTClassificationModel.load(f"{path}/model"), meta["features"],
                           meta["best_iteration"], path), dictionary
    members = {c: GBTClassificationModel.load(f"{path}/class_{c}") for c in meta["classes"]}
    boosted = MultiClassModel(members, meta["features"], meta["best_iteration"], path)
    if meta["kind"] == "multiclass":
        return boosted, dictionary
    return Ensemble(boosted, RandomForestClassificationModel.load(f"{path}/forest"),
                    LogisticRegressionModel.load(f"{path}/linear"), meta["features"]), dictionary


def scoring_bundle(spark: SparkSession, multiclass_path: str, binary_path: str) -> str:
    """The five-class bundle's path when it exists, else the binary one's (the reference's fallback)."""
    for path in (multiclass_path, binary_path):
        if path_exists(spark, f"{path}/meta"):
            return path
    raise FileNotFoundError(f"neither {multiclass_path} nor {binary_path} holds a model")


# ------------------------------------------------------------------ feature importance
def feature_importance(spark: SparkSession, model_path: str | Sequence[str], features: Sequence[str],
                       top_n: int = 20) -> DataFrame:
    """Split counts per feature over all trees of saved tree model(s) (plus total gain), top ``top_n``.

    Several paths (e.g. the one-vs-rest members of a five-class model) are counted together.
    """
    paths = [model_path] if isinstance(model_path, str) else list(model_path)
    data = spark.read.parquet(*[f"{p}/data" for p in paths])
    nodes = data.select(F.col("nodeData.split.featureIndex").alias("idx"), F.col("nodeData.gain").alias("gain"),
                        F.col("nodeData.leftChild").alias("left"))
    splits = nodes.where((F.col("idx") >= 0) & (F.col("left") >= 0))
    names = spark.createDataFrame(list(enumerate(features)), "idx int, feature string")
    counts = splits.groupBy("idx").agg(F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("gain"))
    out = names.join(F.broadcast(counts), "idx", "left").select(
        "feature", F.coalesce("splits", F.lit(0)).cast("long").alias("splits"),
        F.coalesce("gain", F.lit(0.0)).alias("gain"))
    return out.orderBy(F.desc("splits"), "feature").limit(top_n)

"""Joint softmax boosting: trees, leaf values, margins, stopping and resuming."""

import math
from dataclasses import replace

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shopflow.operators.profile import row_weights
from shopflow.plans import joint as J
from shopflow.plans import learned
from shopflow.plans import train as T
from shopflow.schema import FEATURES

PARAMS = J.JointParams(step_size=0.2, max_depth=3, max_iter=4, min_instances_per_node=5, snapshot_every=2, max_bins=64)


@pytest.fixture(scope="module")
def sets(spark):
    f = learned.splits(spark, SF_SMALL)["features"]
    return row_weights(f["train"]), f["val"]


@pytest.fixture(scope="module")
def fitted(spark, sets):
    return J.fit_joint(*sets, FEATURES, PARAMS, stop_on=("multi_logloss",))


def test_parse_tree_reads_both_kinds_of_splits():
    text = """DecisionTreeRegressionModel: uid=x, depth=2, numNodes=5, numFeatures=2
  If (feature 1 in {0.0,2.0})
   Predict: 0.25
  Else (feature 1 not in {0.0,2.0})
   If (feature 0 <= -1.5E-3)
    Predict: -1.0
   Else (feature 0 > -1.5E-3)
    Predict: 2.0
"""
    nodes = J.parse_tree(text)
    assert [(n["feature"], n["split"], n["left"], n["right"], n["leaf"]) for n in nodes] == [
        (1, [0.0, 2.0], 1, 2, -1), (-1, [], -1, -1, 0), (0, [-0.0015], 3, 4, -1), (-1, [], -1, -1, 1), (-1, [], -1, -1, 2)]
    assert J.parse_tree("x\n Predict: 1.0\n")[0]["leaf"] == 0


def test_leaf_value_is_a_soft_thresholded_newton_step():
    p = J.JointParams(step_size=0.1, lambda_l1=0.5, lambda_l2=1.0)
    assert J.leaf_value(0.4, 3.0, p) == 0 == J.leaf_value(-0.5, 3.0, p) == J.leaf_value(0.0, 0.0, p)
    assert math.isclose(J.leaf_value(2.5, 3.0, p), 0.1 * 2 / 4) and math.isclose(J.leaf_value(-2.5, 3.0, p), -0.1 * 2 / 4)


def test_first_metric_to_stall_stops():
    curve = [{"multi_logloss": 1.0 - i / 100, "multi_error": e, "macro_acc": 0.2} for i, e in enumerate([0.5, 0.4, 0.45, 0.5, 0.6])]
    assert J.stalled(curve, 3, ("multi_logloss", "multi_error")) == (2, "multi_error")
    assert J.stalled(curve, 4, ("multi_logloss", "multi_error")) == (5, None)
    assert J.stalled(curve, 4, ("multi_logloss", "multi_error", "macro_acc")) == (1, "macro_acc")


def test_saved_trees_give_the_margins_of_the_run(spark, sets, fitted):
    """The model as loaded from disk reproduces the validation loss carried by the run; so does a walk over the node table."""
    train, val = sets
    assert fitted.fitted_rounds == 4 == len(fitted.curve)
    out = fitted.class_probabilities(val.select("row_id", "label", *FEATURES)).toPandas()
    p = np.array(out["probabilities"].tolist())
    loss = -np.log(p[np.arange(len(p)), out["label"]]).mean()
    assert math.isclose(loss, fitted.curve[fitted.best_iteration - 1]["multi_logloss"], rel_tol=1e-9)
    nodes = fitted.nodes(spark).toPandas()
    x = out[FEATURES].fillna(-1).to_numpy(dtype=float)
    margins = np.tile(np.array(fitted.init), (len(x), 1))
    for (_, cls), tree in nodes.groupby(["round", "cls"]):
        tree = tree.set_index("id")
        for i, row in enumerate(x):
            at = 0
            while tree.at[at, "leaf"] < 0:
                at = tree.at[at, "left"] if row[tree.at[at, "feature"]] <= tree.at[at, "split"][0] else tree.at[at, "right"]
            margins[i, cls] += tree.at[at, "value"]
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    assert np.allclose(e / e.sum(axis=1, keepdims=True), p, atol=1e-9)


def test_validation_loss_is_below_one_vs_rest_at_equal_rounds(spark, sets, fitted):
    train, val = sets
    params = T.BoostParams(step_size=0.2, max_depth=3, min_instances_per_node=5, max_bins=64, subsampling_rate=0.7,
                           feature_fraction=0.7, max_iter=fitted.best_iteration)
    other = T.fit_multiclass(train, None, FEATURES, params)

    def loss(model, rows):
        p = F.element_at("probabilities", F.col("label") + 1)
        return model.class_probabilities(rows).select(F.avg(-F.log(p))).first()[0]

    assert loss(fitted, val) < loss(other, val)
    assert loss(fitted, train) < math.log(5)


def test_killed_run_goes_on_from_its_snapshot(spark, sets, tmp_path):
    train, val = sets
    same = ["round", "cls", "id", "feature", "split", "left", "right", "rows", F.round("value", 9)]
    path = str(tmp_path / "run")
    with pytest.raises(InterruptedError):
        J.fit_joint(train, val, FEATURES, PARAMS, stop_on=("multi_logloss",), path=path, fail_after=3)
    again = J.fit_joint(train, val, FEATURES, PARAMS, stop_on=("multi_logloss",), path=path, resume=True)
    whole = J.fit_joint(train, val, FEATURES, PARAMS, stop_on=("multi_logloss",))
    a, b = (m.nodes(spark).select(*same).toPandas().sort_values(["round", "cls", "id"]) for m in (again, whole))
    assert a.to_json() and a.reset_index(drop=True).astype(str).equals(b.reset_index(drop=True).astype(str))
    assert np.allclose([r["multi_logloss"] for r in again.curve], [r["multi_logloss"] for r in whole.curve], rtol=1e-12)
    # other settings or data do not take the snapshot over; a finished run fits nothing again
    marks = J._last_snapshot(spark, path, "other", 2, 4)
    assert marks is None
    done = J.fit_joint(train, val, FEATURES, PARAMS, stop_on=("multi_logloss",), path=path, resume=True)
    assert done.run == again.run and done.fitted_rounds == again.fitted_rounds


def test_categories_are_split_as_categories(spark, tmp_path):
    """A class that depends on the parity of a code: one nominal split says it, ordered splits of depth 1 cannot."""
    rows = spark.range(4000).select((F.col("id") % 8).cast("int").alias("code"), (F.col("id") % 3).cast("double").alias("x"),
                                    (F.col("id") % 2).cast("int").alias("label"))
    params = replace(PARAMS, max_depth=1, max_iter=2, feature_fraction=1.0, subsampling_rate=1.0)
    plain = J.fit_joint(rows, None, ["code", "x"], params, weight_col=None, num_classes=2)
    cats = J.fit_joint(rows, None, ["code", "x"], params, weight_col=None, num_classes=2, categories={"code": 8})
    correct = [m.transform(rows).where("prediction = label").count() for m in (plain, cats)]
    assert correct[1] == 4000 > correct[0]
    assert {tuple(sorted(r.split)) for r in cats.nodes(spark).where("leaf < 0").collect()} <= {(0., 2., 4., 6.), (1., 3., 5., 7.)}
    # an unseen code is a category of its own; bundles keep the categories
    T.save_bundle(spark, cats, str(tmp_path / "b"))
    loaded, _ = T.load_bundle(spark, str(tmp_path / "b"))
    odd = spark.createDataFrame([(-1, 0.0, "k"), (99, 1.0, "l"), (3, 0.0, "m")], "code int, x double, note string")
    a, b = (m.transform(odd).orderBy("note").collect() for m in (cats, loaded))
    assert a == b and [r.code for r in a] == [-1, 99, 3] and a[2].prediction == 1


def test_wide_categories_stay_numbers(spark):
    rows = spark.range(500).select(F.col("id").cast("int").alias("code"), (F.col("id") % 2).cast("int").alias("label"))
    m = J.fit_joint(rows, None, ["code"], replace(PARAMS, max_iter=1), weight_col=None, num_classes=2, categories={"code": 500})
    assert m.categories == {}

"""Training at size: few large tasks, no round fitted twice, exact AUC curves without a row per (row, round)."""

from dataclasses import replace

import pytest
from conftest import SF_SMALL
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from shopflow.plans import learned, staged
from shopflow.plans import train as T
from shopflow.schema import FEATURES

PARAMS = T.BoostParams(step_size=0.1, max_depth=3, min_instances_per_node=5, max_iter=8, patience=2, max_bins=64)


@pytest.fixture(scope="module")
def sets(spark):
    return learned.splits(spark, SF_SMALL)["features"]


def body(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def test_training_tasks_are_large():
    assert T.training_tasks(25_200_000) <= 60  # 1260 tasks a level before
    assert [T.training_tasks(n) for n in (0, 1, 20_000, 20_001, 10**6)] == [1, 1, 1, 2, 12]
    assert T.training_tasks(10**10) == 20_000  # no cap


def test_training_frame_is_narrow(spark, sets):
    table = sets["train"].select("target", *FEATURES)
    frame = T.training_frame(table, FEATURES)
    assert frame.columns == ["target", T.FEATURES_COL] and frame.count() == table.count()


def test_prefix_of_a_saved_model(spark, sets):
    whole = T.fit_binary(sets["train"], None, FEATURES, PARAMS)
    T.save_prefix(spark, f"{whole.path}/full", 3, f"{whole.path}/cut")
    cut = GBTClassificationModel.load(f"{whole.path}/cut")
    short = T.fit_binary(sets["train"], None, FEATURES, replace(PARAMS, max_iter=3)).model
    assert cut.getNumTrees == cut.getMaxIter() == 3 and body(cut) == body(short) == body(whole.model)[:3]
    assert list(cut.treeWeights) == list(short.treeWeights) and cut.numFeatures == short.numFeatures
    test = T.assemble(sets["test"], FEATURES)
    a, b = (m.transform(test).select("row_id", F.col("probability").cast("string").alias("p")) for m in (cut, short))
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("classes", [2, 5])
def test_no_round_is_fitted_twice(spark, sets, monkeypatch, classes):
    fits = []
    make = T.BoostParams.estimator
    monkeypatch.setattr(T.BoostParams, "estimator", lambda self, *a: fits.append(self.max_iter) or make(self, *a))
    # the curve is best at round 3: a run that kept it was fitted again up to there before
    monkeypatch.setattr(T, "patience_curve", lambda score, n, *a, **k: ([0.5, 0.6, 0.7, 0.6, 0.6], 3))
    if classes == 2:
        m = T.fit_binary(sets["train"], sets["val"], FEATURES, PARAMS)
        assert fits == [4, 8] or fits == [8]
        assert m.best_iteration == m.model.getNumTrees == 3 and m.fitted_rounds == fits[-1]
    else:
        m = T.fit_multiclass(sets["train"], sets["val"], FEATURES, PARAMS, weight_col=None)
        assert fits == [8] * 5 and m.best_iteration == 3 and all(x.getNumTrees == 3 for x in m.members.values())
        assert all(body(m.members[c]) == body(GBTClassificationModel.load(f"{m.path}/full/class_{c}"))[:3] for c in m.classes)


def test_first_doubling_that_reaches_the_end_is_left_out():
    def fits(**kw):
        seen = []
        T._rounds_until_stop(T.BoostParams(**kw), lambda r: seen.append(r) or r, lambda m, n: ([0.0] * n, n))
        return seen

    assert fits(max_iter=30, patience=10) == [30]  # 20, then 30 anew, before
    assert fits(max_iter=100, patience=20) == [40, 80, 100] and fits(max_iter=5, patience=10) == [5]


@pytest.mark.parametrize("size", [7, 60, 10**6])
def test_round_scores_equal_counts_of_all_margins(spark, sets, monkeypatch, size):
    m = T.fit_binary(sets["train"], None, FEATURES, PARAMS).model
    val = sets["val"].unionByName(sets["val"].limit(20))  # equal rows
    rounds = [1, 2, 5, 8]
    want = {r["round"]: r for r in staged.binary_round_metrics(
        staged.staged_margins(val, {0: m}, FEATURES, rounds, ["target"])).collect()}
    monkeypatch.setattr(staged, "ROWS_PER_BUCKET", size)
    got = {r["round"]: r for r in staged.binary_round_scores(val, m, FEATURES, rounds).collect()}
    assert set(got) == set(want) == set(rounds)
    for r in rounds:
        assert abs(got[r].auc - want[r].auc) < 1e-12 and abs(got[r].logloss - want[r].logloss) < 1e-12
    # one label only: no AUC, as before; a row without a label counts on neither side
    ones = staged.binary_round_scores(val.where("target = 1"), m, FEATURES, [2]).collect()
    assert [r.auc for r in ones] == [None]
    blank = val.unionByName(val.limit(9).withColumn("target", F.lit(None).cast("int")))
    again = {r["round"]: r for r in staged.binary_round_scores(blank, m, FEATURES, rounds).collect()}
    assert all(abs(again[r].auc - got[r].auc) < 1e-12 for r in rounds)


def test_features_are_written_once(spark, sets):
    for df in sets.values():
        assert df.inputFiles() and all("training-table" in f for f in df.inputFiles())

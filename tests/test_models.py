"""Invariants of learned outputs: probabilities, prefix truncation, persistence, streaming twin."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shopflow.plans import learned
from shopflow.plans import train as T
from shopflow.schema import FEATURES


def test_best_prefix_patience():
    curve = [5, 4, 3, 3.5, 3.2, 3.1, 3.05, 2.9, 4, 4, 4]
    assert T.best_prefix(curve, patience=3) == 3  # stops at round 6 with the best at round 3
    assert T.best_prefix(curve, patience=10) == 8
    assert T.best_prefix([0.5, 0.6, 0.55], patience=5, higher_is_better=True) == 2


def test_patience_curve_scores_in_chunks_and_stops(monkeypatch):
    full = [5 - 0.01 * i for i in range(40)] + [5.0] * 460  # best at round 40, stop at round 70 (patience 30)
    asked: list[list[int]] = []

    def score(rounds):
        asked.append(list(rounds))
        return [full[r - 1] for r in rounds]

    for chunk in (1, 25, 100, 1000):
        asked.clear()
        monkeypatch.setattr(T, "EVAL_CHUNK_ROUNDS", chunk)
        curve, best = T.patience_curve(score, len(full), patience=30)
        assert best == T.best_prefix(full, 30) == 40
        assert curve == full[:70]  # up to the round where training stops, whatever the chunk size
        step = max(30, chunk)
        assert all(len(a) <= step for a in asked) and max(max(a) for a in asked) < 70 + step
    # every 5th round: patience counts scored rounds, trees kept is a multiple of 5
    monkeypatch.setattr(T, "EVAL_CHUNK_ROUNDS", 100)
    curve, best = T.patience_curve(score, len(full), patience=30, eval_every=5)
    assert best == 40 and curve == [full[r - 1] for r in range(5, 71, 5)]


@pytest.fixture(scope="module")
def small(spark):
    f = learned.splits(spark, SF_SMALL)["features"]
    params = T.BoostParams(step_size=0.1, max_depth=3, min_instances_per_node=5, max_iter=8, patience=100,
                           max_bins=64)
    return f, params


def _full(m):
    from pyspark.ml.classification import GBTClassificationModel
    return GBTClassificationModel.load(f"{m.path}/full")


def _rounds(params, n):
    from dataclasses import replace
    return replace(params, max_iter=n)


def test_shorter_run_is_prefix_of_longer(spark, small):
    f, params = small
    a = T.fit_binary(f["train"], None, FEATURES, _rounds(params, 3)).model
    b = T.fit_binary(f["train"], None, FEATURES, params).model
    assert a.getNumTrees == 3 and b.getNumTrees == 8
    # the uid in the first line differs from run to run; the nodes do not
    body = [t.toDebugString.split("\n", 1)[1] for t in b.trees]
    assert [t.toDebugString.split("\n", 1)[1] for t in a.trees] == body[:3]


def test_staged_margins_equal_mllib(spark, small):
    from pyspark.ml.functions import vector_to_array

    from shopflow.plans.staged import staged_margins

    f, params = small
    m = T.fit_binary(f["train"], None, FEATURES, params)
    cut = T.fit_binary(f["train"], None, FEATURES, _rounds(params, 3)).model
    staged = staged_margins(f["test"], {0: m.model}, FEATURES, [3, 8], ["row_id"]).toPandas()
    for rounds, model in ((8, m.model), (3, cut)):
        raw = model.transform(T.assemble(f["test"], FEATURES)).select(
            "row_id", vector_to_array("rawPrediction")[1].alias("r")).toPandas()
        got = staged[staged["round"] == rounds].assign(g=lambda d: d["margins"].map(lambda a: a[0]))
        j = raw.merge(got, on="row_id")
        assert len(j) == len(raw) and (j["r"] - j["g"]).abs().max() < 1e-9


def test_binary_truncation_and_roundtrip(spark, small):
    f, params = small
    m = T.fit_binary(f["train"], f["val"], FEATURES, params, stop_metric="logloss")
    out = m.transform(f["test"]).select("probability").toPandas()["probability"]
    assert out.between(0, 1).all()
    # losses per round are MLlib's own (which are twice the usual ones)
    va = T.assemble(f["val"].withColumn("target", F.col("target").cast("double")), FEATURES)
    assert max(abs(a / 2 - b) for a, b in zip(_full(m).evaluateEachIteration(va), m.curve)) < 1e-9
    assert m.model.getNumTrees == m.best_iteration
    T.save_bundle(spark, m, f"{m.path}/bundle")
    loaded, _ = T.load_bundle(spark, f"{m.path}/bundle")
    a = m.transform(f["test"]).select("row_id", F.col("probability").alias("a"))
    b = loaded.transform(f["test"]).select("row_id", F.col("probability").alias("b"))
    assert a.join(b, "row_id").where(F.col("a") != F.col("b")).count() == 0


def test_round_metrics_equal_brute_force(spark, small):
    import numpy as np

    from shopflow.plans.staged import binary_round_metrics, multiclass_round_metrics, staged_margins

    f, params = small
    m = T.fit_binary(f["train"], None, FEATURES, params)
    rounds = list(range(1, 9))
    staged = staged_margins(f["val"], {0: m.model}, FEATURES, rounds, ["target"])
    got = binary_round_metrics(staged, "target").toPandas().set_index("round").sort_index()
    va = T.assemble(f["val"].withColumn("target", F.col("target").cast("double")), FEATURES)
    assert np.allclose(got["logloss"].to_numpy(), [x / 2 for x in m.model.evaluateEachIteration(va)], atol=1e-9)
    # AUC per round: all (positive, negative) pairs, ties count one half
    pdf = staged.toPandas()
    for r in rounds:
        d = pdf[pdf["round"] == r]
        s = d["margins"].map(lambda a: a[0]).to_numpy()
        y = d["target"].to_numpy()
        pos, neg = s[y == 1][:, None], s[y != 1][None, :]
        want = ((pos > neg).sum() + 0.5 * (pos == neg).sum()) / (pos.size * neg.size)
        assert abs(got.loc[r, "auc"] - want) < 1e-12
    # five classes from two different models; both metrics again in pandas
    other = T.fit_binary(f["train"].withColumn("target", 1 - F.col("target")), None, FEATURES, params).model
    models = {c: (other if c == 3 else m.model) for c in range(5)}
    got5 = multiclass_round_metrics(f["val"], models, FEATURES, rounds, 5, "label").toPandas().set_index("round").sort_index()
    p5 = staged_margins(f["val"], models, FEATURES, rounds, ["label"]).toPandas()
    for r in rounds:
        d = p5[p5["round"] == r]
        pr = 1 / (1 + np.exp(-2 * np.stack(d["margins"].to_numpy())))
        pr = pr / pr.sum(axis=1, keepdims=True)
        lab = d["label"].to_numpy()
        pred = pr.argmax(axis=1)
        recalls = [(pred[lab == c] == c).mean() for c in range(5) if (lab == c).any()]
        assert abs(got5.loc[r, "macro_acc"] - sum(recalls) / 5) < 1e-12
        ll = -np.log(np.maximum(pr[np.arange(len(lab)), lab], 1e-15)).mean()
        assert abs(got5.loc[r, "multi_logloss"] - ll) < 1e-9


def test_rounds_double_until_the_rule_stops():
    params = T.BoostParams(max_iter=1000, patience=8)
    curve = [1 / (1 + i) for i in range(30)] + [0.5] * 970  # best round 30, stop at 38
    fits = []

    def curve_of(model, n):
        c, best = T.patience_curve(lambda rs: [curve[r - 1] for r in rs], n, params.patience)
        return c, best

    model, n, seen, best = T._rounds_until_stop(params, lambda r: fits.append(r) or r, curve_of)
    assert fits == [16, 32, 64] and n == 64 and best == 30 and len(seen) == 38


def test_resume_loads_only_the_same_fit(spark, small):
    from shopflow.session import scratch_path

    f, params = small
    path, short = scratch_path(spark, "resume-test"), _rounds(params, 2)

    def run(p, features, **kw):
        events = []
        m = T.fit_multiclass(f["train"], None, features, p, weight_col=None, path=path, resume=True, events=events, **kw)
        return m, dict(events)

    _, first = run(short, FEATURES)
    assert all(first.values()) and len(first) == 5
    _, again = run(short, FEATURES)
    assert not any(again.values())
    fewer, changed = run(_rounds(params, 3), FEATURES[:20])
    assert all(changed.values()) and fewer.features == FEATURES[:20] and fewer.members[0].getNumTrees == 3
    # a member saved without its marker (a crash in the middle) is fitted again
    mark = T.fingerprint(short.estimator("_y"), FEATURES, "data")
    T.save_member(spark, fewer.members[0], f"{path}/x", mark)
    cls = type(fewer.members[0])
    assert T.saved_member(spark, cls, f"{path}/x", mark) is not None
    assert T.saved_member(spark, cls, f"{path}/x", mark + " ") is None
    assert T.saved_member(spark, cls, f"{path}/full/none", mark) is None


def test_learning_curve_ends_at_stop_round(spark, small):
    from dataclasses import replace

    f, params = small
    m = T.fit_binary(f["train"], f["val"], FEATURES, replace(params, patience=2))
    assert m.fitted_rounds <= 8 and m.stop_round == len(m.curve) and m.best_iteration <= m.stop_round <= 8
    lc = T.learning_curve(m.path, spark, {"valid": f["val"]}, FEATURES, last_round=m.stop_round).toPandas()
    assert sorted(set(lc["iteration"])) == list(range(1, m.stop_round + 1))
    auc = lc[lc["metric"] == "auc"].sort_values("iteration")["value"].to_numpy()
    assert abs(auc - m.curve).max() < 1e-12  # the curve the patience rule saw


def test_multiclass_probabilities_sum_to_one(spark, small):
    from shopflow.operators.profile import row_weights

    f, params = small
    m = T.fit_multiclass(row_weights(f["train"]), f["val"], FEATURES, params, num_classes=5)
    out = m.transform(f["val"]).select(F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b).alias("s"),
                                       "prediction").toPandas()
    assert ((out["s"] - 1).abs() < 1e-9).all()
    assert out["prediction"].between(0, 4).all()


def test_stream_twin_stops_and_resumes(spark, small):
    """Records scored in two runs on one checkpoint: none lost, none repeated, and equal to the batch."""
    from shopflow.operators.encode import fit_sorted_dictionary
    from shopflow.plans.features import base_statistics
    from shopflow.schema import CATEGORICALS
    from shopflow.session import scratch_path
    from shopflow.sources import fixtures as FX
    from shopflow.streaming.score_stream import run_request_stream

    f, params = small
    raw = learned.splits(spark, SF_SMALL)["raw"]
    m = T.fit_binary(f["train"], None, FEATURES, _rounds(params, 2))
    bundle = scratch_path(spark, "stream-bundle")
    T.save_bundle(spark, m, bundle, fit_sorted_dictionary(raw["train"], CATEGORICALS), base_statistics(raw["train"]))

    def score(requests):
        return learned.score_requests(spark, requests, raw["val"], f["val"], f"{bundle}/none", bundle,
                                      now=learned.REQUEST_CLOCK)

    requests = FX.requests(spark, SF_SMALL)
    inbox, sink, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    requests.where("row_id % 2 = 0").repartition(3).write.mode("append").parquet(inbox)
    first = run_request_stream(spark, inbox, requests.schema, sink, ckpt, score, max_files=1).count()
    assert first == requests.where("row_id % 2 = 0").count()
    requests.where("row_id % 2 = 1").write.mode("append").parquet(inbox)
    stream = run_request_stream(spark, inbox, requests.schema, sink, ckpt, score)
    batch = score(requests)
    assert batch.count() == stream.count() == requests.count()
    assert batch.exceptAll(stream.select(*batch.columns)).count() == 0
    # a known user's own statistics are used, not the sample's means
    assert score(requests).select("p1").distinct().count() > 2

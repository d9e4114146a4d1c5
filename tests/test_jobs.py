"""Script-shaped flow: CSV log -> split -> train -> evaluate -> predict."""

from conftest import SF_SMALL
from shopflow.plans import jobs
from shopflow.plans import train as T
from shopflow.schema import BEHAVIOR_COLUMNS
from shopflow.session import scratch_path
from shopflow.sources import fixtures as FX
from shopflow.sources import io


def test_script_flow(spark):
    log = scratch_path(spark, "job-log")
    io.write_table(FX.behavior(spark, SF_SMALL).select(*[c for c in BEHAVIOR_COLUMNS if c != "row_id"]), log,
                   fmt="csv")
    data, model = scratch_path(spark, "job-data"), scratch_path(spark, "job-model")
    report = {r.split: r for r in jobs.split_job(spark, log, data).collect()}
    total = sum(r.rows for r in report.values())
    assert set(report) == {"train", "test", "val"} and report["train"].rows == int(0.7 * total)
    params = T.BoostParams(step_size=0.1, max_depth=3, min_instances_per_node=5, max_iter=6, patience=3, max_bins=32)
    metrics = {r.metric: r.value for r in jobs.train_binary_job(spark, data, model, params).collect()}
    assert {"accuracy", "precision", "recall", "f1", "auc", "tn", "fp", "fn", "tp"} <= set(metrics)
    assert metrics["tn"] + metrics["fp"] + metrics["fn"] + metrics["tp"] == report["test"].rows
    ev = {r.metric: r.value for r in jobs.evaluate_job(spark, f"{model}/bundle", log).collect()}
    assert ev["tn"] + ev["fp"] + ev["fn"] + ev["tp"] == total
    out = scratch_path(spark, "job-predictions")
    summary = jobs.predict_job(spark, f"{model}/bundle", log, out).first()
    assert summary.rows == total and 0 <= summary.positive_share <= 1
    out2 = scratch_path(spark, "job-predictions-frozen")
    frozen = jobs.predict_job(spark, f"{model}/bundle", log, out2, training_statistics=True).first()
    assert frozen.rows == total


def test_split_table_written_once_per_session(spark):
    from shopflow import registry

    path = registry._split_table(spark, SF_SMALL)
    assert registry._split_table(spark, SF_SMALL + "/") == path  # same session and source: same table
    stored = io.read_splits(spark, path).select("row_id", "split")
    fresh = registry._split(spark, SF_SMALL).select("row_id", "split")
    assert stored.count() == fresh.count() and stored.exceptAll(fresh).count() == 0
    assert {r.split for r in io.read_split(spark, path, "val").select("split").distinct().collect()} == {"val"}


PARAMS = T.BoostParams(step_size=0.1, max_depth=3, min_instances_per_node=5, max_iter=3, patience=2, max_bins=32)


def test_csv_splits_can_be_trained_on(spark):
    log, data, model = (scratch_path(spark, n) for n in ("csv-log", "csv-data", "csv-model"))
    io.write_table(FX.behavior(spark, SF_SMALL), log, fmt="csv")
    report = {r.split: r.rows for r in jobs.split_job(spark, log, data, out_fmt="csv").collect()}
    metrics = {r.metric: r.value for r in jobs.train_binary_job(spark, data, model, PARAMS, fmt="csv").collect()}
    assert metrics["tn"] + metrics["fp"] + metrics["fn"] + metrics["tp"] == report["test"]


def test_strict_time_fails_and_lenient_time_passes(spark):
    import pytest

    log = scratch_path(spark, "bad-time-log")
    io.write_table(FX.behavior_text(spark, SF_SMALL), log, fmt="csv")
    data, model = scratch_path(spark, "bt-data"), scratch_path(spark, "bt-model")
    jobs.split_job(spark, log, data)
    jobs.train_binary_job(spark, data, model, PARAMS)
    with pytest.raises(Exception, match="CANNOT_PARSE|cannot be parsed|not-a-time"):
        jobs.evaluate_job(spark, f"{model}/bundle", log).collect()
    assert jobs.evaluate_job(spark, f"{model}/bundle", log, mode="coerce").count() == 9


def test_ensemble_job_and_bundle(spark):
    log, data, model = (scratch_path(spark, n) for n in ("ens-log", "ens-data", "ens-model"))
    io.write_table(FX.behavior(spark, SF_SMALL), log, fmt="csv")
    jobs.split_job(spark, log, data)
    out = {r.model: r.accuracy for r in jobs.train_ensemble_job(spark, data, model, PARAMS, num_trees=3,
                                                               max_iter_linear=5).collect()}
    assert set(out) == {"boosted", "forest", "linear", "voting"} and all(0 <= v <= 1 for v in out.values())
    loaded, _ = T.load_bundle(spark, f"{model}/bundle")
    assert isinstance(loaded, T.Ensemble) and loaded.forest.getNumTrees == 3


def test_csv_is_read_by_name(spark, tmp_path):
    import pytest

    d = tmp_path / "log"
    d.mkdir()
    (d / "a.csv").write_text("brand_code, sex,extra,user_log_acct,action_time,shop_score\n"
                             "b1,1.0,x,u1,2024-01-02 03:04:05,2.5\n,2,y,u2,bad,\nb3,x,z,u3,,1\n")
    df = io.load_behavior(spark, str(d))
    assert df.columns == BEHAVIOR_COLUMNS
    rows = df.orderBy("row_id").collect()
    assert [r.row_id for r in rows] == [0, 1, 2] and [r.brand_code for r in rows] == ["b1", None, "b3"]
    assert [r.sex for r in rows] == [1, 2, None] and rows[0].shop_score == 2.5 and rows[0].user_log_acct == "u1"
    assert rows[0].action_time.hour == 3 and rows[1].action_time is None and rows[0].item_sku_id is None
    assert {r.column: r.bad for r in io.bad_cells(spark, str(d)).collect()} == {"sex": 1, "action_time": 1, "shop_score": 0}
    with pytest.raises(Exception, match="cannot read"):
        io.load_behavior(spark, str(d), strict=True).collect()


def test_file_order_ids_do_not_depend_on_packing(spark):
    log = scratch_path(spark, "order-log")
    FX.behavior(spark, SF_SMALL).drop("row_id").repartition(4).write.option("header", "true").csv(log)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    ids = []
    for size in ("128m", "8k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = io.load_behavior(spark, log).collect()
        ids.append({tuple(r[1:]): r.row_id for r in rows})
        assert sorted(r.row_id for r in rows) == list(range(len(rows)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ids[0] == ids[1]

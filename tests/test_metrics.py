import itertools
import random

from shopflow.operators import metrics


def test_confusion_and_zero_division(spark):
    # class 2 never predicted; class 3 predicted but absent from labels
    rows = [(0, 0), (0, 1), (1, 1), (2, 1), (1, 3)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    cm = {(r.label, r.prediction): r["count"] for r in metrics.confusion_matrix(df).collect()}
    assert len(cm) == 16 and sum(cm.values()) == 5 and cm[(2, 2)] == 0 and cm[(0, 1)] == 1
    pc = {r["class"]: r for r in metrics.per_class_metrics(df).collect()}
    assert pc[2].precision == 0.0 and pc[2].recall == 0.0 and pc[2].f1 == 0.0
    assert pc[3].support == 0 and pc[3].recall == 0.0
    assert abs(pc[1].precision - 1 / 3) < 1e-12 and abs(pc[1].recall - 0.5) < 1e-12
    m = metrics.macro_metrics(df).first()
    assert abs(m.macro_recall - (0.5 + 0.5 + 0 + 0) / 4) < 1e-12


def test_single_class_binary(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "target int, prediction int")
    r = metrics.binary_metrics(df).first()
    assert (r.accuracy, r.precision, r.recall, r.f1) == (1.0, 0.0, 0.0, 0.0)
    c = metrics.confusion_binary(df).first()
    assert (c.tn, c.fp, c.fn, c.tp) == (2, 0, 0, 0)


def test_auc_matches_pairwise_count(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 1), rnd.randint(0, 20) / 20) for _ in range(300)]
    df = spark.createDataFrame(rows, "target int, probability double")
    pos = [p for t, p in rows if t == 1]
    neg = [p for t, p in rows if t == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    assert abs(metrics.roc_auc(df).first().auc - wins / (len(pos) * len(neg))) < 1e-12


def test_macro_accuracy_absent_class_counts_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    assert abs(metrics.macro_accuracy(df, 3).first().macro_acc - 1 / 3) < 1e-12

"""Toxicity and quality models: held-out accuracy, the parts against brute force, and edge cases."""

import zlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopflow.llm import quality, queries, toxicity
from shopflow.llm.common import documents, labels

from test_llm_common import edge_docs, empty_docs

SF = "/root/testdata/sf0.01"


def _maximal_reference(scores):
    """Maximal segments by recursion on the best segment (the definition)."""
    if not scores or max(scores) <= 0:
        return []
    best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
    s, _, _, i, j = best
    return _maximal_reference(scores[:i]) + [(i, j, s)] + [(a + j, b + j, t) for a, b, t in _maximal_reference(scores[j:])]


def test_maximal_segments_equal_definition():
    rnd = random.Random(2)
    for _ in range(300):
        # powers of two: sums are exact and no two different segments tie
        scores = [rnd.choice([-1, 1]) * 2.0 ** k for k in rnd.sample(range(12), rnd.randint(0, 9))]
        assert toxicity.maximal_segments(scores) == _maximal_reference(scores)


def test_runs():
    starts, sums = toxicity.runs(np.array([-1.0, -2, 3, 4, -1, 5]))
    assert starts.tolist() == [0, 2, 4, 5] and sums.tolist() == [-3, 7, -1, 5]


def test_decay_rate_solves_its_equation():
    scores, counts = np.array([-1.0, 2.0, 5.0]), np.array([100, 5, 1])
    rate = toxicity.decay_rate(scores, counts)
    assert abs((counts / counts.sum() * np.exp(rate * scores)).sum() - 1) < 1e-6 and rate > 0


def test_token_scores_lean_on_prefixes():
    scores = toxicity.token_scores([("rude~", 50, 50), ("rudel~", 30, 30), ("rudely", 3, 3), ("calm~", 60, 2), ("calmly", 4, 1)], 0.1)
    assert scores["rude~"] > scores["calm~"] and scores["rudely"] > 2 and scores["calmly"] < 1
    model = toxicity.ToxicityModel(scores, -1.0, 1.0, 1.0, (0, 0, 0))
    assert model.of_word("rudelike") == scores["rudel~"] and model.of_word("other") == -1.0


@pytest.fixture(scope="module")
def tox(spark):
    return toxicity.fit(documents(spark, SF), labels(spark, SF))


@pytest.fixture(scope="module")
def qual(spark):
    return quality.fit(documents(spark, SF), labels(spark, SF))


def _held_out(spark, rows, label):
    y = labels(spark, SF).select("doc_id", F.col(label).alias("y"))
    pdf = rows.where("held_out").join(y, "doc_id").toPandas()
    return pdf["y"].to_numpy(), pdf["score"].to_numpy(), pdf["predicted"].to_numpy()


def _auc(y, s):
    pos, neg = s[y == 1][:, None], s[y == 0][None, :]
    return ((pos > neg).sum() + 0.5 * (pos == neg).sum()) / (pos.size * neg.size)


def test_toxicity_held_out(spark):
    rows = queries.op3_toxicity(spark, SF)
    assert rows.count() == documents(spark, SF).count()
    y, s, p = _held_out(spark, rows, "toxic")
    assert _auc(y, s) > 0.85 and p[y == 0].mean() < 0.1 and ((s >= 0) & (s <= 1)).all()
    assert ((s >= 0.7) == (p == 1)).all()


def test_quality_held_out(spark):
    rows = queries.op4_quality(spark, SF)
    assert rows.count() == documents(spark, SF).count()
    y, s, p = _held_out(spark, rows, "quality")
    assert _auc(y, s) > 0.9 and p[y == 1].mean() > 0.9 and p[y == 0].mean() < 0.3


def test_held_out_labels_are_not_used(spark, tox, qual):
    flipped = labels(spark, SF).withColumn("f3", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))) \
        .withColumn("f4", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))) \
        .withColumn("toxic", F.when(F.col("f3") == 1, 1 - F.col("toxic")).otherwise(F.col("toxic"))) \
        .withColumn("quality", F.when(F.col("f4") == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert toxicity.fit(documents(spark, SF), flipped) == tox
    assert quality.fit(documents(spark, SF), flipped) == qual


def test_scores_ignore_other_columns(spark, tox, qual):
    docs = documents(spark, SF).limit(50)
    changed = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn(
        "doc_id", -F.col("doc_id"))
    for scored in (lambda d: toxicity.with_segments(d, tox).select("doc_id", F.col("toxicity.score").alias("s")),
                   lambda d: qual.with_score(d).select("doc_id", F.col("score").alias("s"))):
        a = {r.doc_id: r.s for r in scored(docs).collect()}
        assert a == {-r.doc_id: r.s for r in scored(changed).collect()}


def test_toxicity_edges(spark, tox):
    docs = edge_docs(spark)
    out = toxicity.with_segments(docs, tox).collect()
    assert len(out) == docs.count() and [c for c in toxicity.with_segments(docs, tox).columns[:-1]] == docs.columns
    assert all(0 <= r.toxicity.score <= 1 for r in out)
    base = {r.toxicity.score for r in out if not (r.text or "").strip()}
    assert len(base) == 1
    assert toxicity.with_segments(empty_docs(spark), tox).count() == 0


def test_segments_mark_the_passage(tox):
    words = [w for w, s in sorted(tox.scores.items(), key=lambda k: -k[1]) if not w.endswith("~")][:4]
    text = " ".join(["qqxz"] * 30 + words + ["qqxz"] * 30)
    segments, n = tox.segments(text)
    best = max(segments, key=lambda s: s[2])
    assert n == 64 and best[0] >= 30 and best[1] <= 34 and best[3] < toxicity.MAX_EXPECTED
    assert tox.probability(segments) > tox.probability([])


def test_quality_edges(spark, qual):
    docs = edge_docs(spark)
    out = qual.with_score(docs.drop("score")).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert qual.with_score(empty_docs(spark), into="q").count() == 0


def test_models_of_few_labels(spark):
    docs = edge_docs(spark)
    one = spark.createDataFrame([(i, 1, 1) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    none = one.limit(0)
    mixed = spark.createDataFrame([(1, None, 5), (None, 1, 1), (999, 0, 0)], "doc_id long, quality int, toxic int")
    for lab in (one, none, mixed):
        model = toxicity.fit(docs, lab)
        scores = {r.toxicity.score for r in toxicity.with_segments(docs, model).collect()}
        assert len(scores) == 1 and all(0 <= s <= 1 for s in scores)
        rules = quality.fit(docs, lab)
        assert rules.rules == () and len({r.s for r in rules.with_score(docs, into="s").collect()}) == 1


def test_rules_hold_where_their_path_leads(spark, qual):
    """A rule's column is true exactly for rows whose statistics meet its conditions."""
    docs = documents(spark, SF).limit(100)
    stats = quality.statistics(F.coalesce("text", F.lit("")))
    table = docs.select(*[c.alias(k) for k, c in stats.items()])
    values = {k: F.col(k) for k in stats}
    pdf = table.select("*", *[r.holds(values).alias(f"r{i}") for i, r in enumerate(qual.rules)]).toPandas()
    total = np.full(len(pdf), qual.bias)
    for i, rule in enumerate(qual.rules):
        want = np.ones(len(pdf), dtype=bool)
        for name, below, threshold in rule.conditions:
            want &= (pdf[name] <= threshold) if below else (pdf[name] > threshold)
        assert (pdf[f"r{i}"].to_numpy() == want).all()
        total += want * rule.weight
    got = table.select(qual.score_column(values).alias("s")).toPandas()["s"]
    assert np.allclose(got, 1 / (1 + np.exp(-total)))


def test_tree_rules_cover_every_path():
    text = "\n".join([
        "GBTClassificationModel", "  Tree 0 (weight 1.0):", "    If (feature 0 <= 0.5)", "     If (feature 1 <= -1.0E-4)",
        "      Predict: 1.0", "     Else (feature 1 > -1.0E-4)", "      Predict: 0.0", "    Else (feature 0 > 0.5)",
        "     Predict: 2.0", "  Tree 1 (weight 0.1):", "    If (feature 0 <= 0.7)", "     If (feature 0 <= 0.2)",
        "      Predict: 1.0", "     Else (feature 0 > 0.2)", "      Predict: 0.0", "    Else (feature 0 > 0.7)", "     Predict: 2.0"])
    got = {r.conditions for r in quality.tree_rules(text, ["a", "b"])}
    low = ("a", True, 0.5)
    assert got == {(low,), (low, ("b", True, -1e-4)), (low, ("b", False, -1e-4)), (("a", False, 0.5),), (("a", True, 0.7),),
                   (("a", True, 0.2),), (("a", False, 0.2), ("a", True, 0.7)), (("a", False, 0.7),)}
    assert list(itertools.chain(got))


def test_labels_without_a_document_take_no_place(spark):
    from shopflow.llm import quality

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(60)] + [(None, "x")], "doc_id long, text string")
    rows = [(i, i % 2) for i in range(60)] + [(10 ** 6 + i, 1) for i in range(2000)] + [(None, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    usable = {i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2}
    every = quality.labelled(docs, labels, "quality", 4, 2, 100).collect()
    assert {r.text for r in every} == {f"text {i}" for i in usable} and len(every) == len(usable)
    assert quality.labelled(docs, labels, "quality", 4, 2, 10).count() == 10

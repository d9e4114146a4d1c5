"""Randomised properties: exact split sizes for any strata and ratios; encoding is a bijection."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopflow.operators.encode import label_encode
from shopflow.operators.split import stratified_split


def _largest_remainder(counts, draws):
    total = sum(counts)
    cont = [c / total * draws for c in counts]
    base = [math.floor(x) for x in cont]
    extra = draws - sum(base)
    order = sorted(range(len(counts)), key=lambda i: (-(cont[i] - base[i]), i))
    for i in order[:extra]:
        base[i] += 1
    return base


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=40), min_size=1, max_size=4),
       st.sampled_from([(0.7, 0.15, 0.15), (0.8, 0.1, 0.1), (0.6, 0.3, 0.1)]))
def test_split_sizes(spark, strata, ratios):
    rows = [(i, s) for s, n in enumerate(strata) for i in range(sum(strata[:s]), sum(strata[:s]) + n)]
    df = spark.createDataFrame(rows, "row_id long, target int")
    out = stratified_split(df, ratios).groupBy("target", "split").count().collect()
    got = {(r.target, r.split): r["count"] for r in out}
    n_train = _largest_remainder(strata, math.floor(ratios[0] * sum(strata)))
    rest = [a - b for a, b in zip(strata, n_train)]
    n_test = _largest_remainder(rest, math.floor(ratios[1] / (ratios[1] + ratios[2]) * sum(rest))) if sum(rest) else \
        [0] * len(strata)
    for s in range(len(strata)):
        assert got.get((s, "train"), 0) == n_train[s]
        assert got.get((s, "test"), 0) == n_test[s]
        assert got.get((s, "val"), 0) == strata[s] - n_train[s] - n_test[s]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab9-_Z", min_size=0, max_size=4), min_size=1, max_size=30))
def test_encoding_is_a_bijection(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "row_id long, v string")
    enc = label_encode(df, ["v"]).join(df.withColumnRenamed("v", "raw"), "row_id")
    pairs = enc.select("raw", "v").distinct().collect()
    assert len({p.raw for p in pairs}) == len(pairs) == len({p.v for p in pairs})
    assert sorted(p.v for p in pairs) == list(range(len(pairs)))
    ordered = [p.raw for p in sorted(pairs, key=lambda p: p.v)]
    assert ordered == sorted(ordered, key=lambda x: x.encode())
    assert F is not None

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopflow.operators.ordered import positions, prefix_sums, previous_in_group
from shopflow.operators.split import stratified_split


def _data(spark, n=600, seed=3):
    rnd = random.Random(seed)
    # one hot key with a third of the rows
    rows = [(i, "hot" if i % 3 == 0 else f"k{rnd.randint(0, 30)}", rnd.randint(0, 50), rnd.randint(0, 9))
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, key string, t long, v long"), pd.DataFrame(
        rows, columns=["row_id", "key", "t", "v"])


def test_positions_match_brute_force(spark):
    df, pdf = _data(spark)
    got = positions(df, ["t", "row_id"], ["key"], num_blocks=7).toPandas().sort_values("row_id")
    exp = pdf.sort_values(["key", "t", "row_id"])
    exp["_pos"] = exp.groupby("key").cumcount() + 1
    exp = exp.sort_values("row_id")
    assert got["_pos"].tolist() == exp["_pos"].tolist()


def test_prefix_sums_match_brute_force(spark):
    df, pdf = _data(spark)
    got = prefix_sums(df, ["row_id"], ["v"], num_blocks=5).toPandas().sort_values("row_id")
    exp = pdf.sort_values("row_id")
    assert got["before_v"].tolist() == (exp["v"].cumsum() - exp["v"]).tolist()


def test_previous_in_group_hot_key_spans_blocks(spark):
    df, pdf = _data(spark)
    got = previous_in_group(df, ["key"], ["t", "row_id"], ["v"], num_blocks=9).toPandas().sort_values("row_id")
    exp = pdf.sort_values(["key", "t", "row_id"])
    exp["prev"] = exp.groupby("key")["v"].shift(1)
    exp = exp.sort_values("row_id")
    a = [None if pd.isna(x) else int(x) for x in got["prev_v"]]
    b = [None if pd.isna(x) else int(x) for x in exp["prev"]]
    assert a == b


def test_split_exact_sizes_small_strata(spark):
    rows = [(i, 1 if i < 7 else 0) for i in range(10)]
    df = spark.createDataFrame(rows, "row_id long, target int")
    out = stratified_split(df, (0.7, 0.15, 0.15)).toPandas()
    sizes = out.groupby(["split", "target"]).size().to_dict()
    assert sizes.get(("train", 1)) == 5 and sizes.get(("train", 0)) == 2
    assert sizes.get(("test", 1)) == 1 and sizes.get(("test", 0), 0) == 0
    assert sizes.get(("val", 1)) == 1 and sizes.get(("val", 0)) == 1


def test_split_properties(spark):
    df = spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 7 == 0).cast("int").alias("target"))
    a = stratified_split(df).toPandas()
    b = stratified_split(df).toPandas()
    assert len(a) == 5000 and a["row_id"].is_unique  # disjoint and covering
    assert (a.sort_values("row_id")["split"].values == b.sort_values("row_id")["split"].values).all()
    n = a["split"].value_counts().to_dict()
    assert n["train"] == 3500 and n["test"] == 750 and n["val"] == 750
    shares = a.groupby("split")["target"].mean()
    assert abs(shares["train"] - shares["val"]) < 2 / 750
    with pytest.raises(ValueError):
        stratified_split(df, (0.7, 0.2, 0.2))


def test_hot_key_spreads_over_blocks(spark):
    from shopflow.operators.ordered import range_blocks

    # one user with a third of all rows
    df = spark.range(30000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string")))
        .alias("user"), (F.col("id") * 7 % 1000).alias("t"))
    tagged = range_blocks(df, ["user", "t", "row_id"], num_blocks=12)
    per_block = tagged.where(F.col("user") == "hot").groupBy("_blk").count().collect()
    assert len(per_block) >= 3  # the hot key is not in one task
    assert max(r["count"] for r in per_block) <= 10000 * 0.6


def test_split_keeps_null_strata_and_null_ids(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 10 != 0, F.col("id")).alias("row_id"),
        F.when(F.col("id") % 7 != 3, (F.col("id") % 2).cast("int")).alias("target"), F.col("id").alias("v"))
    out = stratified_split(df).toPandas()
    assert len(out) == 1000 and sorted(out["v"]) == list(range(1000)) and out["split"].notna().all()
    assert out["split"].value_counts().to_dict() == {"train": 700, "test": 150, "val": 150}
    again = stratified_split(df.repartition(5)).toPandas()
    assert out.set_index("v")["split"].to_dict() == again.set_index("v")["split"].to_dict()


def test_split_spreads_equal_rows_without_ids(spark):
    """A third of the rows are one row without an id: each gets a key of its own, on any partitioning."""
    from shopflow.operators.split import _number_null_ids

    rows = [(None, 1, "same")] * 1000 + [(None, 0, f"t{i % 500}") for i in range(1000)] + [(i, i % 2, "x") for i in range(1000)]
    df = spark.createDataFrame(rows, "row_id long, target int, text string")
    numbered = _number_null_ids(df, "row_id").where("row_id is null")
    assert numbered.count() == numbered.select("_null_no").distinct().count() == 2000
    results = []
    for parts in (1, 6):
        out = stratified_split(df.repartition(parts))
        assert out.columns == [*df.columns, "split"]
        results.append(out.groupBy(*out.columns).count().toPandas().sort_values(out.columns).reset_index(drop=True))
    assert results[0].equals(results[1])
    sizes = results[0].groupby("split")["count"].sum()
    assert sizes["train"] == 2100 and sizes.sum() == 3000
    same = results[0][results[0]["text"] == "same"].groupby("split")["count"].sum()
    assert abs(same["train"] - 700) < 80  # spread like any other rows

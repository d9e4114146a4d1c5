from pyspark.sql import functions as F

from shopflow.functions.fill import fill_missing_zero
from shopflow.operators import encode, stats


def test_sorted_encoding_is_byte_order(spark):
    df = spark.createDataFrame([(1, "10"), (2, "9"), (3, "-1"), (4, "unknown"), (5, "9")], "row_id long, v string")
    out = {r.row_id: r.v for r in encode.label_encode(df, ["v"]).collect()}
    assert out == {1: 1, 2: 2, 3: 0, 4: 3, 5: 2}


def test_frozen_unseen_and_first_seen(spark):
    ref = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "c")], "row_id long, v string")
    new = spark.createDataFrame([(10, "a"), (11, "zzz"), (12, "c")], "row_id long, v string")
    s = {r.row_id: r.v for r in encode.label_encode_frozen(new, ref, ["v"]).collect()}
    assert s == {10: 0, 11: -1, 12: 2}
    f = {r.row_id: r.v for r in encode.label_encode_frozen(new, ref, ["v"], order="first_seen").collect()}
    assert f == {10: 1, 11: -1, 12: 2}


def test_joint_native_order_missing_last(spark):
    a = spark.createDataFrame([(1, 10, "x"), (2, 9, None)], "row_id long, n long, t string")
    b = spark.createDataFrame([(3, 100, "w")], "row_id long, n long, t string")
    ea, eb = encode.label_encode_joint([a, b], ["n", "t"])
    got = {r.row_id: (r.n, r.t) for r in ea.unionByName(eb).collect()}
    assert got == {1: (1, 1), 2: (0, 2), 3: (2, 0)}  # 9 < 10 < 100 numerically; NULL after the last code


def test_group_edges(spark):
    # one-row user, NULL shop key, all-NULL column in a group
    df = spark.createDataFrame(
        [(1, "u1", 1, 1, None, 1), (2, "u2", 2, None, None, 3), (3, "u2", 3, None, None, 4), (4, None, 4, 5, "b", 2)],
        "row_id long, user_log_acct string, item_sku_id long, shop_id long, brand_code string, action_type int")
    df = df.withColumn("hour", F.lit(3)).withColumn("item_third_cate_cd", F.lit("c"))
    u = {r.user_log_acct: r for r in stats.rich_user_stats(df).collect()}
    assert set(u) == {"u1", "u2"}  # NULL key gets no row
    assert u["u1"].user_action_type_std is None  # single row -> NULL (0 after the zero fill)
    assert u["u2"].user_shop_id_nunique == 0 and u["u2"].user_brand_code_nunique == 0
    r = {x.row_id: x for x in fill_missing_zero(stats.ratio_features(df)).collect()}
    assert r[2].user_shop_ratio == 0.0  # 0 / 0 -> NULL -> 0
    assert r[4].user_item_ratio == 0.0  # NULL user key: no statistics
    assert r[2].user_item_ratio == 1.0


def test_hot_key_join_back_is_split(spark):
    """Half of the rows on one user: the final plan of both join-backs splits the skewed partition."""
    from pyspark.sql import functions as F

    from shopflow.operators import stats

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        df = spark.range(200000).select(
            i.alias("row_id"), F.when(i % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), i % 5000)).alias("user_log_acct"),
            (i % 999).alias("item_sku_id"), (i % 5).cast("int").alias("action_type"), (i % 10).alias("shop_id"),
            (i % 7).cast("string").alias("brand_code"), (i % 3).cast("string").alias("item_third_cate_cd"),
            (i % 24).cast("int").alias("hour"))
        for attach in (stats.attach_base_stats, stats.attach_rich_stats):
            out = attach(df)
            total = out.select(F.count(F.lit(1)), F.sum(F.hash(*out.columns)))
            assert total.collect()[0][0] == 200000
            assert "skew=true" in str(total._jdf.queryExecution().executedPlan())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

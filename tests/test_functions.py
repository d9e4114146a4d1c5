import datetime as dt

from pyspark.sql import functions as F

from shopflow.functions import labels as L
from shopflow.functions.fill import fill_missing_typed, fill_missing_zero
from shopflow.functions.request import request_defaults
from shopflow.functions.time import clean_time_text, hour_bucket, parse_time_coerce, time_parts, weekend_flag


def test_time_edges(spark):
    # hours 0, 6, 7, 12, 18, 23; 2024-01-06 is a Saturday, 01-07 Sunday, 01-08 Monday
    rows = [(dt.datetime(2024, 1, 6, 0, 0, 0),), (dt.datetime(2024, 1, 6, 6, 0, 0),),
            (dt.datetime(2024, 1, 7, 7, 0, 0),), (dt.datetime(2024, 1, 7, 12, 0, 0),),
            (dt.datetime(2024, 1, 8, 18, 0, 0),), (dt.datetime(2024, 1, 8, 23, 59, 59),)]
    df = spark.createDataFrame(rows, "action_time timestamp_ntz")
    out = time_parts(df).select("hour", "dayofweek", weekend_flag("dayofweek").alias("w"),
                                hour_bucket("hour").alias("b"),
                                hour_bucket("hour", include_midnight=True).alias("b0")).collect()
    assert [r.hour for r in out] == [0, 6, 7, 12, 18, 23]
    assert [r.dayofweek for r in out] == [5, 5, 6, 6, 0, 0]
    assert [r.w for r in out] == [1, 1, 1, 1, 0, 0]
    assert [r.b for r in out] == [None, "凌晨", "上午", "上午", "下午", "晚上"]
    assert out[0].b0 == "凌晨"


def test_parse_coerce_and_clean(spark):
    df = spark.createDataFrame([("2024-01-05 10:11:12.0",), ("not-a-time",), ("2024-02-30 00:00:00",)], "t string")
    out = df.select(parse_time_coerce(clean_time_text("t")).alias("p")).collect()
    assert out[0].p == dt.datetime(2024, 1, 5, 10, 11, 12)
    assert out[1].p is None and out[2].p is None


def test_fills(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, b double, c int")
    r = fill_missing_typed(df).first()
    assert (r.a, r.b, r.c) == ("unknown", -1.0, -1)
    r = fill_missing_zero(df).first()
    assert (r.a, r.b, r.c) == (None, 0.0, 0)


def test_probability_edges(spark):
    df = spark.createDataFrame([(0.1,), (0.3,), (0.5,), (0.7,), (0.9,), (0.95,)], "p double")
    out = df.select(L.confidence_binary("p").alias("c"), L.threshold_predict("p").alias("y"),
                    *L.binary_outcome("p")).collect()
    assert [r.c for r in out] == ["高", "中等", None, "中等", "高", "非常高"]
    assert [r.y for r in out] == [0, 0, 0, 1, 1, 1]  # strictly greater than 0.5


def test_argmax_ties_pad_two_valued(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4, 0.0, 0.0],), ([0.3, 0.7],), ([1.0],)], "p array<double>")
    out = df.select(L.argmax("p").alias("a"), L.pad_probabilities("p").alias("q"),
                    L.two_valued(L.pad_probabilities("p")).alias("t"),
                    L.confidence_multiclass("p").alias("c")).collect()
    assert out[0].a == 1  # tie goes to the lower class
    assert out[1].q == [0.3, 0.7, 0.0, 0.0, 0.0]
    assert [r.t for r in out] == [False, False, True]
    assert [r.c for r in out] == ["低", "高", "非常高"]


def test_action_names(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "a int")
    out = df.select(L.action_name("a", one_based=True).alias("n")).collect()
    assert [r.n for r in out] == ["浏览", "其他行为", "未知行为(9)"]


def test_request_defaults(spark):
    df = spark.createDataFrame([("", "", "", "", "", "", "1.5")],
                               "user_log_acct string, action_time string, age string, sex string, province string, "
                               "shop_id string, shop_score string")
    r = request_defaults(df, now=dt.datetime(2024, 2, 1, 12, 0, 0)).first()
    assert r.user_log_acct == "unknown" and r.province == "unknown" and r.shop_id == "unknown"
    assert r.age == -1 and r.sex == -1 and r.shop_score == 1.5
    assert r.action_time == "2024-02-01 12:00:00"
    assert F is not None


def test_load_reference_layout_csv_assigns_file_order(spark, tmp_path):
    from shopflow.schema import BEHAVIOR_COLUMNS
    from shopflow.sources import io

    path = str(tmp_path / "log.csv")
    cols = [c for c in BEHAVIOR_COLUMNS if c != "row_id"]
    lines = [",".join(cols)]
    for i in range(5):
        lines.append(f"u{i},{100 + i},2024-01-0{i + 1} 10:00:00,{1 + i % 5},b{i},{i},c,{i},1.5,2,1,3,p,c,x")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    df = io.load_behavior(spark, path)
    rows = df.orderBy("row_id").collect()
    assert df.columns == BEHAVIOR_COLUMNS
    assert [r.item_sku_id for r in rows] == [100, 101, 102, 103, 104]
    assert rows[2].action_time == dt.datetime(2024, 1, 3, 10, 0, 0) and rows[0].shop_score == 1.5


def test_parse_strict_raises(spark):
    import pytest

    from shopflow.functions.time import parse_time_strict

    df = spark.createDataFrame([("2024-01-05 10:11:12",), ("not-a-time",)], "t string")
    with pytest.raises(Exception):
        df.select(parse_time_strict("t")).collect()

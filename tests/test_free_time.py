"""Free-format times against pandas."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopflow.functions.time import LOG_SHAPE, infer_time_shape, parse_time_free, time_shape
from shopflow.plans.features import prepare_time

COLUMNS = [
    ["2024-01-02T11:00:00", "2024-12-31T23:59:59"], ["2024/01/02 11:00", "2024/1/2 1:05"], ["2024-01-02", "2024-02-29"],
    ["2024-01-02 11:00:00+08:00", "2024-01-03 00:00:01+08:00"], ["2024-01-02T11:00:00Z", "2024-01-02T12:00:00Z"],
    ["01/02/2024", "12/31/2024"], ["20240102", "20241231"], ["20240102T110000", "20241231T235959"],
    ["2024-01-02 11:00:00.25", "2024-01-02 11:00:00.5"], ["2024-01-02 11:00:00", "2024-01-02 11:00:01"],
]


@pytest.mark.parametrize("texts", COLUMNS)
def test_one_format_equals_pandas(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([None, *texts, ""])], "row_id long, t string")
    got = df.select("row_id", parse_time_free("t", infer_time_shape(df, "t")).alias("t")).orderBy("row_id").collect()
    want = [None if pd.isna(x) else x.to_pydatetime().replace(tzinfo=None) for x in pd.to_datetime(pd.Series([None, *texts]))]
    assert [r.t for r in got] == [*want, None]


@pytest.mark.parametrize("texts", [["2024-01-02", "2024/01/02"], ["2024-01-02 11:00:00", "2024-01-02T11:00:00"], ["2024-01-02", "x"],
                                   ["2024-01-02 11:00:00+08:00", "2024-01-02 11:00:00+09:00"], ["2024-01-02", "2024-02-30"],
                                   ["not-a-time", "not-a-time"], ["2024-01-02 11:00", "2024-01-02"]])
def test_mixed_column_fails_or_is_null(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row_id long, t string")
    shape = infer_time_shape(df, "t")
    with pytest.raises(Exception, match="time does not have the format"):
        df.select(parse_time_free("t", shape)).collect()
    lenient = [r.t for r in df.select(parse_time_free("t", shape, strict=False).alias("t")).collect()]
    assert lenient[1] is None


def test_strict_preparation_takes_the_first_format(spark):
    df = spark.createDataFrame([(1, "2024-01-02T11:05:00.0"), (2, "2024-01-06T00:00:00")], "row_id long, action_time string")
    out = prepare_time(df, mode="raise").orderBy("row_id").collect()
    assert [(r.hour, r.day, r.dayofweek) for r in out] == [(11, 2, 1), (0, 6, 5)]
    for mode in ("fixed", "raise"):
        mixed = df.unionByName(spark.createDataFrame([(0, "2024-01-02 11:00:00")], df.schema))
        with pytest.raises(Exception):
            prepare_time(mixed, mode=mode).collect()
    assert [r.action_time for r in prepare_time(df, mode="coerce").collect()] == [None, None]


def test_shapes(spark):
    texts = {"2024-01-02 11:00:00": LOG_SHAPE, "2024-01-02 11:00:00.123": LOG_SHAPE, "2024-1-2 1:00:00": LOG_SHAPE,
             "2024-01-02T11:00:00Z": "Y-9-9T9:9:9+0000", "2024-01-02 11:00:00.5-0330": "Y-9-9 9:9:9-0330", "2024-01-02": "Y-9-9",
             "20240102": "YMD", "20240102110000": "YMDHMS", "01/02/2024": "9/9/9"}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.s for r in df.select("t", time_shape("t").alias("s")).collect()} == texts
    assert infer_time_shape(df.where(F.lit(False)), "t") is None

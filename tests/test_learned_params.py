"""The registered five-class model is trained with the reference's whole schedule."""

from pyspark.sql import functions as F

from shopflow.plans import learned
from shopflow.plans import train as T


def test_five_class_query_trains_the_whole_schedule(spark, monkeypatch):
    seen = {}
    rows = spark.range(10).select((F.col("id") % 5).cast("int").alias("label"))
    monkeypatch.setattr(learned, "splits", lambda *_: {"features": {"train": rows, "val": rows}})
    monkeypatch.setattr(T, "fit_multiclass", lambda train, val, features, params, **kw: seen.update(params=params) or "model")
    assert learned.multiclass_model(spark, "/no/such/folder") == "model"
    learned._CACHE.pop(learned._key(spark, "/no/such/folder", "multiclass"))
    p = seen["params"]
    assert (p.step_size, p.max_iter, p.patience) == (0.01, 2000, 100) and p == T.MULTICLASS_PARAMS

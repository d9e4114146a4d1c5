"""Behaviour-log views derived from the given tables (see FIXTURES.md).

``behavior``  one row per event with the reference's column set.
``behavior_text``  the same with ``action_time`` as text, some ``.0`` suffixes and some unparsable values.
``scored``  labels with deterministic binary and five-class probabilities for metric operators.
``requests``  text request records with blank fields for record scoring.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BEHAVIOR_COLUMNS
from ..session import scratch_path
from .tables import table

_STORED: dict[tuple, str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Derive a fixture once per session and keep it as a Parquet table in the shared folder.

    Later reads are plain columnar scans (pruning, pushdown) instead of re-running the
    derivation; the table also cuts lineage, so lost executors recompute nothing upstream.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _STORED:
        path = scratch_path(spark, f"fixture-{name}")
        build().write.mode("overwrite").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])

# Fixed values of the fixture definition: event type -> action code.
EVENT_ACTION = {"view": 1, "purchase": 2, "signup": 3, "click": 4}
OTHER_EVENT_ACTION = 5


def _action_code(c: Column) -> Column:
    expr = F.lit(OTHER_EVENT_ACTION)
    for name, code in reversed(list(EVENT_ACTION.items())):
        expr = F.when(c == name, F.lit(code)).otherwise(expr)
    return expr.cast("int")


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log (stored once per session, see ``stored``)."""
    return stored(spark, sf_dir, "behavior", lambda: derive_behavior(spark, sf_dir))


def derive_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log: events joined to part, supplier, customer, nation, region.

    The dimension joins are plain equi-joins; AQE turns them into broadcasts when the
    measured dimension side is small and keeps sort-merge otherwise.
    """
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.regexp_extract("props", r"([0-9]+)", 1).cast("int").alias("k"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("k")
    j = (ev.join(part, part.p_partkey == k)
         .join(supplier, supplier.s_suppkey == k % 10)
         .join(customer, customer.c_custkey == ev.user_id)
         .join(nation, nation.n_nationkey == customer.c_nationkey)
         .join(region, region.r_regionkey == nation.n_regionkey))
    uid = F.col("user_id")
    return j.select(
        F.col("event_id").alias("row_id"),
        F.concat(F.lit("u"), uid.cast("string")).alias("user_log_acct"),
        k.cast("long").alias("item_sku_id"),
        F.col("ts").alias("action_time"),
        _action_code(F.col("event_type")).alias("action_type"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("brand_code"),
        (k % 10).cast("long").alias("shop_id"),
        F.col("p_type").alias("item_third_cate_cd"),
        F.col("s_nationkey").cast("long").alias("vender_id"),
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise((k % 11).cast("double")).alias("shop_score"),
        F.when(uid % 13 == 0, F.lit(None).cast("double")).otherwise((uid % 7).cast("double")).alias("age"),
        ((uid % 3).cast("int") - 1).alias("sex"),
        ((uid % 7).cast("int") + 1).alias("user_level"),
        F.col("r_name").alias("province"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("county"),
    ).select(*BEHAVIOR_COLUMNS)


def behavior_text(spark: SparkSession, sf_dir: str, with_bad: bool = True) -> DataFrame:
    """``behavior`` with ``action_time`` as text: every 23rd row gets ``.0``, every 41st is unparsable.

    ``with_bad=False`` keeps every row parsable (input of the strict parser).
    """
    b = behavior(spark, sf_dir)
    txt = F.date_format("action_time", "yyyy-MM-dd HH:mm:ss")
    rid = F.col("row_id")
    bad = (rid % 41 == 0) if with_bad else F.lit(False)
    txt = (F.when(bad, F.lit("not-a-time"))
           .when(rid % 23 == 0, F.concat(txt, F.lit(".0")))
           .otherwise(txt))
    return b.withColumn("action_time", txt)


def scored(spark: SparkSession, sf_dir: str, rotation: int = 0) -> DataFrame:
    """Scored labels (stored once per session and rotation, see ``stored``)."""
    return stored(spark, sf_dir, f"scored{rotation}", lambda: derive_scored(spark, sf_dir, rotation))


def derive_scored(spark: SparkSession, sf_dir: str, rotation: int = 0) -> DataFrame:
    """Labels with deterministic probabilities (FIXTURES.md §3).

    ``rotation`` shifts the weight multipliers (7, 11, 13, 17, 19) for ensemble members.
    """
    mult = [7, 11, 13, 17, 19]
    mult = mult[rotation:] + mult[:rotation]
    mods = [97, 89, 83, 79, 73]
    ev = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.regexp_extract("props", r"([0-9]+)", 1).cast("int").alias("k"))
    eid, k = F.col("event_id"), F.col("k")
    label = (_action_code(F.col("event_type")) - 1).alias("label")
    ws = [((eid * m + k) % d + 1) for m, d in zip(mult, mods)]
    total = ws[0] + ws[1] + ws[2] + ws[3] + ws[4]
    s = (eid * 37 + k * 11) % 101
    return ev.select(
        eid.alias("row_id"),
        label,
        F.when(label == 1, 1).otherwise(0).cast("int").alias("target"),
        (s.cast("double") / F.lit(100.0).cast("double")).alias("probability"),
        *[(w.cast("double") / total).alias(f"p{i}") for i, w in enumerate(ws)],
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text request records derived from ``behavior`` with some blank fields.

    Blank patterns cycle with ``row_id``: all filled, all blank, unseen brand, score only.
    """
    b = behavior(spark, sf_dir)
    rid = F.col("row_id")
    pattern = rid % 4
    fields = ["user_log_acct", "item_sku_id", "action_time", "age", "sex", "user_level", "province",
              "city", "county", "brand_code", "shop_id", "item_third_cate_cd", "vender_id", "shop_score"]
    out = [rid]
    for f in fields:
        if f == "action_time":
            txt = F.date_format(F.col(f), "yyyy-MM-dd HH:mm:ss")
        elif f == "age":
            txt = F.col(f).cast("int").cast("string")
        else:
            txt = F.col(f).cast("string")
        txt = F.coalesce(txt, F.lit(""))
        if f == "brand_code":
            txt = F.when(pattern == 2, F.concat(F.lit("new-"), txt)).otherwise(txt)
        blank = (pattern == 1) | ((pattern == 3) & F.lit(f not in ("user_log_acct", "item_sku_id", "shop_score")))
        out.append(F.when(blank, F.lit("")).otherwise(txt).alias(f))
    return b.select(*out)

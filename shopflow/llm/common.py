"""Helpers shared by the operators: written hand-off tables, text columns, null-safe joins."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the session's Python workers this package (once), so that functions sent to them can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


WHITE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, survives
    lost executors and lets later joins see a plain scan (so AQE may split skewed sides)."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_split(df: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """``df`` joined with an aggregate on ``key``.  The hash of the key as a second key makes Spark exchange
    the (small) aggregate once more, and only then can AQE split a hot key's rows."""
    hashed = totals.withColumn("_hashed_key", F.xxhash64(key))
    return df.withColumn("_hashed_key", F.xxhash64(key)).join(hashed, [key, "_hashed_key"]).drop("_hashed_key")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_bytes(name: str = "text") -> Column:
    return F.encode(text_or_empty(name), "UTF-8")


def collapsed_white(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; nothing is trimmed."""
    return F.regexp_replace(text, WHITE, " ")


def fold(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``: the documented train / held-out split."""
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(buckets))

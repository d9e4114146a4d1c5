"""Exact deduplication by a stateful stream (native functions only).

A file stream computes the SHA-256 digest of each normalised text and keeps, per digest, one
state row in the disk-backed (RocksDB) state store: the stable identifier of the row that stays
(smallest doc_id), its content locator (file and row position) and the count of rows.  State has
no watermark and never expires, so later runs on the same checkpoint see every earlier text.
When the stream has read all files, the state is read back as a table; each row whose digest was
hit is compared byte by byte with the text its locator points to.  Rows that share a digest but
not the bytes are grouped by their full text, so even a weak digest gives right results.

Defined results: a null text counts as empty; long texts are hashed and compared whole; repeated rows are rows of one
group; null doc_ids sort after all others; of rows with
equal doc_id and text the one with the smaller locator stays; an empty table gives no rows;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import collapsed_white, text_or_empty, written

SALT_ROWS = 500

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # small stores would otherwise reserve megabytes of disk each for logs they never fill
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_digest(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _keyed(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, normalised text, digest and locator of every row of a file scan (batch or stream)."""
    return rows.select(
        F.col("doc_id").alias("doc_id"),
        collapsed_white(text_or_empty()).alias("norm"),
        F.struct(F.col("_metadata.file_path").alias("file"),
                 F.col("_metadata.row_index").alias("row")).alias("locator"),
    ).withColumn("digest", digest(F.col("norm")))


def _rank(doc_id: Column, locator: Column) -> Column:
    """Order in which equal texts compete: smallest doc_id, nulls last, then the locator."""
    return F.struct(doc_id.isNull().alias("absent"), doc_id.alias("doc_id"), locator.alias("locator"))


def run_stream(spark: SparkSession, path: str, checkpoint: str,
               digest: Callable[[Column], Column] = sha256_digest,
               max_files_per_trigger: int | None = None) -> None:
    """Read all files of ``path`` not yet seen by ``checkpoint`` into the keyed state; returns when done."""
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # a stream takes a directory as its base path; written as a pattern, a single file works as well
    pattern = re.sub(r"([^/])/*$", r"[\1]", path)
    keyed = _keyed(reader.parquet(pattern), digest)
    state = keyed.groupBy("digest").agg(
        F.min(_rank(F.col("doc_id"), F.col("locator"))).alias("first"), F.count(F.lit(1)).alias("n"))
    with _settings(spark, STATE_CONF):
        query = (state.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, first (absent, doc_id, locator) and n of every digest seen so far."""
    state = spark.read.format("statestore").load(checkpoint)
    first, n = state.schema["value"].dataType.names
    return state.select(F.col("key.digest").alias("digest"), F.col(f"value.{first}").alias("first"),
                        F.col(f"value.{n}").alias("n"))


def exact_dedup(spark: SparkSession, path: str, checkpoint: str | None = None,
                digest: Callable[[Column], Column] = sha256_digest,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, locator, digest, keep_id,
    group_size, kept.  ``checkpoint`` continues an earlier stream over the same path."""
    checkpoint = checkpoint or scratch_path(spark, "dedup-stream")
    run_stream(spark, path, checkpoint, digest, max_files_per_trigger)
    state = read_state(spark, checkpoint)
    repeated = state.where(F.col("n") > 1)
    # texts of hit digests only; both sides come from plain scans, so a digest that holds a
    # third of all rows is split by AQE
    hits = written(
        _keyed(spark.read.parquet(path), digest).join(repeated, "digest", "left")
        .select("doc_id", "locator", "digest", "n", "first",
                (F.col("first.locator") == F.col("locator")).alias("is_first"),
                F.when(F.col("n").isNotNull(), F.col("norm")).alias("norm")),
        "dedup-hits")
    single = hits.where(F.col("n").isNull())
    several = hits.where(F.col("n").isNotNull())
    # a digest's rows are dealt over n / SALT_ROWS keys, with a copy of the first text for each
    salts = F.ceil(F.col("n") / F.lit(SALT_ROWS)).cast("int")
    every_salt = F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    firsts = several.where("is_first").select("digest", F.col("norm").alias("first_norm"), every_salt)
    salted = several.withColumn("salt", F.pmod(F.xxhash64("locator"), salts).cast("int"))
    compared = salted.join(firsts, ["digest", "salt"]).select(
        "doc_id", "locator", "digest", "salt", "n", "first",
        F.when(F.col("norm") != F.col("first_norm"), F.col("norm")).alias("other_norm"))
    compared = written(compared, "dedup-compared")
    others = compared.where(F.col("other_norm").isNotNull())
    other_counts = (others.groupBy("digest").agg(F.count(F.lit(1)).alias("n_other"), F.max("n").alias("n"))
                    .select("digest", "n_other", every_salt))
    same = (compared.where(F.col("other_norm").isNull()).join(other_counts, ["digest", "salt"], "left")
            .select("doc_id", "locator", "digest", F.col("first.doc_id").alias("keep_id"),
                    (F.col("n") - F.coalesce(F.col("n_other"), F.lit(0))).alias("group_size"),
                    (F.col("first.locator") == F.col("locator")).alias("kept")))
    # rows that share a digest without the bytes: grouped by the text itself
    other_groups = others.groupBy("digest", "other_norm").agg(
        F.min(_rank(F.col("doc_id"), F.col("locator"))).alias("other_first"),
        F.count(F.lit(1)).alias("group_size"))
    other = others.join(other_groups, ["digest", "other_norm"]).select(
        "doc_id", "locator", "digest", F.col("other_first.doc_id").alias("keep_id"), "group_size",
        (F.col("other_first.locator") == F.col("locator")).alias("kept"))
    alone = single.select("doc_id", "locator", "digest", F.col("doc_id").alias("keep_id"),
                          F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return alone.unionByName(same).unionByName(other)


def dedup_frame(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept.  The frame is written once so that its
    rows have locators."""
    spark = docs.sparkSession
    path = scratch_path(spark, "dedup-input")
    docs.write.parquet(path)
    kept = exact_dedup(spark, path).where("kept").select(F.col("locator").alias("_kept_locator"))
    rows = spark.read.schema(docs.schema).parquet(path)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    located = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), at.alias("_locator"))
    stays = located.join(kept, located["_locator"] == kept["_kept_locator"], "left_semi")
    return stays.select("_row.*")

"""Corpus pipeline: quality, toxicity, exact copies, near copies, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns the rows for
the next stage, all columns of ``documents`` kept, but for the last, which returns packed pieces.
Every stage's result is written as Parquet and read again, so a lost executor costs one stage at most.

Rules: documents with a quality score below 0.5 go; documents with a toxicity score of 0.7 or more go;
of equal texts (after white space is collapsed) the smallest doc_id stays, and so it does of texts
whose SimHash fingerprints are linked at 4 or fewer differing bits.  Null and empty texts are scored like
any others; an empty table gives an empty result; extra columns are passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm import exact_dedup, packing, quality, simhash, toxicity
from shopflow.llm.common import documents, labels
from shopflow.llm.tokens import vocabulary_path
from shopflow.session import scratch_path

MIN_QUALITY = 0.5
TOXIC = 0.7


def _filtered(scored: DataFrame, columns: list[str], keep) -> DataFrame:
    return scored.where(keep).select("row.*").select(*[F.col(f"`{c}`") for c in columns])


def _as_rows(docs: DataFrame) -> DataFrame:
    """The whole row in one struct beside its text, so that no added column can clash with an extra one."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(documents(spark, sf_dir), labels(spark, sf_dir))
    return _filtered(model.with_score(_as_rows(docs)), docs.columns, F.col("score") >= MIN_QUALITY)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(documents(spark, sf_dir), labels(spark, sf_dir))
    return _filtered(toxicity.with_segments(_as_rows(docs), model), docs.columns, F.col("toxicity.score") < TOXIC)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_frame(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, shingle=4, max_bits=4)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary_path("byte_bpe_50k.json"), end_id=1, capacity=2048)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("packing", packing_stage),
]

#: Learned scores, fingerprints and token ids cannot be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

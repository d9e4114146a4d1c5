"""Token-id files: documents in ascending doc_id order as blocks of canonical Huffman codes.

A file set under one path has two Parquet tables (Spark's committers make the writes safe against
lost executors):

``codes``   id, length: the code, from the counts of all ids of the file set (at most one row per
            vocabulary id, so it is read whole by reader and writer).
``blocks``  part, block, start (ids of the part before the block), n_ids, doc_ids, sizes (ids per
            document), payload (the bit stream) and checkpoints (bit offset of every 128th id).
            A block holds whole documents, about ``BLOCK_IDS`` ids, and is decoded on its own.

Parts are ranges of doc_id in ascending order, so a document's first id has the global number
(ids of earlier parts) + (block's start) + (ids before it in the block).

Defined results: a null text is empty and has the end id only; a long text is encoded whole and lies in one block;
repeated rows are written each; null doc_ids come first; rows of
equal doc_id are ordered by their ids; an empty table gives an empty file set; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship_package, text_or_empty, written
from .huffman import Codec, code_lengths
from .tokens import byte_bpe

BLOCK_IDS = 1 << 15
BLOCK_SCHEMA = ("part int, block int, start long, n_ids long, doc_ids array<long>, sizes array<long>, "
                "payload binary, checkpoints array<long>")


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int | None) -> DataFrame:
    """doc_id and ids (packed little-endian, in the vocabulary's dtype) of every whole text, with
    ``end_id`` appended."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        tail = b"" if end_id is None else np.array([end_id], dtype=bpe.dtype).tobytes()
        for batch in batches:
            for rows in _slices(batch, 1):
                ids = [bpe.encode(t).astype(bpe.dtype).tobytes() + tail for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    ship_package(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(encode, "doc_id long, ids binary"))


def _slices(batch: pa.RecordBatch, column: int, target: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose values in ``column`` take about ``target`` bytes."""
    if batch.num_rows == 0:
        return
    step = max(1, int(batch.num_rows * target / max(1, batch.column(column).nbytes)))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def id_counts(encoded_docs: DataFrame, dtype: str) -> DataFrame:
    """id, n over all documents: counted per task first, so at most one row per id and task moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for rows in _slices(batch, 0):  # the ids of many documents at once
                seen = np.bincount(np.frombuffer(b"".join(rows.column(0).to_pylist()), dtype=dtype), minlength=len(total))
                seen[: len(total)] += total
                total = seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return (encoded_docs.select("ids").mapInArrow(count, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")))


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None) -> None:
    spark = docs.sparkSession
    dtype = byte_bpe(tokenizer_path).dtype
    table = written(encoded(docs, tokenizer_path, end_id), "token-ids")
    counts = id_counts(table, dtype).orderBy("id").toPandas()  # at most the vocabulary
    ids, n = counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    lengths = code_lengths(ids, n)
    spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist(), strict=True)), "id long, length long") \
        .coalesce(1).write.parquet(f"{path}/codes")
    shipped = spark.sparkContext.broadcast((ids, lengths))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = Codec(*shipped.value), TaskContext.get().partitionId()
        held, doc_ids, size, block, start = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            payload, checkpoints = codec.encode(np.concatenate(held))
            row = [part, block, start, size, doc_ids, [len(h) for h in held], payload, checkpoints.tolist()]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)],
                                              ["part", "block", "start", "n_ids", "doc_ids", "sizes", "payload",
                                               "checkpoints"])

        for batch in batches:
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.append(np.frombuffer(packed, dtype=dtype))
                doc_ids.append(doc_id)
                size += len(held[-1])
                if size >= BLOCK_IDS:
                    yield flush()
                    start, block = start + size, block + 1
                    held, doc_ids, size = [], [], 0
        if held:
            yield flush()

    (table.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"))
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), "ids")
     .mapInArrow(blocks, BLOCK_SCHEMA)
     .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (global number of its first id), n_tokens and ids (little-endian uint32)."""
    ship_package(spark)
    codes = spark.read.parquet(f"{path}/codes").toPandas()  # at most the vocabulary
    shipped = spark.sparkContext.broadcast((codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64)))
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    # one row per part; parts are as many as the writer had partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shipped.value)
        for batch in batches:
            for part, start, n, doc_ids, sizes, payload, checkpoints in zip(
                    *[c.to_pylist() for c in batch.columns], strict=True):
                ids = codec.decode(payload, np.asarray(checkpoints), n)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                packed = [ids[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()),
                     pa.array(starts + start, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                    ["part", "doc_id", "local", "n_tokens", "ids"])

    docs = blocks.select("part", "start", "n_ids", "doc_ids", "sizes", "payload", "checkpoints").mapInArrow(
        decode, "part int, doc_id long, local long, n_tokens long, ids binary")
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("local") + F.col("part_start")).alias("start"), "n_tokens", "ids")

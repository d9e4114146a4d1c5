"""Packing of token sequences by cutting-stock column generation.

Every document becomes its ids and an end id, cut into pieces of ``capacity`` ids and a remainder.
Piece lengths are counted in bins of ``UNIT`` ids (rounded up), a histogram of at most
capacity / UNIT rows whatever the corpus (single ids where the capacity is below 8 ``UNIT``).  On that histogram the driver solves the cutting-stock
linear program by column generation (knapsack dynamic programming prices the columns) and rounds
the pattern uses; the pieces of each bin, ranked by (doc_id, start), are then dealt to the patterns
in order on the executors: rank -> pattern, sequence and place by one search in a sorted table.

Any ``capacity`` of 1 or more is right: where ``UNIT`` does not divide it, a piece longer than its whole bins
is alone in its sequence, as it would be anyway but for fewer than ``UNIT`` ids.  Defined results: a null or empty text becomes one piece with the end id; a long
text is encoded whole and cut into pieces; null doc_ids rank
first; repeated rows are packed each; an empty table gives no sequences; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import positions
from .common import ship_package, text_or_empty, written
from .cutting_stock import integer_patterns
from .token_files import _slices
from .tokens import byte_bpe

UNIT = 8
RANK_BITS = 44


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and ids (packed, the vocabulary's dtype) per piece."""
    ship_package(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        for batch in batches:
            for rows in _slices(batch, 1):
                out: list[tuple] = []
                for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    ids = np.append(bpe.encode(text), end_id).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        piece = ids[start: start + capacity]
                        out.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids),
                                    piece.astype(bpe.dtype).tobytes()))
                types = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
            .mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"))


def cut_table(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """``pieces`` written once, each with a number of its own (``piece_id``)."""
    return written(pieces(docs, tokenizer_path, end_id, capacity).withColumn(
        "piece_id", F.monotonically_increasing_id()), "pack-pieces")


def _layout(patterns: list[tuple[np.ndarray, int]]) -> dict[str, np.ndarray]:
    """For each (bin, pattern): the bin's first rank there, copies per sequence, first sequence and place."""
    rows, first_sequence, given = [], 0, {}
    for pattern, count in patterns:
        place = 0
        for size in np.flatnonzero(pattern)[::-1].tolist():
            copies = int(pattern[size])
            low = given.get(size, 0)
            rows.append(((size << RANK_BITS) + low, copies, first_sequence, place))
            given[size] = low + copies * count
            place += copies
        first_sequence += count
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {k: table[:, i] for i, k in enumerate(("key", "copies", "sequence", "place"))}


def assign(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """``sequence_id`` and ``offset`` of every row of a written table of pieces (ids are not read)."""
    if capacity < 1:
        raise ValueError("capacity must be 1 or more")
    unit = UNIT if capacity >= 8 * UNIT else 1
    bins_in_all = capacity // unit
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece_id"]
    narrow = cut.select(*kept, F.least(F.ceil(F.col("length") / F.lit(unit)), F.lit(bins_in_all)).cast("int").alias("bin"))
    histogram = narrow.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()  # capacity / UNIT rows at most
    demand = np.zeros(bins_in_all + 1, dtype=np.int64)
    for row in histogram:
        demand[row["bin"]] = row["n"]
    spark = cut.sparkSession
    shipped = spark.sparkContext.broadcast(_layout(integer_patterns(demand, bins_in_all)))
    ranked = positions(narrow, ["doc_id", "start", "ids_crc32", "piece_id"], ["bin"], pos_col="_pos")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            bins = batch.column("bin").to_numpy().astype(np.int64)
            rank = batch.column("_pos").to_numpy() - 1
            at = np.searchsorted(table["key"], (bins << RANK_BITS) + rank, side="right") - 1
            ahead = rank - (table["key"][at] & ((1 << RANK_BITS) - 1))
            turn, copy = np.divmod(ahead, table["copies"][at])
            keep = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(table["sequence"][at] + turn), pa.array(table["place"][at] + copy)],
                [*kept, "sequence_id", "_place"])

    dealt = ranked.mapInArrow(deal, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                    "piece_id long, sequence_id long, _place long")
    before = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return assign(cut_table(docs, tokenizer_path, end_id, capacity), capacity).drop("piece_id", "_place")


def sequences(cut: DataFrame, assigned: DataFrame) -> DataFrame:
    """sequence_id, n_ids and ids (pieces joined in order) from a written table of pieces and ``assign``
    on it.  A sequence holds ``capacity`` ids at most, so its group is bounded."""
    parts = assigned.select("sequence_id", "offset", "length", "piece_id").join(cut.select("piece_id", "ids"), "piece_id")
    return (parts.groupBy("sequence_id")
            .agg(F.sum("length").alias("n_ids"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", "n_ids", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")))

"""Reproducible shuffle into shards by a Feistel permutation (native functions only).

Rows get global numbers 0..n-1 in (doc_id, text) order; a keyed Feistel network permutes the
numbers; number p goes to shard ``p mod shards``, slot ``p div shards``.  So shard sizes differ by
at most one row (law ``rows``), slots are gapless, and shard and slot of any row number can be
computed without looking at other rows.

The network works on Z_a x Z_b with a*b >= n: each round adds a keyed hash of one half to the other
half, which is a bijection whatever the hash.  Results >= n are fed in again (cycle walking) until
they are < n; a walk visits each of the a*b - n surplus numbers once at most.

Equal texts are not kept together: the law fixes counts, not groups.

Defined results: a null or empty text has size 1 and the crc32 of no bytes; long texts only give their size and
crc32; repeated rows are numbered each; null doc_ids are numbered first;
rows equal in doc_id and text are interchangeable, so whichever is first takes the lower number; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import positions
from .common import text_bytes, written

ROUNDS = 4
MAX_WALK = 64


def halves(n: int) -> tuple[int, int]:
    """Sides a, b of the domain: a*b >= n with fewer than a numbers to spare."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def feistel(x: Column, n: int, seed: int) -> Column:
    """One application of the network to 0 <= x < a*b."""
    a, b = halves(n)
    right = F.pmod(x, F.lit(b))
    left = F.call_function("div", x, F.lit(b))
    for k in range(ROUNDS):
        if k % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(k)), F.lit(a)), F.lit(a))
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(k)), F.lit(b)), F.lit(b))
    return left * F.lit(b) + right


def permuted(x: Column, n: int, seed: int) -> Column:
    """The permutation of 0..n-1: the network with cycle walking.

    The surplus is below sqrt(n)+1 of n numbers, so a step stays outside with a chance of 1/sqrt(n);
    up to ``MAX_WALK``² rows the walk limit is the surplus itself, beyond that a longer walk has a
    chance of n / sqrt(n)**MAX_WALK and raises (choose another seed) rather than give a wrong slot.
    """
    a, b = halves(n)
    surplus = a * b - n
    first = feistel(x, n, seed)
    if surplus == 0:
        return first
    steps = F.sequence(F.lit(1), F.lit(min(surplus, MAX_WALK)))
    walked = F.aggregate(steps, first, lambda p, _: F.when(p < n, p).otherwise(feistel(p, n, seed)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk too long: choose another seed")))


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 7) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard and slot of every row of ``docs``."""
    # _row only spreads rows that are equal in every other column
    narrow = written(docs.select(F.col("doc_id").alias("doc_id"),
                                 (F.octet_length(text_bytes()) + F.lit(1)).cast("long").alias("size"),
                                 F.crc32(text_bytes()).alias("text_crc32"),
                                 F.monotonically_increasing_id().alias("_row")), "shard-rows")
    n = narrow.count()
    numbered = positions(narrow, ["doc_id", "text_crc32", "size", "_row"], pos_col="_pos")
    p = permuted(F.col("_pos") - 1, n, seed)
    return (numbered.withColumn("_p", p)
            .select("doc_id", "size", "text_crc32", (F.col("_pos") - 1).alias("row_number"),
                    F.pmod(F.col("_p"), F.lit(shards)).cast("int").alias("shard"),
                    F.call_function("div", F.col("_p"), F.lit(shards)).alias("slot")))

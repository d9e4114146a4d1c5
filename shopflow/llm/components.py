"""Connected components of an edge table by random contraction; all state lives in written tables.

Each round every node points to the neighbour (or itself) of smallest keyed hash, and the edges are
rewritten between the pointed-to nodes.  Under fresh random order the nodes that are left shrink by
a constant factor a round, whatever the shape of the graph (chains included), so the number of
rounds is logarithmic.  Afterwards the pointers are followed back, last round first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (columns a, b of one type); all nodes of a component
    share the root, which is one of them.  Loops (a = b) and repeated edges are allowed."""
    rounds = []
    edges = written(edges.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "edges")
    while not edges.isEmpty():
        seed = F.lit(len(rounds))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def rank(c: str, seed=seed):
            return F.struct(F.xxhash64(F.col(c), seed).alias("h"), F.col(c).alias("node"))

        best = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("node"), F.least(F.col("m"), rank("a"))["node"].alias("to"))
        pointers = written(best, "pointers")
        rounds.append(pointers)
        left = pointers.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = pointers.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        edges = written(edges.join(left, "a").join(right, "b").where(F.col("ta") != F.col("tb"))
                        .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[-1].select("node", F.col("to").alias("root"))
    for pointers in reversed(rounds[:-1]):
        later = roots.select(F.col("node").alias("to"), "root")
        roots = written(pointers.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root")),
                        "roots")
    return roots

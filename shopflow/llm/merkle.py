"""Merkle manifest of a dataset: content-addressed records, proofs by descent from the root.

Build.  Every row is a leaf digest.  The leaves of a source, in doc_id order, are hashed in runs of
``FAN`` until one node (the source's subroot) is left, and the subroots in source order likewise until the
root is left.  What is stored are records digest -> children, one for each distinct digest whatever
tree it occurs in: two nodes with one digest have the same children.

Prove.  A request names a source and a leaf's rank in it.  Requests descend from the root: at each
level the digit of the rank (base ``FAN``) selects one child of the record, the unselected children are
collected as one path segment (left of the selected child, right of it), and the selected digest is
looked up next.  Requests that share a path descend once: the frontier of a level has one row for each
node, and only the last step has one for each leaf.  The finished path is reversed, leaf first.  A level
whose run has one node gives an empty segment.

Every level is a join on digests and every rank comes from range blocks, so a source that holds a third
of the rows is spread like any other; a node has at most ``FAN`` children; the driver reads the root and
the distinct tree heights (at most 16).

Defined results: a null field of a leaf is ``-``, any other its byte count, a colon and its value; an
empty text is ``0:``; texts are hashed whole, however long; null doc_ids come first in their source and
the null source first of all; rows equal in source and doc_id are ordered by leaf digest, and equal
leaves are interchangeable (each keeps a place and a proof of its own); an empty table has no root and gives no
rows; columns that are not leaf fields are carried along whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import positions
from .common import written

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<left:string,right:string>>"


def field_text(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (lowercase hex) of the values in order, each with its length in front."""
    return F.sha2(F.concat(*[field_text(v) for v in values]), 256)


@dataclass
class Manifest:
    """``records`` (digest, children), ``sources`` (tree, place, n, height, subroot), ``leaves`` (tree, rank,
    leaf and the carried columns as ``row``), all written tables; ``root`` is None for an empty table."""

    records: DataFrame
    sources: DataFrame
    leaves: DataFrame
    root: str | None
    top_height: int


def height(n: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def _height(n: Column) -> Column:
    """``height`` as a column: powers of ``FAN`` below n (n <= 16**15)."""
    powers = F.array(*[F.lit(FAN ** k) for k in range(15)])
    return F.size(F.filter(powers, lambda p: p < n)).cast("int")


def _reduce(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Hash the nodes (tree, rank, digest, n = nodes of that tree) level by level until each tree has one.

    Returns the node tables of all levels above and (tree, digest) of the roots.
    """
    tables, ends = [], [nodes.where("n = 1").select("tree", "digest")]
    for _ in range(levels):
        runs = (nodes.where("n > 1")
                .groupBy("tree", F.call_function("div", F.col("rank"), F.lit(FAN)).alias("rank"))
                .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("run"), F.max("n").alias("n")))
        children = runs.select("tree", "rank", F.transform("run", lambda c: c["digest"]).alias("children"),
                               F.ceil(F.col("n") / F.lit(FAN)).cast("long").alias("n"))
        nodes = written(children.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), "merkle-nodes")
        tables.append(nodes)
        ends.append(nodes.where("n = 1").select("tree", "digest"))
    roots = ends[0]
    for more in ends[1:]:
        roots = roots.unionByName(more)
    return tables, roots


def build(rows: DataFrame, leaf: Column, source: str = "source", order: str = "doc_id") -> Manifest:
    """The manifest of ``rows``: ``leaf`` is the digest column, all columns of ``rows`` are carried."""
    # a tree's key keeps the order of the sources, null first
    tree = F.coalesce(F.concat(F.lit("1"), F.col(f"`{source}`").cast("string")), F.lit("0"))
    keyed = rows.select(tree.alias("tree"), F.col(f"`{order}`").alias("place"), leaf.alias("leaf"),
                        F.struct(*[F.col(f"`{c}`").alias(c) for c in rows.columns]).alias("row"))
    placed = written(positions(keyed, ["tree", "place", "leaf"], pos_col="at"), "merkle-places")
    sizes = positions(placed.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first")),
                      ["tree"], pos_col="place")
    sizes = written(sizes.select("tree", "n", "first", (F.col("place") - 1).alias("place"), _height(F.col("n")).alias("height")),
                    "merkle-sizes")
    # a second key over the (small) sizes: the tree of a third of all rows can be split by AQE
    near = sizes.select(F.col("tree").alias("_t"), F.xxhash64("tree").alias("_h"), "n", "first")
    leaves = written(placed.join(near, (F.col("tree") == F.col("_t")) & (F.xxhash64("tree") == F.col("_h")))
                     .select("tree", (F.col("at") - F.col("first")).alias("rank"), "n", "leaf", "row"), "merkle-leaves")
    shape = sizes.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("trees")).first()
    if not shape.trees:
        empty = leaves.select(F.col("leaf").alias("digest"), F.array("leaf").alias("children"))
        return Manifest(empty, sizes.withColumn("subroot", F.lit(None).cast("string")), leaves, None, 0)
    below, subroots = _reduce(leaves.select("tree", "rank", F.col("leaf").alias("digest"), "n"), height(shape.most))
    sources = written(sizes.join(subroots.withColumnRenamed("digest", "subroot"), "tree"), "merkle-sources")
    tops = sources.select(F.lit("").alias("tree"), F.col("place").alias("rank"), F.col("subroot").alias("digest"),
                          F.lit(shape.trees).alias("n"))
    above, root = _reduce(tops, height(shape.trees))
    nodes = [t.select("digest", "children") for t in below + above]
    records = nodes[0] if nodes else tops.select("digest", F.array("digest").alias("children")).limit(0)
    for more in nodes[1:]:
        records = records.unionByName(more)
    records = written(records.groupBy("digest").agg(F.any_value("children").alias("children")), "merkle-records")
    return Manifest(records, sources, leaves, root.first().digest, height(shape.trees))


def _segment(children: Column, digit: Column) -> Column:
    """The unselected children: those left of the selected one and those right of it."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
                    F.array_join(F.slice(children, digit + 2, F.lit(FAN)), "").alias("right"))


def _down(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """One level down: every child of the frontier's nodes with the path that leads to it."""
    children = F.posexplode("children").alias("digit", "child")
    rest = [c for c in frontier.columns if c not in ("rank", "digest", "path")]
    return (frontier.join(records, "digest").select("*", children)
            .select(*rest, (F.col("rank") * FAN + F.col("digit")).alias("rank"), F.col("child").alias("digest"),
                    F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path")))


def _asked(frontier: DataFrame, requests: DataFrame | None, levels: int) -> DataFrame:
    """The nodes ``levels`` above their leaves that some request passes."""
    if requests is None:
        return frontier
    step = F.lit(FAN ** levels)
    wanted = requests.select("tree", F.call_function("div", F.col("rank"), step).alias("rank")).distinct()
    return frontier.join(wanted, ["tree", "rank"], "left_semi")


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """subroot, path (leaf first) and row of every leaf, or of the leaves at the (tree, rank) of ``requests``."""
    leaves, records, sources = manifest.leaves, manifest.records, manifest.sources
    out_columns = ["tree", "rank", "leaf", "subroot", "path", "row"]
    if manifest.root is None:
        return leaves.select("tree", "rank", "leaf", F.lit(None).cast("string").alias("subroot"),
                             F.array().cast(SEGMENT).alias("path"), "row")
    if requests is not None:
        leaves = leaves.join(requests.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")
        sources = sources.join(requests.select("tree").distinct(), "tree", "left_semi")
    spark = records.sparkSession
    top = spark.range(1).select(F.lit(0).cast("long").alias("rank"), F.lit(manifest.root).alias("digest"),
                                F.array().cast(SEGMENT).alias("path"))
    for _ in range(manifest.top_height):
        top = _down(top, records)
    starts = written(top.withColumnRenamed("rank", "place").join(sources, "place")
                     .select("tree", "height", "subroot", F.lit(0).cast("long").alias("rank"), "digest", "path"),
                     "merkle-starts")
    parts = []
    for (tall,) in sorted(starts.select("height").distinct().collect()):
        frontier = starts.where(F.col("height") == tall).drop("height")
        for level in range(tall - 1):
            frontier = _asked(_down(frontier, records), requests, tall - 1 - level)
        if tall:
            frontier = frontier.join(records, "digest").withColumnRenamed("rank", "node")
            digit = F.pmod(F.col("rank"), F.lit(FAN)).cast("int")
            met = leaves.withColumn("node", F.call_function("div", F.col("rank"), F.lit(FAN))).join(
                frontier, ["tree", "node"])
            # the record must hold the leaf at the place where the request's last digit points
            met = met.withColumn("path", F.when(
                F.element_at("children", digit + 1) == F.col("leaf"),
                F.concat("path", F.array(_segment(F.col("children"), digit)))).otherwise(
                    F.raise_error(F.lit("manifest and leaves disagree")).cast(SEGMENT)))
        else:
            met = leaves.join(frontier.drop("rank"), "tree")
        parts.append(met.withColumn("path", F.reverse("path")).select(out_columns))
    out = parts[0] if parts else leaves.limit(0).select(
        "tree", "rank", "leaf", F.lit(None).cast("string").alias("subroot"), F.array().cast(SEGMENT).alias("path"), "row")
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))

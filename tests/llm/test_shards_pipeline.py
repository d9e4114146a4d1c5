"""Sharding, the corpus pipeline, and that the operators' packages stand alone."""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shopflow.llm import shards
from shopflow.llm.common import documents

from test_llm_common import edge_docs, empty_docs


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 5, 8, 17, 100, 4097, 50021):
        for seed in (0, 9):
            got = [r[0] for r in spark.range(n).select(shards.permuted(F.col("id"), n, seed)).collect()]
            assert sorted(got) == list(range(n))
    a, b = ([r[0] for r in spark.range(1000).select(shards.permuted(F.col("id"), 1000, s)).collect()] for s in (1, 2))
    assert a != b and a != list(range(1000))


def test_network_is_a_bijection_of_its_domain(spark):
    for n in (1, 2, 7, 90, 1000):
        a, b = shards.halves(n)
        assert n <= a * b < n + a
        got = [r[0] for r in spark.range(a * b).select(shards.feistel(F.col("id"), n, 3)).collect()]
        assert sorted(got) == list(range(a * b))


def test_shards_law_and_slots(spark):
    for docs in (edge_docs(spark), documents(spark, SF_SMALL)):
        rows = docs.collect()
        for k in (1, 8):
            got = shards.shard_rows(docs, shards=k).toPandas()
            sizes = got["shard"].value_counts().reindex(range(k), fill_value=0)
            assert len(got) == len(rows) and sizes.max() - sizes.min() <= 1
            for _, g in got.groupby("shard"):
                assert sorted(g["slot"]) == list(range(len(g)))
            want = sorted([(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows], key=str)
            mine = [(None if pd.isna(i) else int(i), int(s), int(c)) for i, s, c in zip(got["doc_id"], got["size"], got["text_crc32"], strict=True)]
            assert sorted(mine, key=str) == want
    assert shards.shard_rows(empty_docs(spark)).count() == 0


def test_shards_do_not_depend_on_layout(spark):
    docs = documents(spark, SF_SMALL)
    a = {tuple(r) for r in shards.shard_rows(docs).collect()}
    assert a == {tuple(r) for r in shards.shard_rows(docs.repartition(7)).collect()}
    assert a != {tuple(r) for r in shards.shard_rows(docs, seed=8).collect()}


def test_pipeline_equals_stage_by_stage_reference(spark):
    import corpus_pipeline as P
    from shopflow.llm import quality, toxicity
    from shopflow.llm.common import labels

    sf = "/root/testdata/sf0.01"
    docs = documents(spark, sf)
    rows = docs.toPandas().set_index("doc_id")
    names = [n for n, _ in P.STAGES]
    assert names == ["quality", "toxicity", "exact_dedup", "simhash_near_dedup", "packing"] and P.ORACLE_SQL is None
    q = quality.fit(docs, labels(spark, sf)).with_score(docs, into="q").select("doc_id", "q")
    t = toxicity.with_segments(docs, toxicity.fit(docs, labels(spark, sf)), into="t").select("doc_id", F.col("t.score").alias("t"))
    scores = q.join(t, "doc_id").toPandas().set_index("doc_id").reindex(rows.index)
    left = rows[(scores["q"] >= P.MIN_QUALITY) & (scores["t"] < P.TOXIC)]
    norm = left["text"].fillna("").str.replace(r"[\x20\x09-\x0D]+", " ", regex=True)
    left = left[norm.groupby(norm).transform(lambda g: g.index.min()) == norm.index]
    from shopflow.llm.simhash import fingerprint
    fps = np.array([fingerprint((x or "").encode()) for x in left["text"]], dtype=np.uint64)
    ids = left.index.to_numpy()
    root = ids.copy()
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    while True:
        new = np.where(near, root[None, :], ids.max()).min(axis=1)
        if (new == root).all():
            break
        root = new
    kept = set(ids[root == ids].tolist())
    got = P.run(spark, sf).toPandas()
    assert set(got["doc_id"]) == kept
    whole = got.groupby("doc_id").agg(n=("length", "sum"), total=("doc_tokens", "first"))
    assert (whole["n"] == whole["total"]).all()


def test_pipeline_stages_on_edge_rows(spark):
    import corpus_pipeline as P

    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, stage in P.STAGES:
            out = stage(spark, docs, "/root/testdata/sf0.01")
            assert out.count() <= docs.count() or name == "packing"
            if name != "packing":
                assert out.columns == docs.columns


def test_nothing_else_imports_the_subpackage():
    import re
    from pathlib import Path

    package = Path(shards.__file__).resolve().parent.parent
    for source in package.rglob("*.py"):
        if "llm" not in source.relative_to(package).parts:
            assert not re.search(r"\bllm\b", source.read_text()), source

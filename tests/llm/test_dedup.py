"""Exact, fingerprint and embedding deduplication against brute force."""

import hashlib
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shopflow.llm import exact_dedup, near_vectors, simhash
from shopflow.session import scratch_path

from test_llm_common import edge_docs, empty_docs


def _stored(df, name, files=1):
    path = scratch_path(df.sparkSession, name)
    df.repartition(files).write.parquet(path)
    return path


def _exact_reference(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup_edges(spark, weak):
    docs = edge_docs(spark)
    path = _stored(docs, "edge-docs", files=3)
    digest = (lambda t: F.pmod(F.crc32(F.encode(t, "UTF-8")), F.lit(2)).cast("string")) if weak else exact_dedup.sha256_digest
    got = exact_dedup.exact_dedup(spark, path, digest=digest, max_files_per_trigger=1).collect()
    want = _exact_reference([(r.doc_id, r.text) for r in docs.collect()])
    cut = (lambda r: r[:3]) if weak else (lambda r: r)
    assert sorted([cut((r.doc_id, r.keep_id, r.group_size, r.digest)) for r in got], key=str) == sorted(map(cut, want), key=str)
    assert sum(r.kept for r in got) == len({r[3] for r in want})  # one row of each class stays, repeated ids included


def test_exact_dedup_state_survives_between_runs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path, ckpt = scratch_path(spark, "dedup-in"), scratch_path(spark, "dedup-ckpt")
    docs.where("doc_id % 2 = 1").write.mode("append").parquet(path)
    exact_dedup.exact_dedup(spark, path, ckpt).count()
    docs.where("doc_id % 2 = 0").write.mode("append").parquet(path)  # smaller ids arrive later and take over
    got = exact_dedup.exact_dedup(spark, path, ckpt).collect()
    want = _exact_reference([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.digest) for r in got], key=str) == want


def test_dedup_frame_keeps_all_columns(spark):
    docs = edge_docs(spark)
    out = exact_dedup.dedup_frame(docs)
    assert out.columns == docs.columns
    assert sorted(r.text or "" for r in out.select(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ").alias("text"))
                  .distinct().collect()) == sorted({re.sub(r"\s+", " ", r.text or "") for r in docs.collect()})
    assert out.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in docs.collect()})
    assert exact_dedup.dedup_frame(empty_docs(spark)).count() == 0


def _fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def _linked(items, linked):
    """Class of each item by brute force over all pairs."""
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def _check_simhash(docs, got):
    rows = docs.collect()
    fps = [_fingerprint(r.text) for r in rows]
    roots = _linked(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    smallest = {}
    for r, root in zip(rows, roots, strict=True):
        if r.doc_id is not None:
            smallest[root] = min(smallest.get(root, r.doc_id), r.doc_id)
    want = sorted([(r.doc_id, f - (1 << 64) if f >= 1 << 63 else f, smallest.get(root))
                   for r, f, root in zip(rows, fps, roots, strict=True)], key=str)
    assert sorted([(r.doc_id, r.fp, r.component_id) for r in got], key=str) == want


def test_simhash_equals_brute_force(spark):
    for docs in (edge_docs(spark), spark.read.parquet(f"{SF_SMALL}/documents.parquet")):
        _check_simhash(docs, simhash.near_duplicates(docs).collect())
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def test_fingerprint_in_parts_equals_whole(monkeypatch):
    text = (" ".join(f"w{i % 97} x{i}" for i in range(700))).encode()
    want = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PART_SHINGLES", 50)
    assert simhash.fingerprint(text) == want == _fingerprint(text.decode())


def test_fingerprint_links_in_crowded_cells(spark, monkeypatch):
    """Near copies of a few fingerprints (chains included) and random ones, with any number of bit groups."""
    rng = np.random.default_rng(1)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 60, dtype=np.uint64)]
    for centre in (fps[0], 0, (1 << 64) - 1):
        walk = centre
        for _ in range(150):
            for b in rng.integers(0, 64, rng.integers(1, 4)):
                walk ^= 1 << int(b)
            fps.append(walk if rng.random() < 0.5 else centre ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    want = _linked(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for rows in (64, 0.001):
        monkeypatch.setattr(simhash, "block_masks", simhash.block_masks if rows == 64 else lambda n, m: _wide_masks(m))
        monkeypatch.setattr(simhash, "CHUNK", 16)
        links = simhash.fingerprint_links(df, 4).toPandas()
        place = {s: i for i, s in enumerate(signed)}
        pairs = {(place[a], place[b]) for a, b in zip(links["a"], links["b"], strict=True)}
        assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in pairs)
        got = pd.Series(_linked(list(range(len(fps))), lambda i, j: (i, j) in pairs or (j, i) in pairs))
        assert (got.groupby(want).nunique() == 1).all() and got.nunique() == len(set(want))


def _linked_by_scan(fps):
    """All pairs at most four bits apart, found by comparing every fingerprint with every other."""
    a, b = [], []
    for i in range(0, len(fps), 512):
        x, y = np.nonzero(np.bitwise_count(fps[i: i + 512, None] ^ fps[None, :]) <= 4)
        a, b = a + [x[x + i < y] + i], b + [y[x + i < y]]
    return np.concatenate(a), np.concatenate(b)


def _classes(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def test_unrelated_fingerprints_in_one_cell(spark):
    """Twenty thousand fingerprints that share a whole bit group, with planted near pairs and a tight cluster."""
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 50, 20000, dtype=np.uint64) | np.uint64(0x2AAA << 50)
    flips = np.uint64(1) << rng.integers(0, 50, (300, 4), dtype=np.uint64)
    near = fps[:300] ^ np.bitwise_xor.reduce(flips, axis=1)
    cluster = fps[0] ^ np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 50, (6000, 2), dtype=np.uint64), axis=1)
    fps = np.unique(np.concatenate([fps, near, cluster]))
    df = spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)}))
    links = simhash.fingerprint_links(df, 4).toPandas()
    a, b = (np.searchsorted(fps, links[c].to_numpy().view(np.uint64)) for c in ("a", "b"))
    assert (np.bitwise_count(fps[a] ^ fps[b]) <= 4).all()
    got = _classes(len(fps), zip(a.tolist(), b.tolist(), strict=True))
    want = _classes(len(fps), zip(*(v.tolist() for v in _linked_by_scan(fps)), strict=True))
    pairs = pd.DataFrame({"got": got, "want": want}).drop_duplicates()
    assert pairs["got"].is_unique and pairs["want"].is_unique and len(pairs) < len(fps) - 1000


def test_crowded_cells_are_cut_until_they_are_small(spark, monkeypatch):
    rng = np.random.default_rng(4)
    fps = np.unique(rng.integers(0, 1 << 20, 3000, dtype=np.uint64)).view(np.int64)
    monkeypatch.setattr(simhash, "LARGE", 100)
    rows = simhash.pivot_rows(spark.createDataFrame(pd.DataFrame({"fp": fps})))
    high = simhash._signed(((1 << 44) - 1) << 20)  # the group that all share
    cells = rows.selectExpr(f"{high}L as mask", f"fp & {high}L as cell", "fp", "p0", "p1")
    sizes = simhash.split_crowded(cells, 4).groupBy("mask", "cell").count().toPandas()
    assert sizes["count"].max() <= 100 and sizes["mask"].nunique() >= 5
    for mask in (0, (1 << 30) - 1, (1 << 58) - 1):
        finer = simhash.finer_masks(mask, 4)
        assert len(finer) == 5 and all(f & mask == mask and f != mask for f in finer)
        assert sum(f ^ mask for f in finer) == simhash.ALL_BITS ^ mask  # the groups part the free bits


def _wide_masks(max_bits):
    """The masks of a table too large for five groups: seven groups, three of them agree."""
    import itertools
    edges = [64 * i // 7 for i in range(8)]
    groups = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(groups, 7 - max_bits)]


def test_block_masks_grow_with_the_table():
    assert len(simhash.block_masks(1000, 4)) == 5
    assert len(simhash.block_masks(10 ** 7, 4)) == 15 and len(simhash.block_masks(10 ** 9, 4)) == 35
    assert simhash.block_masks(10 ** 7, 4) and all(0 < m < 1 << 64 for m in simhash.block_masks(10 ** 7, 4))


def test_keep_first(spark):
    docs = edge_docs(spark)
    out = simhash.keep_first(docs)
    assert out.columns == docs.columns
    rows = docs.collect()
    roots = _linked([_fingerprint(r.text) for r in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    assert out.count() == len(set(roots))
    assert simhash.keep_first(empty_docs(spark)).count() == 0


def _vector_reference(ids, vectors, cosine):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = unit @ unit.T >= cosine
    np.fill_diagonal(links, False)
    roots = np.arange(len(ids))
    while True:
        low = np.where(links, roots[None, :], len(ids)).min(axis=1, initial=len(ids))
        new = np.minimum(roots, low)
        if (new == roots).all():
            break
        roots = new
    smallest = pd.Series(ids).groupby(roots).transform("min").tolist()
    return links.sum(axis=1).tolist(), smallest


@pytest.mark.parametrize("dim", [2, 5, 24])
def test_vectors_equal_brute_force(spark, monkeypatch, dim):
    rng = np.random.default_rng(dim)
    m = rng.normal(size=(900, dim))
    m[300:500] = m[0] + rng.normal(size=(200, dim)) * 0.1  # a dense place
    m[500:560] = m[3]  # equal vectors
    m[560:600] = m[4] * rng.uniform(0.5, 3, (40, 1))  # equal directions
    m[600:640] = m[5] + rng.normal(size=(40, dim)) * 0.3  # a loose place that spreads over blocks
    for name, value in (("BLOCK", 150), ("TILE", 64), ("SAMPLE", 300)):
        monkeypatch.setattr(near_vectors, name, value)
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(900) * 3, "embedding": m.tolist(), "label": 1, "node": "x"}))
    got = near_vectors.near_duplicate_vectors(df).toPandas().sort_values("vec_id")
    n_links, component = _vector_reference(np.arange(900) * 3, m, 0.9)
    assert got["n_links"].tolist() == n_links and got["component_id"].tolist() == component


def test_vectors_edges(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [1.0, 1.0]), (6, [1.0, 1.0, 1.0]),
            (None, [1.0, 1.0]), (7, []), (8, [float("inf"), 1.0]), (5, [1.0, 1.0]), (9, [1e300, 1e300]), (10, [-1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in near_vectors.near_duplicate_vectors(df).collect()), key=str)
    linked = [(5, 3, 5), (5, 3, 5), (9, 3, 5), (None, 3, 5)]
    assert got == sorted(linked + [(i, 0, i) for i in (1, 2, 3, 4, 6, 7, 8, 10)], key=str)
    assert near_vectors.near_duplicate_vectors(df.limit(0)).count() == 0


def test_partition_never_separates_linked_vectors():
    """Every linked pair meets: in one ball or cell, or by a copy of one in the other's place."""
    rng = np.random.default_rng(0)
    x = near_vectors.unit(np.concatenate([rng.normal(size=(300, 6)), rng.normal(size=(1, 6)) + rng.normal(size=(150, 6)) * 0.1]))
    r = np.sqrt(0.2)
    part = near_vectors.Partition(*near_vectors.choose_pivots(x[::2], 16384 * 6, r), r)
    home, far, d = part.home(x)
    radius = np.full(len(part.pivots), -1.0)
    np.maximum.at(radius, home, far)
    copied = part.copies(home, d, radius)
    linked = x @ x.T >= 0.9
    meet = (home[:, None] == home[None, :]) | copied[:, home] | copied[:, home].T
    assert part.n_balls >= 1 and (meet | ~linked).all()
    inside = home < part.n_balls
    same_ball = (home[:, None] == home[None, :]) & inside[:, None]
    assert linked[same_ball].all()


@pytest.mark.parametrize("name", ["op1_embedding_near_dedup", "op5_exact_dedup"])
def test_queries_equal_their_statements(spark, name):
    import duckdb

    from shopflow.llm import queries

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.all_queries()[name](spark, SF_SMALL)
    got = con.execute(queries.statements()[name])
    columns = [d[0] for d in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == sorted(got.fetchall())

"""The registered query of each operator (``opN_<name>``) and its DuckDB statement where SQL can say it.

Every query reads its whole table with production parameters.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe as _bpe
from . import exact_dedup as _exact
from . import fill_middle as _fim
from . import license_scan as _license
from . import merkle as _merkle
from . import near_vectors as _vectors
from . import packing as _packing
from . import quality as _quality
from . import shards as _shards
from . import simhash as _simhash
from . import token_counts as _counts
from . import token_files as _files
from . import toxicity as _toxicity
from .common import documents, fold, labels
from .tokens import vocabulary_path


def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(_path(sf_dir, "embeddings"))
    rows = _vectors.near_duplicate_vectors(vectors, cosine=0.9)
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
          ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
c AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(c.b, vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bpe.digests(_bpe.encode(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = _toxicity.fit(docs, labels(spark, sf_dir), fold_of=3, held_out=1)
    scored = _toxicity.with_segments(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"),
                         F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= 0.7).cast("int").alias("predicted"),
                         F.size("toxicity.segments").alias("n_segments"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = _quality.fit(docs, labels(spark, sf_dir), fold_of=4, held_out=2)
    scored = model.with_score(docs.select("doc_id", "text"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _exact.exact_dedup(spark, _path(sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


OP5_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    _files.write_token_files(documents(spark, sf_dir), path, vocabulary_path("byte_bpe_50k.json"), end_id=0)
    return _files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _shards.shard_rows(documents(spark, sf_dir), shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packing.pack(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"), end_id=1, capacity=2048)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts.section_token_counts(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves and the manifest, then every leaf's proof by descent, checked against a possibly tampered row."""
    doc = {c: F.col(c) for c in _merkle.FIELDS}
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    rows = documents(spark, sf_dir).select(
        "doc_id", "source", _merkle.leaf_digest(list(doc.values())).alias("leaf"),
        F.when(changed & F.col("text").isNotNull(),
               _merkle.leaf_digest(list((doc | {"text": lowered}).values()))).alias("tampered"))
    manifest = _merkle.build(rows, F.col("leaf"))
    proofs = _merkle.prove(manifest)
    root = F.lit(manifest.root)
    return (proofs.select(
        F.col("row.doc_id").alias("doc_id"), "leaf", "subroot", root.alias("root"),
        _merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        _merkle.folded(F.coalesce("row.tampered", "leaf"), F.col("path")).alias("folded_root"))
        .withColumn("verified", F.col("folded_root") == F.col("root")))


def _op11_sql(levels: int = 10, top_levels: int = 6) -> str:
    """Trees of up to 16**levels leaves a source and 16**top_levels sources, one CTE a level."""
    fields = lambda text: " || ".join(
        f"coalesce(octet_length(encode(({c})::VARCHAR))::VARCHAR || ':' || ({c})::VARCHAR, '-')"
        for c in ("doc_id", "source", "lang", "n_chars", text))
    byte_step = ("list_reduce(list_prepend(x, range(8)), lambda c, k: "
                 "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)")
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)), "
           "lambda i: ascii(substr(doc_id::VARCHAR, i::INT + 1, 1))::BIGINT)), lambda c, b: "
           f"xor(c >> 8, list_extract(l, 1 + (xor(c, b) & 255)))))")
    ctes = [f"crc AS (SELECT list(v ORDER BY x) AS l FROM (SELECT x, {byte_step} AS v FROM range(256) t(x)))",
            f"""leaves AS (SELECT doc_id, source, sha256({fields('text')}) AS leaf, CASE WHEN {crc} % 5 = 0
  THEN sha256({fields("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS tampered
  FROM documents CROSS JOIN crc)""",
            """n0 AS (SELECT *, leaf AS d, coalesce('1' || source, '0') AS s, row_number() OVER w - 1 AS r, count(*) OVER
  (PARTITION BY source) AS m FROM leaves WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf))"""]
    step = """{to} AS (SELECT s, r // 16 AS r, CASE WHEN m > 1 THEN sha256(string_agg(d, '' ORDER BY r)) ELSE max(d) END AS d,
  list(d ORDER BY r) AS kids, m AS was, (m + 15) // 16 AS m FROM {of} GROUP BY s, r // 16, m)"""
    ctes += [step.format(to=f"n{k + 1}", of=f"n{k}") for k in range(levels)]
    ctes.append(f"t0 AS (SELECT '' AS s, s AS tree, d, row_number() OVER (ORDER BY s) - 1 AS r, count(*) OVER () AS m FROM n{levels})")
    ctes += [step.format(to=f"t{k + 1}", of=f"t{k}") for k in range(top_levels)]
    joins, sides = [], []
    for k in range(levels):
        joins.append(f"JOIN n{k + 1} a{k} ON a{k}.s = l.s AND a{k}.r = l.r // {16 ** (k + 1)}")
        sides.append((f"a{k}", f"((l.r // {16 ** k}) % 16)"))
    for k in range(top_levels):
        joins.append(f"JOIN t{k + 1} b{k} ON b{k}.r = top.r // {16 ** (k + 1)}")
        sides.append((f"b{k}", f"((top.r // {16 ** k}) % 16)"))
    path = ", ".join(
        f"CASE WHEN {a}.was > 1 THEN {{'l': array_to_string({a}.kids[1:{i}], ''), 'r': array_to_string({a}.kids[{i} + 2:], '')}} END"
        for a, i in sides)
    return f"""
WITH {", ".join(ctes)},
p AS (SELECT l.doc_id, l.leaf, coalesce(l.tampered, l.leaf) AS given, top.d AS subroot, t{top_levels}.d AS root,
  list_filter([{path}], lambda x: x IS NOT NULL) AS path
  FROM n0 l JOIN t0 top ON top.tree = l.s {" ".join(joins)} CROSS JOIN t{top_levels}),
f AS (SELECT *, list_reduce(list_prepend({{'l': given, 'r': ''}}, path),
  lambda c, x: {{'l': sha256(x.l || c.l || x.r), 'r': ''}}).l AS folded_root FROM p)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(path, lambda x: x.l || x.r), ''), ''))
  AS proof_sha256, folded_root, folded_root = root AS verified FROM f
"""


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fim.restore(_fim.fill_in_middle(documents(spark, sf_dir)))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units FROM documents),
g AS (SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3,
  ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
  WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM g),
s AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
  array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
         ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM s
"""


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _license.scan(documents(spark, sf_dir).select("doc_id", "text"))
    base, spans = F.col("license.base"), F.col("license.spans")
    starts = F.transform(base, lambda x: x["first"].cast("long"))
    return rows.select("doc_id", F.col("license.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
                       F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                       _license.label_list(base).alias("base_labels"), _license.label_list(base, spans).alias("labels"),
                       _license.score(base, spans).alias("score"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_embedding_near_dedup": op1_embedding_near_dedup,
        "op2_bpe": op2_bpe,
        "op3_toxicity": op3_toxicity,
        "op4_quality": op4_quality,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_token_files": op6_token_files,
        "op7_sharding": op7_sharding,
        "op8_simhash": op8_simhash,
        "op9_packing": op9_packing,
        "op10_token_counts": op10_token_counts,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_license_scan": op13_license_scan,
    }


def statements() -> dict[str, str]:
    return {
        "op1_embedding_near_dedup": OP1_SQL,
        "op5_exact_dedup": OP5_SQL,
        "op11_merkle_manifest": _op11_sql(),
        "op12_fill_in_middle": OP12_SQL,
    }

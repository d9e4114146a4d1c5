"""Merkle manifest, fill-in-middle and license scan against plain versions of their contracts."""

import hashlib
import random
import re
from collections import defaultdict
from re import _parser as sre

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm_common import edge_docs, empty_docs

from shopflow.llm import fill_middle, license_scan, merkle, queries
from shopflow.llm.license_rules import Rule, default_rules


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- Merkle manifest
def plain_leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(digests):
    """The root, and every leaf's siblings as (left, right) pairs, leaf first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i: i + 16])) for i in range(0, len(last), 16)])
    paths = []
    for i in range(len(digests)):
        path = []
        for level in levels[:-1]:
            run = level[i // 16 * 16: i // 16 * 16 + 16]
            path.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1:])))
            i //= 16
        paths.append(path)
    return levels[-1][0], paths


def plain_proofs(rows):
    """(source, doc_id, leaf) -> list of (subroot, path), and the root."""
    trees = defaultdict(list)
    for source, doc_id, leaf in rows:
        trees[source].append((doc_id is not None, doc_id or 0, leaf, doc_id))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subroots, below = [], []
    for s in order:
        leaves = sorted(trees[s], key=lambda t: t[:3])
        subroot, paths = plain_tree([t[2] for t in leaves])
        subroots.append(subroot)
        below.append([(s, t[3], t[2], p) for t, p in zip(leaves, paths, strict=True)])
    root, tops = plain_tree(subroots)
    out = [(s, d, leaf, subroot, path + top) for group, subroot, top in zip(below, subroots, tops, strict=True)
           for s, d, leaf, path in group]
    return root, out


SOURCES = {None: 3, "": 1, "a": 16, "b": 17, "hot": 300, "é": 2} | {f"s{i}": 1 for i in range(20)}


def manifest_rows():
    rows, n = [], 0
    for source, count in SOURCES.items():
        for _ in range(count):
            rows.append((n, source, "en", 3, f"Text {n}", "x", 1))
            n += 1
    rows += [rows[5]] * 40  # repeated rows, more than one run of them
    rows += [(None, "b", None, None, None, None, None), (None, "b", None, None, "", "y", 2), (7, "b", "en", 1, "T", "y", 2)]
    random.Random(3).shuffle(rows)
    return rows


MANIFEST_SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int"


def test_manifest_equals_plain_trees(spark):
    rows = manifest_rows()
    docs = spark.createDataFrame(rows, MANIFEST_SCHEMA)
    m = merkle.build(docs, merkle.leaf_digest([F.col(c) for c in merkle.FIELDS]))
    root, want = plain_proofs([(r[1], r[0], plain_leaf(r[:5])) for r in rows])
    assert m.root == root
    proofs = merkle.prove(m).select(
        F.col("row.source"), F.col("row.doc_id"), "leaf", "subroot", "path", "row", merkle.proof_digest(F.col("path")).alias("proof"),
        merkle.folded(F.col("leaf"), F.col("path")).alias("back"), merkle.folded(F.lit(sha("other")), F.col("path")).alias("forged"))
    got = proofs.collect()
    key = lambda t: (t[0] is not None, t[0] or "", t[1] is not None, t[1] or 0, *t[2:])
    assert sorted([(r.source, r.doc_id, r.leaf, r.subroot, [tuple(s) for s in r.path]) for r in got], key=key) == sorted(want, key=key)
    assert all(r.back == root and r.forged != root for r in got)
    assert all(r.proof == sha("".join(a + b for a, b in r.path)) for r in got)
    assert {r.row.tree for r in got} == {"x", "y", None}  # clashing columns are carried
    # records are content addressed: one for each digest, whose children hash to it
    records = m.records.collect()
    assert len({r.digest for r in records}) == len(records)
    assert all(sha("".join(r.children)) == r.digest and len(r.children) <= 16 for r in records)


def test_requests_descend_alone(spark):
    docs = spark.createDataFrame(manifest_rows(), MANIFEST_SCHEMA)
    m = merkle.build(docs, merkle.leaf_digest([F.col(c) for c in merkle.FIELDS]))
    every = {(r.tree, r["rank"]): (r.leaf, r.path) for r in merkle.prove(m).collect()}
    asked = [("1hot", 0), ("1hot", 299), ("1hot", 17), ("0", 1), ("1s3", 0), ("1hot", 17)]
    got = merkle.prove(m, spark.createDataFrame(asked, "tree string, rank long")).collect()
    assert {(r.tree, r["rank"]): (r.leaf, r.path) for r in got} == {k: every[k] for k in asked}
    assert len(got) == len(set(asked))


@pytest.mark.parametrize("n", [0, 1])
def test_smallest_manifests(spark, n):
    docs = spark.createDataFrame([(5, "s", "en", 1, "x", "t", 0)][:n], MANIFEST_SCHEMA)
    m = merkle.build(docs, merkle.leaf_digest([F.col(c) for c in merkle.FIELDS]))
    leaf = plain_leaf((5, "s", "en", 1, "x"))
    assert m.root == (leaf if n else None)
    rows = merkle.prove(m).withColumn("back", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert [(r.leaf, r.subroot, r.path, r.back) for r in rows] == [(leaf, leaf, [], leaf)] * n


def test_manifest_query_verifies_untouched_rows_only(spark, tmp_path):
    rows = [(i, f"s{i % 3}", "en", 4, None if i == 10 else ("Abc" if i % 2 else "abc")) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    import zlib
    got = queries.op11_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        touched = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and rows[r.doc_id][4] == "Abc"
        assert r.verified == (not touched) and (r.folded_root == r.root) == r.verified
    assert any(not r.verified for r in got)


# ---------------------------------------------------------------- fill in the middle
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[i: i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@given(st.lists(st.sampled_from(["a", "é", "語", "<", ">", "P", "<P", "S>", " ", "\n", "\t", "\x1c", " ", "<M", "word"]), max_size=40),
       st.integers(0, 10 ** 6))
def test_fim_text_and_back(parts, doc_id):
    text = "".join(parts)
    settings = fill_middle.Settings()
    n, form, before, middle, output = fill_middle.transform_text(text.encode(), doc_id, settings)
    assert (n, form, before, middle, output.decode()) == plain_fim(doc_id, text)
    assert fill_middle.restore_text(output, form, settings).decode() == text
    every = fill_middle.Settings(rate=100, spm_rate=doc_id % 2 * 100)
    n, form, _, _, output = fill_middle.transform_text(text.encode(), doc_id, every)
    assert fill_middle.restore_text(output, form, every).decode() == text


def test_fim_rows(spark):
    docs = edge_docs(spark).unionByName(spark.createDataFrame(
        [(20 + k, t) for k, t in enumerate(["<P> a b", "a <M>", " lead and trail ", "é " * 500, "x y z " * 40000])],
        "doc_id long, text string"), allowMissingColumns=True)
    got = fill_middle.restore(fill_middle.fill_in_middle(docs)).collect()
    want = [(i, *plain_fim(i, t), t or "") for i, t in docs.select("doc_id", "text").collect()]
    key = lambda t: tuple((x is not None, x if x is not None else 0) for x in t)
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output.decode(), r.restored.decode()) for r in got],
                  key=key) == sorted(want, key=key)
    assert fill_middle.restore(fill_middle.fill_in_middle(empty_docs(spark))).count() == 0


def test_fim_sentinels_are_checked():
    fill_middle.Settings(prefix=b"<|a|>", suffix=b"<|b|>", middle=b"<|c|>")
    for marks in ((b"aba", b"x", b"y"), (b"a", b"a", b"b"), (b"ab", b"bc", b"d"), (b"ab", b"a", b"c"), (b"", b"a", b"b")):
        with pytest.raises(ValueError):
            fill_middle.Settings(prefix=marks[0], suffix=marks[1], middle=marks[2])


# ---------------------------------------------------------------- license scan
def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_scan(text, rules):
    line = " ".join(plain_words(text))
    found = []
    for i, r in enumerate(rules):
        for m in re.finditer(rf"(?:(?<= )|^)(?:{r.pattern})(?= |$)", line):
            first = line[: m.start()].count(" ")
            found.append((first, first + m[0].count(" "), r.label, r.level, i))
    found.sort(key=lambda x: (x[0], -x[1], x[3], x[4]))
    stay = [x for i, x in enumerate(found) if not any(
        y[0] <= x[0] and y[1] >= x[1] and y[3] <= x[3] for y in found[:i])]
    return len(plain_words(text)), sorted(x for x in found if rules[x[4]].base), sorted(stay)


def sample(pattern, rnd):
    """A random string of a rule's small language."""

    def walk(node):
        out = ""
        for op, arg in node:
            name = str(op)
            if name == "LITERAL":
                out += chr(arg)
            elif name == "MAX_REPEAT":
                low, high, inner = arg
                out += "".join(walk(inner) for _ in range(rnd.randint(low, min(high, low + 3))))
            elif name == "SUBPATTERN":
                out += walk(arg[-1])
            elif name == "BRANCH":
                out += walk(rnd.choice(arg[1]))
            elif name == "IN":
                kind = arg[0]
                out += {"LITERAL": lambda: chr(rnd.choice(arg)[1]),
                        "CATEGORY": lambda: "7" if "DIGIT" in str(kind[1]) and "NOT" not in str(kind[1]) else "word"}[str(kind[0])]()
            else:
                raise AssertionError(name)
        return out

    return walk(sre.parse(pattern))


def test_rules_are_hundreds_and_hold_their_keyword():
    rules, rnd = default_rules(), random.Random(1)
    assert len(rules) > 250 and {r.level for r in rules} == set(license_scan.LEVELS)
    for r in rules:
        for _ in range(30):
            text = sample(r.pattern, rnd)
            assert r.keyword in text.split(), r
            assert " ".join(plain_words(text)) == text, r


def license_texts():
    rnd = random.Random(7)
    rules = default_rules()
    noise = ["the", "license", "MIT", "cc", "by", "gnu", "2", "0", "ünï", "apache", "İ", "K", "public", "general"]
    texts = []
    for r in rules:
        texts.append(" ".join([rnd.choice(noise), sample(r.pattern, rnd).upper(), rnd.choice(noise)]))
    for _ in range(60):
        parts = [sample(rnd.choice(rules).pattern, rnd) if rnd.random() < 0.5 else rnd.choice(noise) for _ in range(30)]
        texts.append("; ".join(parts))
    texts += ["MIT License", "mit license mit license MIT-LICENSE", "Released under the MIT\n\nLicense.", "lİcense", "GPL\x01v3",
              "MITLicense", "the lesser general public license, version 2.1", "mıt license", "licence: cc by-nc 4.0",
              "mit license and apache license " * 900]
    return texts


def test_scan_equals_plain_scan(spark):
    rules = default_rules()
    texts = license_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.license for r in license_scan.scan(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        n, base, stay = plain_scan(text, rules)
        assert got[i].n_words == n, text
        assert sorted(map(tuple, got[i].base)) == base, text
        assert sorted(map(tuple, got[i].spans)) == stay, text


def test_running_maximum_over_many_blocks(spark):
    """Random spans of a toy rule set, several blocks of them in a text."""
    rules = [Rule("abc", 2, "a", "a b c"), Rule("ab", 1, "a", "a b"), Rule("b", 3, "b", "b"), Rule("bcab", 2, "c", "b c a b"),
             Rule("c", 2, "c", "c"), Rule("a", 4, "a", "a", base=True)]
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("abc") for _ in range(n)) for n in (5, 63, 64, 65, 400, 1500)]
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), rules=rules).collect()
    for r in rows:
        _, base, stay = plain_scan(texts[r.i], rules)
        assert sorted(map(tuple, r.license.spans)) == stay and sorted(map(tuple, r.license.base)) == base


def test_scan_edge_rows_and_query(spark, tmp_path):
    docs = edge_docs(spark).withColumn("license", F.lit("kept"))
    rows = license_scan.scan(docs, result="_found").collect()
    assert len(rows) == docs.count() and {r.license for r in rows} == {"kept"}
    assert all(r._found.n_words == len(plain_words(r.text)) and r._found.spans == [] for r in rows)
    assert license_scan.scan(empty_docs(spark)).count() == 0
    texts = [None, "", "--", "Use the MIT license. Not the Apache License!", "GNU Lesser General Public License v2.1"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op13_license_scan(spark, str(tmp_path)).collect()}
    for i in (0, 1, 2):
        assert (got[i].n_words, got[i].n_base, got[i].first_word, got[i].base_labels, got[i].labels, got[i].score) == (0, 0, None, "", "", 0.0)
    assert (got[3].n_base, got[3].first_word, got[3].last_word, got[3].base_labels) == (2, 2, 6, "apache,mit")
    assert got[4].base_labels == "gpl" and got[4].labels == "gpl,lgpl-2.1" and 0.9 < got[4].score < 1
    plan = license_scan.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.replace("ReusedExchange", "")

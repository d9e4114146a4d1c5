"""Token operators against the tokenizers library itself."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shopflow.llm import bpe, cutting_stock, huffman, packing, token_counts, token_files
from shopflow.llm.tokens import byte_bpe, load_tokenizer, vocabulary_path
from shopflow.session import scratch_path

from test_llm_common import edge_docs, empty_docs

BYTE, WORD = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("word_bpe_49k.json")
PIECES = ["ab", "The", "ING", "X.", "é.", "é", "日本", "'s", "'S.", ".", " ", "  ", ", ", "\n", " \n", "1.5", "2,3", "...",
          "&&.", "ß", "Ñ", "<|endoftext|>", "<|STARTOFTEXT|>", "\x1c", "İ", "Σ ", "aΣ.", " ", "lower", "tion"]


def _ids(path, text):
    return load_tokenizer(path).encode(text or "", add_special_tokens=False).ids


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join) | st.text(max_size=60))
def test_byte_encoder_equals_library(text):
    assert byte_bpe(BYTE).encode(text).tolist() == _ids(BYTE, text)


def test_byte_encoder_long_white_runs():
    for text in (" " * 20000 + "x", " \n" * 9000 + "x y", "x" * 30000):
        assert byte_bpe(BYTE).encode(text).tolist() == _ids(BYTE, text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=40).map("".join) | st.text(max_size=60), max_size=5))
def test_run_encoder_equals_library(texts):
    for path in (WORD, BYTE):
        got = bpe.run_encoder(path).encode_all([t.encode("utf-8", "replace") for t in texts])
        for packed, t in zip(got, texts, strict=True):
            assert np.frombuffer(packed, "<u4").tolist() == _ids(path, t.encode("utf-8", "replace").decode())


def test_remembered_runs_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe.RunEncoder(WORD)
    for k in range(20):
        texts = [" ".join(f"w{k}x{i}" for i in range(30)) + " " + "long" * 40]
        assert np.frombuffer(encoder.encode_all([t.encode() for t in texts])[0], "<u4").tolist() == _ids(WORD, texts[0])
        assert len(encoder.known) <= 50 + 31 and not any(len(w) > bpe.LONGEST_RUN for w in encoder.known)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_tree_concatenation_equals_whole(path):
    rnd = random.Random(7)
    encoder = bpe.run_encoder(path)
    for alphabet in (PIECES, [p for p in PIECES if p.strip()], ["a", "b", "ab"], ["'", "s", "!"], ["é", "e", "́"]):
        for _ in range(40):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(30, 400)))
            size = rnd.choice([16, 33, 64, 150])
            leaves = []
            for i in range(0, len(text), size):
                ids, spans = encoder.spans(text[i: i + size])
                leaves.append(bpe.Node(i, min(len(text), i + size), ids, spans + i))
            assert bpe.join_all(encoder, text, leaves).ids.tolist() == _ids(path, text), (size, text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_bpe_query_equals_library(spark, path):
    for docs, leaf in ((edge_docs(spark), 512), (_docs(spark), 1000)):
        got = sorted([tuple(r) for r in bpe.digests(bpe.encode(docs, path, leaf)).collect()], key=str)
        want = []
        for r in docs.collect():
            ids = _ids(path, r.text)
            text = load_tokenizer(path).decode(ids, skip_special_tokens=False)
            want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
        assert got == sorted(want, key=str)
    assert bpe.encode(empty_docs(spark), path).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10 ** 6), min_size=1, max_size=300), st.integers(9, 20))
def test_code_lengths_are_limited_and_complete(counts, bits):
    counts = np.array(counts)
    lengths = huffman.code_lengths(np.arange(len(counts)), counts, bits)
    assert lengths.max() <= bits and (len(counts) == 1 or (0.5 ** lengths).sum() == 1)
    if len(counts) > 1 and bits >= 20:
        import heapq
        heap, cost = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            s = heapq.heappop(heap) + heapq.heappop(heap)
            cost += s
            heapq.heappush(heap, s)
        assert (lengths * counts).sum() >= cost
    order = np.argsort(-counts, kind="stable")
    assert (np.diff(lengths[order]) >= 0).all() or len(set(counts)) < len(counts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=700))
def test_codec_round_trip(ids):
    codec = huffman.Codec(np.arange(61), huffman.code_lengths(np.arange(61), np.arange(1, 62) ** 3))
    payload, checkpoints = codec.encode(np.array(ids, dtype=np.int64))
    assert codec.decode(payload, checkpoints, len(ids)).tolist() == ids
    assert len(checkpoints) == -(-len(ids) // huffman.STRIDE)


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 2000)
    for docs in (edge_docs(spark), _docs(spark)):
        path = scratch_path(spark, "token-files-test")
        token_files.write_token_files(docs, path, BYTE, end_id=0)
        got = token_files.read_token_files(spark, path).collect()
        got.sort(key=lambda r: r.start)
        rows = sorted([(r.doc_id is not None, r.doc_id, [*_ids(BYTE, r.text), 0]) for r in docs.collect()], key=str)
        assert [r.doc_id for r in got] == sorted([r.doc_id for r in docs.collect()], key=lambda i: (i is not None, i or 0))
        assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
        assert sorted([(r.doc_id is not None, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got], key=str) == rows
        assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    path = scratch_path(spark, "token-files-test")
    token_files.write_token_files(empty_docs(spark), path, BYTE, end_id=0)
    assert token_files.read_token_files(spark, path).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 32), min_size=0, max_size=200))
def test_patterns_hold_exactly_the_demand(lengths):
    demand = np.bincount(lengths, minlength=33) if lengths else np.zeros(33, dtype=np.int64)
    patterns = cutting_stock.integer_patterns(demand, 32)
    total = sum((p * n for p, n in patterns), np.zeros(33, dtype=np.int64))
    assert (total == demand).all() and all((p * np.arange(33)).sum() <= 32 for p, _ in patterns)
    bins, least = sum(n for _, n in patterns), -(-sum(lengths) // 32)
    assert least <= bins <= max(least * 2, 1)


def test_best_pattern_is_the_best():
    rng = np.random.default_rng(3)
    for _ in range(30):
        value = np.concatenate([[0], rng.random(12) * (rng.random(12) < 0.5)])
        best = [0.0] * 13
        for c in range(1, 13):
            best[c] = max([best[c - 1]] + [best[c - w] + value[w] for w in range(1, c + 1)])
        pattern = cutting_stock.best_pattern(value, 12)
        assert abs(value @ pattern - best[12]) < 1e-12 and (pattern * np.arange(13)).sum() <= 12


def test_packing(spark):
    for docs, slack in ((edge_docs(spark), 1.6), (_docs(spark), 1.03)):
        cut = packing.cut_table(docs, BYTE, end_id=1, capacity=256)
        assigned = packing.assign(cut, 256)
        got = assigned.toPandas()
        seq = got.sort_values(["sequence_id", "offset"])
        ends = seq.groupby("sequence_id")["length"].cumsum()
        assert (ends - seq["length"] == seq["offset"]).all() and ends.max() <= 256 and (got["length"] > 0).all()
        assert sorted(got["sequence_id"].unique()) == list(range(got["sequence_id"].nunique()))
        assert got["sequence_id"].nunique() <= max(1, slack * got["length"].sum() / 256)
        want = []
        for r in docs.collect():
            ids = np.array([*_ids(BYTE, r.text), 1], "<u4")
            want += [(r.doc_id, s, len(ids[s: s + 256]), zlib.crc32(ids[s: s + 256].tobytes()), len(ids))
                     for s in range(0, len(ids), 256)]
        rows = assigned.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()
        assert sorted([tuple(r) for r in rows], key=str) == sorted(want, key=str)
        joined = packing.sequences(cut, assigned).collect()
        assert sum(r.n_ids for r in joined) == got["length"].sum()
        assert all(len(r.ids) == 2 * r.n_ids for r in joined)
    assert packing.pack(empty_docs(spark), BYTE, 1).count() == 0


@pytest.mark.parametrize("capacity", [1, 5, 100, 131])
def test_packing_any_capacity(spark, capacity):
    docs = edge_docs(spark)
    got = packing.pack(docs, BYTE, 1, capacity).toPandas()
    seq = got.sort_values(["sequence_id", "offset"])
    ends = seq.groupby("sequence_id")["length"].cumsum()
    assert (ends - seq["length"] == seq["offset"]).all() and ends.max() <= capacity
    assert got["length"].sum() == sum(len(_ids(BYTE, r.text)) + 1 for r in docs.collect())
    assert sorted(got["sequence_id"].unique()) == list(range(got["sequence_id"].nunique()))


def test_packing_needs_a_capacity(spark):
    cut = packing.cut_table(edge_docs(spark), BYTE, 1, 8)
    with pytest.raises(ValueError, match="capacity"):
        packing.assign(cut, 0)


def test_few_sequences_on_small_cases():
    """The number of sequences against the best found by trying every way of filling them."""
    rng = np.random.default_rng(5)

    def fewest(sizes, free):
        if not sizes:
            return len(free)
        head, rest = sizes[0], sizes[1:]
        ways = [fewest(rest, [*free[:i], f - head, *free[i + 1:]]) for i, f in enumerate(free)
                if f >= head and f not in free[:i]]
        return min([*ways, fewest(rest, [*free, 10 - head])])

    for _ in range(25):
        sizes = sorted(rng.integers(1, 11, 7).tolist(), reverse=True)
        demand = np.bincount(sizes, minlength=11)
        got = sum(n for _, n in cutting_stock.integer_patterns(demand, 10))
        assert got - fewest(sizes, []) in (0, 1)  # rounding may open one more


def test_other_byte_files_go_through_the_library(tmp_path):
    """A file that is not a plain byte-level BPE is encoded by the tokenizers library alone."""
    import json

    with open(BYTE, encoding="utf-8") as f:
        spec = json.load(f)
    changes = {"prefix": lambda s: s["pre_tokenizer"].update(add_prefix_space=True),
               "lower": lambda s: s.update(normalizer={"type": "Lowercase"})}
    for name, change in changes.items():
        other = json.loads(json.dumps(spec))
        change(other)
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(other), encoding="utf-8")
        encoder = byte_bpe(str(path))
        assert encoder.fast is None and encoder.dtype == "<u2"
        for text in ("hello World", "", "It's 12 \u00e9"):
            assert encoder.encode(text).tolist() == _ids(str(path), text)
        assert encoder.encode("hello World").tolist() != byte_bpe(BYTE).encode("hello World").tolist()
    assert byte_bpe(BYTE).fast is not None


def test_token_counts_refuse_other_files(spark, tmp_path):
    import json

    with open(BYTE, encoding="utf-8") as f:
        spec = json.load(f)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "prefix.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(Exception, match="byte lengths"):
        token_counts.section_token_counts(edge_docs(spark), str(path)).collect()


def _count_reference(text, spans):
    out = {}
    for a, b in load_tokenizer(BYTE).encode(text, add_special_tokens=False).offsets:
        cover = [min(e, b) - max(s, a) for s, e in spans]
        best = max(range(len(spans)), key=lambda i: (cover[i], -i), default=-1)
        best = -1 if best < 0 or cover[best] <= 0 else best
        out[best] = out.get(best, 0) + 1
    return out


def test_section_counts_by_line(spark):
    for docs in (edge_docs(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), _docs(spark)):
        got = {}
        for r in token_counts.section_token_counts(docs, BYTE).collect():
            if r.n_tokens:
                got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
        for r in docs.collect():
            text = r.text or ""
            assert got.get(r.doc_id, {}) == _count_reference(text, token_counts.line_spans(text))
    assert token_counts.section_token_counts(empty_docs(spark), BYTE).count() == 0


def test_section_counts_with_missing_and_overlapping_spans(spark):
    schema = "doc_id long, text string, spans array<struct<start:bigint,end:bigint>>"
    rows = [(1, "one two three", [None, (0, 3), (None, 5), (4, None), (3, 13)]), (2, None, [None, (0, 2)]), (3, "x", [None]), (3, "x", None)]
    docs = spark.createDataFrame(rows, schema)
    out = token_counts.section_token_counts(docs, BYTE, sections=F.col("spans")).collect()
    got = {(r.doc_id, r.section): (r.start, r.end, r.n_tokens) for r in out if r.doc_id != 3}
    assert got == {(1, 0): (None, None, 0), (1, 1): (0, 3, 1), (1, 2): (None, None, 0), (1, 3): (None, None, 0), (1, 4): (3, 13, 2),
                   (2, 0): (None, None, 0), (2, 1): (0, 2, 0)}
    assert sorted((r.section, r.n_tokens) for r in out if r.doc_id == 3) == [(-1, 1), (-1, 1), (0, 0)]
    bad = spark.createDataFrame([(7, "one two three", [(0, 5), (4, 9)])], schema)
    with pytest.raises(Exception, match="sections of document 7 overlap"):
        token_counts.section_token_counts(bad, BYTE, sections=F.col("spans")).collect()


def test_section_counts_with_given_spans(spark):
    rows = [(1, "hello wonderful world", [(0, 3), (3, 9), (9, 9), (14, 21)]), (2, "日本語テキスト é", [(5, 9), (0, 2)]),
            (3, "no spans", []), (4, "null spans", None), (5, None, [(0, 4)]), (6, "beyond", [(3, 99)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<start:long,end:long>>")
    out = token_counts.section_token_counts(docs, BYTE, sections=F.col("spans")).collect()
    for doc_id, text, spans in rows:
        own = [r for r in out if r.doc_id == doc_id]
        want = _count_reference(text or "", spans or [])
        assert {r.section: r.n_tokens for r in own if r.n_tokens} == want
        assert sum(r.n_tokens for r in own) == len(_ids(BYTE, text)) and all(r.doc_tokens == len(_ids(BYTE, text)) for r in own)
        assert {r.section for r in own} >= set(range(len(spans or [])))


def test_field_counts_add_up(spark):
    docs = edge_docs(spark)
    fields = ["lang", "text", "norm"]
    out = token_counts.section_token_counts(docs.where("doc_id = 9"), BYTE, token_counts.field_text(fields),
                                            token_counts.field_sections(fields)).collect()
    row = docs.where("doc_id = 9").first()
    whole = "\n".join(row[f] or "" for f in fields)
    assert [r.section for r in out] == [0, 1, 2] and sum(r.n_tokens for r in out) == len(_ids(BYTE, whole))

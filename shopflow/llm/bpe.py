"""BPE encoding and decoding of whole texts, with tree concatenation for long ones.

Ids are those of ``encode(text, add_special_tokens=False)`` of the tokenizers library for the whole text.

Short texts: where the vocabulary's pre-tokenizer drops white space (pattern ``DROP_WHITE``), ASCII white
space always separates tokens, so a text is encoded run by run, and each worker remembers the ids of
runs it has met (a bounded dictionary, emptied when full).  For other vocabularies the text is
encoded as one run.

Long texts (over ``leaf_chars`` characters) are cut into leaves at fixed character positions, also in the
middle of unsplit text.  Leaves are rows of their own: all are encoded in parallel, whatever
document they come from.  The leaves of a text are then joined pairwise, as a tree: around each
join a window is encoded again, and grows until its tokens agree with the left side's tokens
before the join and with the right side's tokens after it (same id, same characters, ``AGREE`` tokens
in a row, or the side's own outer end).  Left part, window and right part are then one valid
encoding: BPE tokens depend on their neighbours only, so a sequence whose neighbouring tokens all
occur in valid encodings at the same characters is the encoding of the whole.  Should a window
never agree it ends as the whole of both sides.

Decoding goes from ids to text by the vocabulary's own decoder; for vocabularies without one (tokens
joined by spaces) by a table of token strings.

Defined results: a null or empty text has no ids and decodes to an empty text; null ids (of documents)
are kept; repeated rows are encoded each; an empty table gives no rows; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_or_empty, written
from .token_files import _slices
from .tokens import load_tokenizer

LEAF_CHARS = 1 << 16
LEAVES_PER_TASK = 64
AGREE = 8
FIRST_WINDOW = 64
REMEMBERED = 600_000
LONGEST_RUN = 64
# fixed value: the pre-token pattern that drops white space and parts letters, digits and signs
DROP_WHITE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SIGN = re.compile(rb"(?<=[A-Za-z0-9])([.,])")


class RunEncoder:
    """Packed ids (little-endian uint32) of texts by one tokenizers file, remembering short runs."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        steps = (config.get("pre_tokenizer") or {}).get("pretokenizers") or []
        self.specials = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_run = any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert")
                          and s.get("pattern") == {"Regex": DROP_WHITE} for s in steps)
        normal = config.get("normalizer") or {}
        self.lowers = any(n.get("type") == "Lowercase" for n in normal.get("normalizers", [normal]))
        self.known: dict[bytes, bytes] = {}
        self.joined = config.get("decoder") is None
        vocabulary = self.tokenizer.get_vocab()
        self.strings = [""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.strings[i] = token

    def packed(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def runs(self, text: bytes) -> list[bytes]:
        """The text's runs between ASCII white space, in a form that many texts share: what the tokenizer
        would lower anyway is lowered, and a full stop or comma after a letter or digit, which begins a
        token of its own, is a run of its own.  Texts with a special token's string are left alone."""
        low = text.lower()  # on bytes: A-Z only
        if any(s in low for s in self.specials):
            return text.split()
        return SIGN.sub(rb" \1", low if self.lowers else text).split()

    def _new_runs(self, runs: list[bytes]) -> dict[bytes, bytes]:
        """ids of runs; plain ASCII ones are encoded as one text and cut at their characters."""
        plain = [r for r in runs if r.isascii()]
        other = [r for r in runs if not r.isascii()]
        found = dict(zip(other, self.packed([r.decode() for r in other]), strict=True))
        if plain:
            ids, spans = self.spans(b" ".join(plain).decode())
            starts = np.cumsum([0] + [len(r) + 1 for r in plain[:-1]])
            cut = (np.searchsorted(spans[:, 0], starts) * 4).tolist()
            raw = ids.astype("<u4").tobytes()
            found |= {r: raw[i:j] for r, i, j in zip(plain, cut, [*cut[1:], len(raw)], strict=True)}
        return found

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_run:
            return self.packed([t.decode() for t in texts])
        runs = [self.runs(t) for t in texts]
        wanted = set().union(*runs) if runs else set()
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = [w for w in wanted if w not in known]
        known.update(self._new_runs(new))
        out = [b"".join(map(known.__getitem__, own)) for own in runs]
        for w in new:
            if len(w) > LONGEST_RUN:
                known.pop(w, None)
        return out

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """ids, and (start, end) characters of each token."""
        e = self.tokenizer.encode(text, add_special_tokens=False)
        return np.asarray(e.ids, dtype=np.uint32), np.asarray(e.offsets, dtype=np.int64).reshape(-1, 2)

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        if self.joined:
            return " ".join(map(self.strings.__getitem__, ids))
        return self.tokenizer.decode(ids, skip_special_tokens=False)


@functools.lru_cache(maxsize=4)
def run_encoder(path: str) -> RunEncoder:
    """One encoder per Python worker and file."""
    return RunEncoder(path)


class Node:
    """Encoding of text[start:end] as a text of its own; spans are in characters of the whole text."""

    def __init__(self, start: int, end: int, ids: np.ndarray, spans: np.ndarray):
        self.start, self.end, self.ids, self.spans = start, end, ids, spans


def _agreement(a: Node, b: Node, low: int, high: int, last: bool) -> tuple[int, int] | None:
    """Places in a and b after (``last``) or before the last or first AGREE equal tokens within low..high."""
    ia = np.flatnonzero((a.spans[:, 0] >= low) & (a.spans[:, 1] <= high))
    ib = np.flatnonzero((b.spans[:, 0] >= low) & (b.spans[:, 1] <= high))
    if len(ia) < AGREE or len(ib) < AGREE:
        return None
    key_a = list(zip(a.ids[ia].tolist(), *a.spans[ia].T.tolist(), strict=True))
    key_b = list(zip(b.ids[ib].tolist(), *b.spans[ib].T.tolist(), strict=True))
    # tokens that hold part of one character share its span: compare runs of neighbouring tokens
    runs_a = {tuple(key_a[i: i + AGREE]): i for i in range(len(key_a) - AGREE + 1)}
    places = range(len(key_b) - AGREE + 1)
    for j in reversed(places) if last else places:
        i = runs_a.get(tuple(key_b[j: j + AGREE]))
        if i is not None:
            half = AGREE // 2
            return int(ia[i]) + half, int(ib[j]) + half
    return None


def join(encoder: RunEncoder, text: str, left: Node, right: Node) -> Node:
    """The encoding of the two neighbouring parts as one text."""
    middle, width = left.end, FIRST_WINDOW
    while True:
        low, high = max(left.start, middle - width), min(right.end, middle + width)
        ids, spans = encoder.spans(text[low:high])
        window = Node(low, high, ids, spans + low)
        whole_left, whole_right = low == left.start, high == right.end
        at_left = (0, 0) if whole_left else _agreement(left, window, low, middle, last=True)
        at_right = (len(right.ids), len(ids)) if whole_right else _agreement(right, window, middle, high, last=False)
        if at_left and at_right and at_left[1] <= at_right[1]:
            (i, wi), (j, wj) = at_left, at_right
            return Node(left.start, right.end, np.concatenate([left.ids[:i], window.ids[wi:wj], right.ids[j:]]),
                        np.concatenate([left.spans[:i], window.spans[wi:wj], right.spans[j:]]))
        width *= 2


def join_all(encoder: RunEncoder, text: str, leaves: list[Node]) -> Node:
    """Pairwise joins, level by level."""
    while len(leaves) > 1:
        pairs = [join(encoder, text, a, b) for a, b in zip(leaves[::2], leaves[1::2], strict=False)]
        leaves = pairs + leaves[len(pairs) * 2:]
    return leaves[0]


def encode(docs: DataFrame, tokenizer_path: str, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """doc_id, ids (little-endian uint32) and decoded text of every whole text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    long_text = F.char_length("text") > leaf_chars

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = run_encoder(tokenizer_path)
        for batch in batches:
            for part in _slices(batch, 1):
                packed = encoder.encode_all(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(packed, pa.binary()), pa.array(map(encoder.decode, packed), pa.string())],
                    ["doc_id", "ids", "decoded"])

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = run_encoder(tokenizer_path)
        for batch in batches:
            for key, doc_id, start, part in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids, spans = encoder.spans(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key]), pa.array([doc_id], pa.int64()), pa.array([start], pa.int64()), pa.array([part]),
                     pa.array([ids.astype("<u4").tobytes()]), pa.array([(spans + start).astype("<i4").tobytes()])],
                    ["key", "doc_id", "start", "part", "ids", "spans"])

    def tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = run_encoder(tokenizer_path)

        def done(doc_id: int | None, held: list[tuple]) -> pa.RecordBatch:
            whole = "".join(h[1] for h in held)
            leaves = [Node(start, start + len(part), np.frombuffer(ids, dtype="<u4"),
                           np.frombuffer(spans, dtype="<i4").reshape(-1, 2)) for start, part, ids, spans in held]
            packed = join_all(encoder, whole, leaves).ids.astype("<u4").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([doc_id], pa.int64()), pa.array([packed], pa.binary()), pa.array([encoder.decode(packed)])],
                ["doc_id", "ids", "decoded"])

        held, last = [], None
        for batch in batches:
            for key, doc_id, start, part, ids, spans in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if last is not None and last[0] != key:
                    yield done(last[1], held)
                    held = []
                last = (key, doc_id)
                held.append((start, part, ids, spans))
        if held:
            yield done(last[1], held)

    out_schema = "doc_id long, ids binary, decoded string"
    few = rows.where(~long_text).select("doc_id", F.encode("text", "UTF-8").alias("text")).mapInArrow(short, out_schema)
    # each long row gets a key of its own, so that rows with one doc_id stay apart
    long_rows = written(rows.where(long_text), "bpe-long").select(
        F.concat_ws(":", "_metadata.file_path", "_metadata.row_index").alias("key"), "doc_id", "text")
    leaves = (long_rows.select("key", "doc_id", "text", F.explode(
        F.sequence(F.lit(0), F.char_length("text") - 1, F.lit(leaf_chars))).alias("start"))
        .select("key", "doc_id", F.col("start").cast("long").alias("start"),
                F.col("text").substr(F.col("start") + 1, F.lit(leaf_chars)).alias("part")))
    # an explicit number of tasks: AQE would merge this small exchange to one
    n_leaves = long_rows.agg(F.sum(F.ceil(F.char_length("text") / F.lit(leaf_chars)))).first()[0] or 1
    tasks = min(n_leaves, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_leaves // LEAVES_PER_TASK))
    encoded = written(leaves.repartition(tasks, F.col("key"), F.col("start")).mapInArrow(
        leaf, "key string, doc_id long, start long, part string, ids binary, spans binary"), "bpe-leaves")
    many = encoded.repartition("key").sortWithinPartitions("key", "start").mapInArrow(tree, out_schema)
    return few.unionByName(many)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``encode``'s rows."""
    return encoded.select("doc_id", F.call_function("div", F.octet_length("ids"), F.lit(4)).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

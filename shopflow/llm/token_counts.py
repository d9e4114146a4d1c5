"""Token counts per field or section, by offset-mapped attribution.

A whole text is encoded once.  Byte-level tokens are byte spans of the UTF-8 text, so running sums
of the tokens' byte lengths give each token's span, and the bytes' character numbers give its
character span (a token that holds part of a character covers that character).  Token spans are
then interval-joined with the sections' character spans by two binary searches per document.

Rule for a token whose span crosses a boundary: it counts for the section that covers most of its
characters, for the earlier one where two cover as many.  Tokens that no section covers count
for the row with section -1, so the sections' counts always add up to the document's count.

Sections come as a column ``array<struct<start: bigint, end: bigint>>`` of character spans that do not
overlap (``field_sections`` makes one; overlapping ones fail the job); unsorted, empty or out-of-range
spans are allowed.  Defined results: a null or empty text has no tokens (without ``sections`` no row, else a row of 0
for each); a null or empty section list leaves all tokens to section -1; a null section, or one without start or end, keeps its
number, has no tokens and null bounds; texts are encoded whole however long, a few megabytes of them at a time; each row
is counted by itself, repeated rows and ties of doc_id and null ids included; an empty table gives no rows;
columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_or_empty
from .token_files import _slices
from .tokens import ByteBpe, byte_bpe

OUTSIDE = -1


def token_spans(bpe: ByteBpe, text: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and end character of each token of the whole text."""
    ends = np.cumsum(bpe.n_bytes[bpe.encode(text)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    if text.isascii():
        return starts, ends
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section number (or OUTSIDE) of each token and whether it overlaps several sections or the gap beside one.

    ``low`` and ``high`` are the sections' spans, sorted and not overlapping.
    """
    n = len(low)
    owner = np.full(len(starts), OUTSIDE, dtype=np.int64)
    crosses = np.zeros(len(starts), dtype=bool)
    if n == 0 or len(starts) == 0:
        return owner, crosses
    first = np.searchsorted(high, starts, side="right")  # first section that ends after the token starts
    last = np.searchsorted(low, ends, side="left") - 1  # last section that starts before the token ends
    touch = first <= last
    owner[touch] = first[touch]
    at = np.minimum(first, n - 1)
    inside = touch & (low[at] <= starts) & (high[at] >= ends)
    crosses = touch & ~inside
    for t in np.flatnonzero(touch & (last > first)):
        span = slice(first[t], last[t] + 1)
        covered = np.minimum(high[span], ends[t]) - np.maximum(low[span], starts[t])
        owner[t] = first[t] + int(covered.argmax())
    return owner, crosses


def line_spans(text: str) -> list[tuple[int, int]]:
    """Character spans of the lines, each with its line feed; an empty text has none."""
    out, start = [], 0
    while start < len(text):
        end = text.find("\n", start) + 1 or len(text)
        out.append((start, end))
        start = end
    return out


def field_text(fields: list[str], separator: str = "\n") -> Column:
    """The named string columns as one text, to be encoded as a whole; null fields are empty."""
    return F.concat_ws(separator, *[F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields])


def field_sections(fields: list[str], separator: str = "\n") -> Column:
    """One section per field of ``field_text``; separators belong to the field before them."""
    spans, at = [], F.lit(0).cast("long")
    for i, f in enumerate(fields):
        gap = len(separator) if i + 1 < len(fields) else 0
        end = at + F.char_length(F.coalesce(F.col(f"`{f}`").cast("string"), F.lit(""))) + F.lit(gap)
        spans.append(F.struct(at.alias("start"), end.cast("long").alias("end")))
        at = end
    return F.array(*spans)


def section_token_counts(docs: DataFrame, tokenizer_path: str, text: Column | None = None,
                         sections: Column | None = None) -> DataFrame:
    """doc_id, section, start, end, n_tokens, n_crossing, doc_tokens: one row per section, and one with
    section -1 where tokens lie outside all.  Without ``sections`` each line is one."""
    ship_package(docs.sparkSession)
    by_line = sections is None
    spans = F.lit(None).cast("array<struct<start:bigint,end:bigint>>") if by_line else sections

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        if bpe.fast is None:
            raise ValueError(f"{tokenizer_path} is not a plain byte-level BPE: its tokens have no byte lengths")
        names = ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"]
        for batch in batches:
            for rows in _slices(batch, 1):
                parts: list[tuple] = []
                for doc_id, whole, given in zip(*[c.to_pylist() for c in rows.columns], strict=True):
                    starts, ends = token_spans(bpe, whole)
                    own = line_spans(whole) if by_line else [
                        (s["start"], s["end"]) if s and s["start"] is not None and s["end"] is not None else None
                        for s in given or []]
                    absent = np.array([s is None for s in own], dtype=bool)
                    span = np.array([s or (0, 0) for s in own], dtype=np.int64).reshape(-1, 2)
                    # empty sections hold no character, so only the others take part in the join
                    order = np.lexsort((span[:, 1], span[:, 0]))
                    order = order[span[order, 0] < span[order, 1]]
                    if (span[order[:-1], 1] > span[order[1:], 0]).any():
                        raise ValueError(f"sections of document {doc_id} overlap")
                    owner, crosses = attribute(starts, ends, span[order, 0], span[order, 1])
                    n = np.zeros(len(span) + 1, dtype=np.int64)
                    c = np.zeros(len(span) + 1, dtype=np.int64)
                    place = np.append(order, len(span))  # OUTSIDE is the last entry
                    np.add.at(n, place[owner], 1)
                    np.add.at(c, place[owner[crosses]], 1)
                    k = len(span) + int(n[-1] > 0)
                    number = np.arange(k)
                    number[len(span):] = OUTSIDE
                    bounds = np.vstack([span, [[0, len(whole)]]])[:k]
                    parts.append(([doc_id] * k, number, bounds[:, 0], bounds[:, 1], n[:k], c[:k],
                                  np.full(k, len(starts)), np.append(absent, False)[:k]))
                columns = [pa.array([d for p in parts for d in p[0]], pa.int64())]
                unknown = np.concatenate([p[7] for p in parts])
                columns += [pa.array(np.concatenate([p[i] for p in parts]), pa.int64(), mask=unknown if i in (2, 3) else None)
                            for i in range(1, 7)]
                yield pa.RecordBatch.from_arrays(columns, names)

    whole = text_or_empty() if text is None else F.coalesce(text, F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole.alias("text"), spans.alias("sections")).mapInArrow(
        count, "doc_id long, section long, start long, end long, n_tokens long, n_crossing long, doc_tokens long")

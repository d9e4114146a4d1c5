"""Fill-in-the-middle transformation by rotating blocks in place, and its exact inverse.

A text is cut into units (white space and the word after it; white space at the end is a unit), two cut
places and the form come from the SHA-256 of ``seed:doc_id``.  The text's bytes lie in one bytearray:
sentinels are inserted at the cuts (prefix, middle, suffix order), then neighbouring segments are exchanged
by rotation (reverse the one, reverse the other, reverse both together):

* ``psm``: ``<P>prefix <S>suffix <M>middle`` -- the middle and the suffix are exchanged;
* ``spm``: ``<S>suffix <P>prefix <M>middle`` -- prefix with middle and the suffix are exchanged;
* ``plain``: the text itself.

``restore`` finds the sentinels in the output, rotates the segments back and deletes the sentinels: a
rotation is undone by the rotation with the lengths exchanged.  No sentinel can arise by accident: texts that
contain one stay plain, and no proper end of a sentinel is the beginning of one (checked).

Cuts lie between bytes of units, units end at ASCII white space, so no character is ever split.

Defined results: a null text is empty; an empty text is plain with no units; a text of white space only is one
unit; very long texts are handled whole, one at a time (a few copies of one text are in memory);
a null doc_id is hashed as the empty text; repeated rows and ties are independent and give equal rows; an
empty table gives no rows; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_or_empty
from .token_files import _slices

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class Settings:
    """``rate`` per cent of texts are transformed, ``spm_rate`` per cent of those in suffix-first form."""

    seed: int = 42
    rate: int = 50
    spm_rate: int = 80
    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self):
        marks = self.marks
        if len(set(marks)) != 3 or not all(marks):
            raise ValueError("three different sentinels are needed")
        for a in marks:
            for b in marks:
                if any(a.endswith(b[:k]) for k in range(1, len(b))) or (a != b and a in b):
                    raise ValueError(f"sentinels {a!r} and {b!r} can overlap")

    @property
    def marks(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix, self.suffix, self.middle


def unit_ends(text: bytes) -> np.ndarray:
    """The byte offset behind every unit ``[white]*[other]+`` or, at the end, ``[white]+``."""
    white = WHITE[np.frombuffer(text, dtype=np.uint8)]
    if not len(white):
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(~white[:-1] & white[1:]) + 1
    return np.append(ends, len(text))


def draws(seed: int, doc_id: int | None) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i: i + 8], 16) for i in range(0, 32, 8)]


def rotate(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Exchange buffer[start:middle] and buffer[middle:end] by three reversals."""
    for a, b in ((start, middle), (middle, end), (start, end)):
        buffer[a:b] = buffer[a:b][::-1]


def transform_text(text: bytes, doc_id: int | None, settings: Settings) -> tuple[int, str, int | None, int | None, bytes]:
    """Units, form, prefix and middle length in code points, and the output."""
    ends = unit_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(settings.seed, doc_id)
    if n == 0 or h3 % 100 >= settings.rate or any(m in text for m in settings.marks):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (first, second))
    prefix_chars, middle_chars = len(text[:a].decode()), len(text[a:b].decode())
    buffer = bytearray(text)
    for place, mark in ((b, settings.suffix), (a, settings.middle), (0, settings.prefix)):
        buffer[place:place] = mark
    middle = len(settings.prefix) + a
    suffix = middle + len(settings.middle) + b - a
    form = "spm" if h4 % 100 < settings.spm_rate else "psm"
    rotate(buffer, 0 if form == "spm" else middle, suffix, len(buffer))
    return n, form, prefix_chars, middle_chars, bytes(buffer)


def restore_text(output: bytes, form: str, settings: Settings) -> bytes:
    """The text that gave ``output``."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    p, s, m = (buffer.find(mark) for mark in settings.marks)
    if form == "spm":
        rotate(buffer, 0, p, len(buffer))  # [suffix][prefix middle] -> [prefix middle][suffix]
        places = {settings.suffix: len(buffer) - p, settings.middle: m - p, settings.prefix: 0}
    else:
        rotate(buffer, s, m, len(buffer))  # [suffix][middle] -> [middle][suffix]
        places = {settings.suffix: s + len(buffer) - m, settings.middle: s, settings.prefix: p}
    for mark, place in places.items():  # from the right to the left
        del buffer[place: place + len(mark)]
    return bytes(buffer)


def fill_in_middle(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (UTF-8 bytes) of every whole text."""
    settings = settings or Settings()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch, 1):
                done = [transform_text(t, i, settings)
                        for i, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True)]
                n, form, before, middle, output = zip(*done, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    ship_package(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(text_or_empty(), "UTF-8").alias("text"))
            .mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"))


def restore(transformed: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``restored``: the text (UTF-8 bytes) rebuilt from output and form alone."""
    settings = settings or Settings()
    columns = transformed.columns
    form_at, output_at = columns.index("form"), columns.index("output")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch, output_at):
                texts = [restore_text(o, f, settings) for o, f in
                         zip(rows.column(output_at).to_pylist(), rows.column(form_at).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.binary())], [*columns, "restored"])

    ship_package(transformed.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema.fields)
    return transformed.mapInArrow(run, f"{schema}, restored binary")

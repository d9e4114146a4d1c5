"""Records of CSV files whose quoted cells may hold line feeds, read in splits.

Spark's reader keeps files splittable by taking every line feed as the end of a record; ``multiLine`` is
right about quoted line feeds but makes one task per file.  Here the files stay split:

1. Each line is a function from "does it start inside a quoted cell" to "does it end inside one"
   (``line_states``, native).  If no line that starts outside ends inside, every line is a record and
   Spark's reader is right as it is: that is one pass without Python.
2. Otherwise the functions of a split's lines are composed to one function per split, and the splits of a file,
   in order, tell where each split begins: inside or outside (one row per split).
3. Each split then groups its lines to records from that state.  Lines before the first record of a
   split belong to the record left open by an earlier split; these few pieces are stitched.  The records are
   written once as a table, numbered by (file, split, place), so a lost executor changes nothing.

A quote opens a cell only at the cell's beginning; inside, two quotes stand for one; characters between a closing
quote and the comma are part of the cell.  So a quote in the middle of an unquoted cell is a character like others.

A cell that is never closed takes the rest of its file as one record, as in any CSV reader (``strict``
loading fails on it because its cells are too few).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

FILE, START, PLACE = "_file", "_start", "_place"
# automaton of one line: in an unquoted cell / at a cell's beginning / inside quotes / behind a quote inside quotes
CELL, BEGIN, INSIDE, QUOTE = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value, file and split start of every physical line (a carriage return stays at the line's end)."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(START))


def _ends_inside(line: Column, starts_inside: bool) -> Column:
    """Whether a line that starts inside (or outside) a quoted cell ends inside one."""
    pieces = F.split(line, '"')

    def behind(state: Column, piece: Column) -> Column:
        settled = F.when(piece.endswith(","), F.lit(BEGIN)).otherwise(F.lit(CELL))
        return F.when((piece == "") | (state == INSIDE), state).otherwise(settled)

    def step(state: Column, piece: Column) -> Column:
        quoted = (F.when(state == BEGIN, F.lit(INSIDE)).when(state == INSIDE, F.lit(QUOTE))
                  .when(state == QUOTE, F.lit(INSIDE)).otherwise(F.lit(CELL)))
        return behind(quoted, piece)

    first = behind(F.lit(INSIDE if starts_inside else BEGIN), F.element_at(pieces, 1))
    end = F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), first, step)
    return F.when(line.contains('"'), end == INSIDE).otherwise(F.lit(starts_inside))


def line_states(lines: DataFrame) -> DataFrame:
    """``lines`` with ``f0`` and ``f1``: ends inside when started outside, and when started inside."""
    return lines.withColumns({"f0": _ends_inside(F.col("value"), False), "f1": _ends_inside(F.col("value"), True)})


def has_open_lines(spark: SparkSession, path: str) -> bool:
    """Whether some record takes several lines (a line leaves a quoted cell open), or holds a carriage
    return that Spark's reader would take as the end of a line."""
    lines = line_states(_lines(spark, path))
    lone_return = F.regexp_replace("value", "\r$", "").contains("\r")
    return bool(lines.agg(F.max(F.col("f0") | lone_return)).first()[0])


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that the folder names of ``path`` give (``split=train/...``)."""
    return spark.read.text(path).columns[1:]


def partition_value(name: str) -> Column:
    """The value of a partition column, from the file's path."""
    text = F.nullif(F.regexp_extract(FILE, f"/{re.escape(name)}=([^/]*)/", 1), F.lit(""))
    return F.nullif(F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), F.lit("__HIVE_DEFAULT_PARTITION__"))


def _split_functions(states: DataFrame) -> DataFrame:
    """One row per split: the composition of its lines' functions."""

    def compose(batches):
        import pyarrow as pa

        key, g = None, (False, True)
        for batch in batches:
            for file, start, f0, f1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, start) != key:
                    if key is not None:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, *g), strict=True))], schema=schema)
                    key, g = (file, start), (False, True)
                if f0 or not f1:
                    g = (f1 if g[0] else f0, f1 if g[1] else f0)
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, *g), strict=True))], schema=schema)

    import pyarrow as pa

    names = [FILE, START, "g0", "g1"]
    schema = pa.schema([(FILE, pa.string()), (START, pa.int64()), ("g0", pa.bool_()), ("g1", pa.bool_())])
    return states.select(FILE, START, "f0", "f1").mapInArrow(compose, f"{FILE} string, {START} long, g0 boolean, g1 boolean")


def _begins_inside(functions: DataFrame) -> dict[str, list[int]]:
    """The splits that begin inside a quoted cell, by file.  A function that is constant resets the
    state; the others swap it or keep it, so the state is the last constant, swapped as often as swaps follow."""
    order = Window.partitionBy(FILE).orderBy(START)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("g0") == F.col("g1")
    runs = functions.withColumn("run", F.coalesce(F.sum(F.when(constant, 1)).over(before), F.lit(0)))
    in_run = Window.partitionBy(FILE, "run").orderBy(START).rowsBetween(Window.unboundedPreceding, -1)
    known = runs.withColumns({
        "last": F.last(F.when(constant, F.col("g0")), ignorenulls=True).over(before),
        "swaps": F.coalesce(F.sum(F.when(F.col("g0") & ~F.col("g1"), 1)).over(in_run), F.lit(0))})
    inside = F.coalesce("last", F.lit(False)).cast("int") + F.col("swaps")
    out: dict[str, list[int]] = {}
    for row in known.where(inside % 2 == 1).select(FILE, START).collect():  # at most one row per split of the scan
        out.setdefault(row[FILE], []).append(row[START])
    return out


def _grouped(states: DataFrame, inside: dict[str, list[int]]) -> DataFrame:
    """Pieces of records: place in the split (-1 for lines that belong to an earlier split's record), text, and
    whether the record goes on behind the split."""

    def group(batches):
        import pyarrow as pa

        started = {file: frozenset(starts) for file, starts in inside.items()}
        schema = pa.schema([(FILE, pa.string()), (START, pa.int64()), (PLACE, pa.int64()), ("record", pa.string()),
                            ("goes_on", pa.bool_())])
        key, place, held, state = None, -1, [], False
        out = []

        def flush():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            size = 0
            for value, file, start, f0, f1 in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, start) != key:
                    if held:
                        out.append((*key, place, "\n".join(held), state))
                    key, held, state = (file, start), [], start in started.get(file, ())
                    place = -1 if state else 0
                elif not state and held:  # the line before closed a record
                    out.append((*key, place, "\n".join(held), False))
                    held, place = [], place + 1
                if not held and not state and value in ("", "\r"):
                    continue  # a blank line is no record
                held.append(value)
                state = f1 if state else f0
                size += len(value)
                if size > 1 << 22 and out:
                    yield flush()
                    size = 0
            if out:
                yield flush()
        if held:
            out.append((*key, place, "\n".join(held), state))
        if out:
            yield flush()

    return states.select("value", FILE, START, "f0", "f1").mapInArrow(
        group, f"{FILE} string, {START} long, {PLACE} long, record string, goes_on boolean")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the files at ``path``: file, split start, place in the split (0, 1, ... without gaps, the header
    of a file included) and text.  A written table.  Blank lines outside of cells are no records."""
    states = line_states(_lines(spark, path))
    known, out = scratch_path(spark, "csv-splits"), scratch_path(spark, "csv-records")
    _split_functions(states).write.parquet(known)
    functions = spark.read.schema(f"{FILE} string, {START} long, g0 boolean, g1 boolean").parquet(known)
    inside = _begins_inside(functions)
    pieces = _grouped(states, inside)
    pieces.withColumn("whole", (F.col(PLACE) >= 0) & ~F.col("goes_on")).write.partitionBy("whole").parquet(out)
    schema = f"{FILE} string, {START} long, {PLACE} long, record string, goes_on boolean, whole boolean"
    written = spark.read.schema(schema).parquet(out)
    if not written.select(FILE, START).distinct().join(functions, [FILE, START], "left_anti").isEmpty():
        raise RuntimeError(f"{path} was split differently by two scans: read it again")
    # at most two pieces a split are no whole records: its last record and the lines before its first one
    order = Window.partitionBy(FILE).orderBy(START, PLACE)
    parts = written.where(~F.col("whole")).withColumn("nth", F.sum(F.when(F.col(PLACE) >= 0, 1).otherwise(0)).over(order))
    stitched = (parts.groupBy(FILE, "nth")
                .agg(F.array_sort(F.collect_list(F.struct(START, PLACE, "record"))).alias("_p"))
                .select(FILE, F.col("_p")[0][START].alias(START), F.col("_p")[0][PLACE].alias(PLACE),
                        F.array_join(F.transform("_p", lambda p: p["record"]), "\n").alias("record")))
    every = written.where("whole").select(FILE, START, PLACE, "record").unionByName(stitched)
    return every.withColumn("record", F.regexp_replace("record", "\r$", ""))


def parsed_records(spark: SparkSession, path: str, names: list[str], bad: str, options: dict[str, str],
                   row_id: str | None = None) -> DataFrame:
    """``names`` as text columns, partition columns, ``bad`` (the record's text where it has too few or too many
    cells) and, if asked for, the number of each record in (file, place in the file) order.

    Each file begins with its header, which must be ``names``.
    """
    rows = records(spark, path)
    cell_schema = ", ".join(f"c{i} string" for i in range(len(names))) + f", `{bad}` string"
    cells = F.from_csv("record", cell_schema, options | {"columnNameOfCorruptRecord": bad})
    rows = rows.withColumn("_cells", cells)
    is_header = (F.col(START) == 0) & (F.col(PLACE) == 0)
    same = F.lit(True)
    for i, name in enumerate(names):
        same = same & (F.trim(f"_cells.c{i}") == name.strip())
    differs = F.raise_error(F.concat(F.lit("header differs in "), F.col(FILE))).cast("boolean")
    data = rows.where(F.when(is_header, F.when(~F.coalesce(same, F.lit(False)), differs).otherwise(False)).otherwise(True))
    columns = [F.col(f"_cells.c{i}").alias(n) for i, n in enumerate(names)]
    columns += [partition_value(c).alias(c) for c in partition_columns(spark, path)]
    columns.append(F.col(f"_cells.{bad}").alias(bad))
    if row_id is None:
        return data.select(*columns)
    # one row per split: how many records lie before it, headers not counted
    splits = rows.groupBy(FILE, START).agg((F.max(PLACE) + 1).alias("_n"))
    before = Window.orderBy(FILE, START).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col(FILE).alias("_f"), F.col(START).alias("_s"), (
        F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.dense_rank().over(Window.orderBy(FILE))).alias("_before"))
    numbered = data.join(splits, (F.col(FILE) == F.col("_f")) & (F.col(START) == F.col("_s")))
    return numbered.select(*columns, (F.col("_before") + F.col(PLACE)).alias(row_id))

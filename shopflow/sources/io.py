"""Loading and writing behaviour logs, splits and prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import BEHAVIOR_SCHEMA
from . import quoted_csv

# a quote inside a quoted cell is written twice; white space belongs to its cell
QUOTING = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]", **QUOTING}
BAD_RECORD = "_bad_record"


def _parsed(name: str, dtype: T.DataType, strict: bool) -> Column:
    """A CSV cell (text) as ``dtype``; blank is NULL.  Whole numbers may be written as floats (``1.0``).

    Text that does not parse is NULL, or fails the job if ``strict``.
    """
    text = F.nullif(F.trim(F.col(f"`{name}`")), F.lit(""))
    if isinstance(dtype, T.StringType):
        return F.nullif(F.col(f"`{name}`"), F.lit(""))
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        parsed = F.expr(f"try_cast(trim(`{name}`) AS timestamp_ntz)")
    elif isinstance(dtype, T.IntegralType):
        whole = F.expr(f"try_cast(trim(`{name}`) AS {dtype.simpleString()})")
        number = F.expr(f"try_cast(trim(`{name}`) AS double)")
        from_float = F.when(number == F.floor(number), F.expr(f"try_cast(try_cast(trim(`{name}`) AS double) AS {dtype.simpleString()})"))
        parsed = F.coalesce(F.when(text.rlike(r"^[-+]?\d+$"), whole), from_float)
    else:
        parsed = F.expr(f"try_cast(trim(`{name}`) AS {dtype.simpleString()})")
    if strict:
        bad = F.concat(F.lit(f"column {name}: cannot read "), text, F.lit(f" as {dtype.simpleString()}"))
        parsed = F.when(text.isNotNull() & parsed.isNull(), F.raise_error(bad).cast(dtype)).otherwise(parsed)
    return F.when(text.isNotNull(), parsed).cast(dtype)


def _file_order_id(df: DataFrame) -> DataFrame:
    """Add ``row_id``: 0, 1, ... in (file path, place in the file) order.

    A scan's rows are numbered per split of a file (``file_block_start``); a table with one row per
    split gives each split's first number.  So ids do not depend on how Spark packs files into
    tasks, and rows are neither moved nor sorted.
    """
    at = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    numbered = df.select("*", *at, F.monotonically_increasing_id().alias("_seq"))
    splits = numbered.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    splits = splits.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    out = numbered.join(splits.withColumnsRenamed({"_file": "_f", "_start": "_s"}),
                        (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s")))
    return out.withColumn("row_id", F.col("_before") + F.col("_seq") - F.col("_first")).drop(
        "_file", "_start", "_seq", "_f", "_s", "_first", "_before")


def load_behavior(spark: SparkSession, path: str, fmt: str = "csv", schema=BEHAVIOR_SCHEMA,
                  row_id: str = "auto", strict: bool = False, time_text: bool = False, multiline: bool | None = None) -> DataFrame:
    """Read a behaviour log by column name: any column order, extra columns ignored, missing ones NULL.

    CSV cells are read as text and parsed per column (``1.0`` is a whole number); unparsable cells
    become NULL, or fail the job with ``strict`` (``bad_cells`` counts them), and so do records with too few or
    too many cells (lenient: missing cells are NULL, surplus ones ignored).  Quoted cells may hold
    commas, doubled quotes and line feeds; one pass over the files finds out whether any record takes several
    lines, unless ``multiline`` says so.  ``time_text`` leaves ``action_time`` as text for
    ``prepare_time`` to parse leniently or strictly.  Logs without ``row_id`` (or with
    ``row_id='assign'``) are numbered in file order; such a log must have one header per file, the same in all.
    """
    names = [f.name for f in schema.fields]
    if fmt == "csv":
        have = set(_csv_names(spark, path))
        assign = "row_id" in names and (row_id == "assign" or "row_id" not in have)
        df = _csv_text(spark, path, strict, multiline, number=assign)
        cols = []
        for f in schema.fields:
            if f.name == "row_id" and assign:
                cols.append(F.col("row_id").cast(f.dataType))
            elif f.name not in have:
                cols.append(F.lit(None).cast("string" if time_text and f.name == "action_time" else f.dataType).alias(f.name))
            elif time_text and f.name == "action_time":
                cols.append(F.nullif(F.col(f.name), F.lit("")).alias(f.name))
            else:
                cols.append(_parsed(f.name, f.dataType, strict).alias(f.name))
        return df.select(*cols)
    if fmt != "parquet":
        raise ValueError(f"unsupported format {fmt!r}")
    df = spark.read.parquet(path)
    if "row_id" in names and "row_id" not in df.columns:
        df = _file_order_id(df)
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _csv_names(spark: SparkSession, path: str) -> list[str]:
    """The columns of a CSV log: its header's (trimmed), then those of its folder names."""
    return [c.strip() for c in spark.read.options(header="true", **QUOTING).csv(path).columns]


def _csv_text(spark: SparkSession, path: str, strict: bool = False, multiline: bool | None = None, number: bool = False,
              keep_bad: bool = False) -> DataFrame:
    """All columns as text, named by the header (trimmed); files whose headers differ fail the job.

    ``strict`` fails on records with too few or too many cells; ``keep_bad`` adds their text as a column.
    ``number`` adds (or replaces) ``row_id``: 0, 1, ... in (file, place in the file) order.
    """
    folders = quoted_csv.partition_columns(spark, path)
    header = spark.read.options(header="true", **QUOTING).csv(path).columns
    header = header[: len(header) - len(folders)]
    if multiline is None:
        multiline = quoted_csv.has_open_lines(spark, path)
    if multiline:
        df = quoted_csv.parsed_records(spark, path, header, BAD_RECORD, QUOTING, "_number" if number else None)
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, BAD_RECORD]])
        # a record's cells can only be counted when all are parsed
        df = spark.read.schema(schema).options(header="true", enforceSchema="false", columnNameOfCorruptRecord=BAD_RECORD,
                                               columnPruning=str(not (strict or keep_bad)).lower(), **QUOTING).csv(path)
        if number:
            df = _file_order_id(df.drop("row_id")).withColumnRenamed("row_id", "_number")
    if strict:
        text = F.concat(F.lit("wrong number of cells: "), F.col(BAD_RECORD))
        df = df.where(F.when(F.col(BAD_RECORD).isNotNull(), F.raise_error(text).cast("boolean")).otherwise(True))
    if number:
        df = df.drop("row_id").withColumnRenamed("_number", "row_id")
    if not keep_bad:
        df = df.drop(BAD_RECORD)
    return df.withColumnsRenamed({c: c.strip() for c in df.columns if c != c.strip()})


def bad_cells(spark: SparkSession, path: str, schema=BEHAVIOR_SCHEMA, multiline: bool | None = None) -> DataFrame:
    """(column, bad): cells of a CSV log that hold text but do not parse as the column's type; if there are records
    with too few or too many cells, their number under the name ``_bad_record``."""
    df = _csv_text(spark, path, multiline=multiline, keep_bad=True)
    typed = [f for f in schema.fields if f.name in df.columns and not isinstance(f.dataType, T.StringType)]
    counts = df.agg(*[F.count_if((F.trim(F.col(f"`{f.name}`")) != "") & _parsed(f.name, f.dataType, False).isNull())
                      .alias(f.name) for f in typed], F.count(BAD_RECORD).alias(BAD_RECORD))
    every = counts.unpivot([], [*[f.name for f in typed], BAD_RECORD], "column", "bad")
    return every.where((F.col("column") != BAD_RECORD) | (F.col("bad") > 0))


def head_n(df: DataFrame, n: int, order_col: str = "row_id") -> DataFrame:
    """The first ``n`` rows in file order (an ordered limit, planned as TakeOrderedAndProject)."""
    return df.orderBy(order_col).limit(n)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.options(**CSV_OPTIONS).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", split_col: str = "split") -> None:
    """One dataset partitioned by ``split`` (train / test / val directories)."""
    write_table(df, path, fmt, partition_by=split_col)


# The split hand-off: the log with its time parts, the purchase label and the split.
SPLIT_SCHEMA = T.StructType([*BEHAVIOR_SCHEMA.fields, *[T.StructField(c, T.IntegerType()) for c in (
    "hour", "day", "month", "dayofweek", "target")], T.StructField("split", T.StringType())])


def read_splits(spark: SparkSession, path: str, fmt: str = "parquet", schema=SPLIT_SCHEMA) -> DataFrame:
    """A split dataset; CSV is read with the declared ``schema`` (no inference pass), by name."""
    if fmt == "csv":
        df = _csv_text(spark, path, strict=True)
        return df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.StringType)
                           else _parsed(f.name, f.dataType, True).alias(f.name)
                           for f in schema.fields if f.name in df.columns])
    return spark.read.parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split_col: str = "split",
               fmt: str = "parquet") -> DataFrame:
    """One split; the partition filter prunes the other directories."""
    return read_splits(spark, path, fmt).where(F.col(split_col) == name)


def prediction_table(df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    return df.select("user_log_acct", "item_sku_id", "action_time", prediction, probability)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(prediction_table(df), path, fmt)

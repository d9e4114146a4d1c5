"""Missing-value fills driven by the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..schema import OTHER_FILL, TEXT_FILL

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fill_missing_typed(df: DataFrame) -> DataFrame:
    """Text columns -> ``'unknown'``, numeric columns -> -1 (timestamps stay NULL)."""
    out = df
    text = text_columns(df)
    if text:
        out = out.na.fill(TEXT_FILL, subset=text)
    num = numeric_columns(df)
    if num:
        out = out.na.fill(OTHER_FILL, subset=num)
    return out


def fill_missing_zero(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Numeric columns -> 0; text and timestamps untouched."""
    num = [c for c in numeric_columns(df) if c not in exclude]
    return df.na.fill(0, subset=num) if num else df

"""Time expressions (Column -> Column): text cleanup, parsing, parts, weekend, hour bucket."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import HOUR_BUCKET_EDGES, HOUR_BUCKET_LABELS, TIME_FORMAT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_time_text(c) -> Column:
    """Cast to text and drop one trailing ``.0``."""
    return F.regexp_replace(_col(c).cast("string"), r"\.0$", "")


def parse_time_coerce(c, fmt: str = TIME_FORMAT) -> Column:
    """Parse text with ``fmt``; unparsable text becomes NULL (session-time-zone independent)."""
    c = _col(c)
    ok = F.try_to_timestamp(c, F.lit(fmt)).isNotNull()
    return F.when(ok, F.to_timestamp_ntz(c, F.lit(fmt)))


def parse_time_strict(c, fmt: str | None = TIME_FORMAT) -> Column:
    """Parse text; unparsable text raises (ANSI). ``fmt=None`` accepts any ISO-like text."""
    c = _col(c)
    if fmt is None:
        return c.cast("timestamp_ntz")
    return F.to_timestamp_ntz(c, F.lit(fmt))


# ------------------------------------------------------------------ free format
# fixed values: the dates and times of day that a format can be made of, with Spark's pattern for each
TIME_DATES = {"Y-9-9": "yyyy-M-d", "Y/9/9": "yyyy/M/d", "Y.9.9": "yyyy.M.d", "9/9/9": "M/d/yyyy", "9-9-9": "M-d-yyyy", "YMD": "yyyyMMdd"}
TIME_CLOCKS = {"": "", "9:9": "H:m", "9:9:9": "H:m:s[.SSSSSSSSS]", "HMS": "HHmmss"}
LOG_SHAPE = "Y-9-9 9:9:9"


def time_shape(c) -> Column:
    """The format of a time text: a year in front is ``Y``, other digit runs ``9``; a fraction of a second may be there
    or not, an offset stays as it is (``Z`` is ``+0000``)."""
    text = F.trim(_col(c))
    offset = F.regexp_replace(F.regexp_extract(text, r":\d+(?:\.\d+)?(Z|[+-]\d{2}:?\d{2})$", 1), ":", "")
    body = F.regexp_replace(F.regexp_replace(text, r"(?<=:\d{1,2})(Z|[+-]\d{2}:?\d{2})$", ""), r"(?<=:\d{1,2})\.\d+(?=$|Z|[+-])", "")
    body = F.regexp_replace(body, r"(Z|[+-]\d{2}:?\d{2})$", "")
    body = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), text).otherwise(body)  # the day of a date is no offset
    shape = F.regexp_replace(F.regexp_replace(body, r"^\d{4}(?=[-/.])", "Y"), r"\d+", "9")
    compact = F.when(text.rlike(r"^\d{8}$"), F.lit("YMD")).when(text.rlike(r"^\d{8}[ T]?\d{6}$"), F.regexp_replace(
        F.regexp_replace(text, r"^\d{8}", "YMD"), r"\d{6}$", "HMS"))
    return F.coalesce(compact, F.concat(shape, F.when(offset == "Z", F.lit("+0000")).otherwise(offset)))


def infer_time_shape(df: DataFrame, time_col: str, order_col: str = "row_id") -> str | None:
    """The format of the first time text (by ``order_col``; the smallest text without it): one aggregate, one row."""
    text = F.nullif(F.trim(F.col(time_col)), F.lit(""))
    by = F.col(order_col) if order_col in df.columns else text
    row = df.where(text.isNotNull()).agg(F.min_by(time_shape(text), by).alias("shape")).first()
    return row.shape


def _layout(shape: str) -> tuple[str, str] | None:
    """The expression that texts of a format match, and Spark's pattern for them without the offset."""
    m = re.match(r"^(?P<date>[Y9MD./-]+?)(?P<sep>[ T]?)(?P<clock>(?:9:9(?::9)?|HMS)?)(?P<offset>[+-]\d{4})?$", shape)
    if not m or m["date"] not in TIME_DATES or bool(m["sep"]) > bool(m["clock"]):
        return None
    date = re.escape(m["date"]).replace("YMD", r"\d{8}").replace("Y", r"\d{4}").replace("9", r"\d{1,2}")
    if m["date"][0] == "9":  # the year is the last part
        date = date[: -len(r"\d{1,2}")] + r"\d{4}"
    body = date + m["sep"] + m["clock"].replace("HMS", r"\d{6}").replace("9", r"\d{1,2}")
    if m["clock"] == "9:9:9":
        body += r"(?:\.\d{1,9})?"
    if m["offset"]:
        sign, hours, minutes = m["offset"][0], m["offset"][1:3], m["offset"][3:]
        body += rf"(?:{re.escape(sign)}{hours}:?{minutes}{'|Z' if m['offset'] == '+0000' else ''})"
    sep = f"'{m['sep']}'" if m["sep"] == "T" else m["sep"]
    return f"^{body}$", TIME_DATES[m["date"]] + sep + TIME_CLOCKS[m["clock"]]


def parse_time_free(c, shape: str | None, strict: bool = True) -> Column:
    """Time texts that all have one format (``shape``), as the wall time they say; blank is NULL.

    A text of another format, or one that is no time, raises, or is NULL if not ``strict``.
    """
    text = F.nullif(F.trim(_col(c)), F.lit(""))
    layout = _layout(shape or "")
    parsed = F.lit(None).cast("timestamp_ntz")
    if layout:
        wall = F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "") if re.search(r"[+-]\d{4}$", shape) else text
        parsed = F.when(text.rlike(layout[0]), parse_time_coerce(wall, layout[1]))
    if strict:
        message = F.concat(F.lit(f"time does not have the format of the first one ({shape}): "), text)
        parsed = F.when(text.isNotNull(), F.coalesce(parsed, F.raise_error(message).cast("timestamp_ntz")))
    return parsed


def time_parts(df: DataFrame, time_col: str = "action_time") -> DataFrame:
    """hour, day, month and dayofweek (Monday = 0)."""
    t = F.col(time_col)
    return df.withColumns({
        "hour": F.hour(t), "day": F.dayofmonth(t), "month": F.month(t), "dayofweek": F.weekday(t),
    })


def weekend_flag(dayofweek) -> Column:
    return _col(dayofweek).isin(5, 6).cast("int")


def hour_bucket(hour, include_midnight: bool = False) -> Column:
    """Right-closed bins (0,6], (6,12], (12,18], (18,24]; hour 0 is in none unless ``include_midnight``."""
    h = _col(hour)
    expr = None
    for i, label in enumerate(HOUR_BUCKET_LABELS):
        lo, hi = HOUR_BUCKET_EDGES[i], HOUR_BUCKET_EDGES[i + 1]
        cond = (h > lo) & (h <= hi)
        if i == 0 and include_midnight:
            cond = (h >= lo) & (h <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def gap_seconds(prev_time, time) -> Column:
    """Seconds between two timestamps, microsecond exact."""
    return F.timestamp_diff("MICROSECOND", _col(prev_time), _col(time)).cast("double") / 1e6

"""Date normalisers (X12, X14 date part, X21). Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ledgerspark.functions.common import let, memo_by_name, strip_ws, then

# ISO date text with an optional time part. Spark's cast alone would also
# read "2024" or "2024-1" as dates; the reference rejects those.
ISO_DATE_TEXT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"

# Markers the ISO serialiser turns into null before parsing.
ISO_MARKERS = ["False", "false", "None", "nan"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


@memo_by_name
def parse_timestamp(col, dtype: T.DataType = T.StringType()) -> Column:
    """Loose timestamp parse (no time zone): unparsable text -> null."""
    c = _c(col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    return let(strip_ws(c.cast("string")), lambda s: F.when(
        s.rlike(ISO_DATE_TEXT), F.regexp_replace(s, "T", " ").try_cast("timestamp_ntz")))


@memo_by_name
def parse_date(col, dtype: T.DataType = T.StringType()) -> Column:
    """The calendar day of a loose date/datetime value; unparsable -> null."""
    c = _c(col)
    if isinstance(dtype, T.DateType):
        return c
    return then(parse_timestamp(c, dtype), F.to_date)


@memo_by_name
def iso_datetime(col, dtype: T.DataType = T.StringType()) -> Column:
    """ISO-8601 text ``yyyy-MM-ddTHH:mm:ss[.ffffff]``; markers/unparsable -> null."""
    c = _c(col)
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        c = F.when(~c.cast("string").isin(*ISO_MARKERS), c)
    def render(ts: Column) -> Column:
        frac = F.date_format(ts, "SSSSSS")
        return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                        F.when(frac != F.lit("000000"), F.concat(F.lit("."), frac))
                        .otherwise(F.lit("")))
    return then(parse_timestamp(c, dtype), lambda ts: let(ts, render))


def day_text(col) -> Column:
    """X14 date part: date or timestamp -> ``yyyy-MM-dd`` (time dropped)."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def month_of(col) -> Column:
    """First day of the value's month (partition key of history tables)."""
    return F.trunc(_c(col), "month")

"""Numeric normalisers (X10, X11, X13). Column -> Column, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ledgerspark.functions.common import let, strip_ws

# Text a lenient numeric parser (pandas ``to_numeric``) accepts, after the
# surrounding whitespace is stripped: decimal / exponent forms and the
# inf / infinity / nan words. Spark's own cast also takes "1d" or "1f"
# suffixes, which must stay unparsed, hence the explicit pattern.
NUMERIC_TEXT = r"^[+-]?(((\d+\.?\d*)|(\.\d+))([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"

# Text Python's ``float()`` accepts when the caller then truncates with
# ``int()``: like NUMERIC_TEXT, single underscores between digits allowed,
# and without inf / nan (``int()`` rejects them).
FLOAT_TEXT = r"^[+-]?(((\d(_?\d)*)(\.(\d(_?\d)*)?)?)|(\.\d(_?\d)*))([eE][+-]?\d(_?\d)*)?$"

# Text Python's ``int()`` accepts: an optional sign and digits (underscores
# between digits allowed).
INT_TEXT = r"^[+-]?\d(_?\d)*$"

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_number(col, dtype: T.DataType = T.StringType()) -> Column:
    """Lenient numeric coercion: unparsable -> null, as ``to_numeric(errors='coerce')``."""
    c = _c(col)
    if isinstance(dtype, _INTEGRAL + _FRACTIONAL):
        return c.cast("double")
    if isinstance(dtype, T.BooleanType):
        return c.cast("double")
    s = strip_ws(c.cast("string"))  # a trim costs less twice than a lambda once
    return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))


def amount(col, dtype: T.DataType = T.StringType()) -> Column:
    """Number with default 0 -- null, NaN and unparsable text become 0.0."""
    v = parse_number(col, dtype)
    return F.coalesce(F.nanvl(v, F.lit(0.0)), F.lit(0.0))


def integral_or_null(v: Column) -> Column:
    """A double holding a whole number -> bigint; fractions, inf, NaN -> null."""
    return let(v, lambda x: F.when(~F.isnan(x) & (x == F.floor(x)), x.try_cast("bigint")))


def to_id(col, dtype: T.DataType = T.StringType()) -> Column:
    """X11: nullable integer id. Non-integral or unparsable values -> null."""
    c = _c(col)
    if isinstance(dtype, _INTEGRAL):
        return c.cast("bigint")
    return integral_or_null(parse_number(c, dtype))


def truncate_float_text(text: Column) -> Column:
    """``int(float(text))``: Python float syntax, truncated toward zero."""
    s = strip_ws(text)
    return F.when(s.rlike(FLOAT_TEXT), F.replace(s, F.lit("_"), F.lit("")).try_cast("double").try_cast("bigint"))


def int_text(text: Column) -> Column:
    """``int(text)``: whole-number text only."""
    s = strip_ws(text)
    return F.when(s.rlike(INT_TEXT), F.replace(s, F.lit("_"), F.lit("")).try_cast("bigint"))


def round_half_even(col, scale: int = 6) -> Column:
    """Round to ``scale`` decimals, ties to even (``F.round`` rounds ties up)."""
    return F.bround(_c(col), scale)

"""Spreadsheet extracts (K4, K5, X14): flat, text-only grids written as CSV.

The spreadsheet API client is out of scope; a sheet tab becomes a CSV folder.
Every part file is written by its own task -- nothing is funnelled through one
task or the driver. ``upload_sheet`` writes rows in any order, with a header in
every part; ``upload_grid`` writes the tab itself: one header, rows in source
order over the parts, and no more columns than the tab's range A:Z has.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ledgerspark.functions.dates import day_text
from ledgerspark.operators.dedup import SEQ
from ledgerspark.sinks.snapshots import Table
from ledgerspark.sinks.tables import staged_write

#: Columns of the tab's range A:Z.
GRID_COLUMNS = 26
_LINE = "_line"
_CSV = {"header": False, "quote": '"', "escape": '"'}


def number_text(c):
    """A number as plain decimal text: no exponent, no trailing zeros, one decimal at least.

    The shortest text that reads back as the number is rewritten digit by digit,
    so nothing is rounded; infinities keep their names.
    """
    t = c.cast("string")
    body = F.regexp_replace(t, r"^-|E.*$", "")
    whole, frac = F.substring_index(body, ".", 1), F.element_at(F.split(body, r"\."), 2)
    power = F.regexp_extract(t, r"E(-?\d+)$", 1).cast("int")
    digits = F.concat(whole, frac)
    up = F.concat(F.rpad(digits, F.greatest(power + 1, F.length(digits)), "0"))
    place = F.length(whole) + power
    big = F.concat(F.substring(up, F.lit(1), place), F.lit("."), F.coalesce(
        F.nullif(F.regexp_replace(F.substring(up, place + 1, F.length(up)), "0+$", ""), F.lit("")), F.lit("0")))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), F.regexp_replace(digits, "0+$", ""))
    sign = F.when(t.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.when(t.contains("E"), F.concat(sign, F.when(power >= 0, big).otherwise(small))).otherwise(t)


def _cell(c, dtype: T.DataType):
    """The value as text: numbers in plain decimals, NaN and null as null."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), number_text(c))
    return c.cast("string")


def sheet_cell(col: str, dtype: T.DataType):
    """X14 for one column: dates -> yyyy-MM-dd, NaN/null -> "", others as text."""
    c = F.col(col)
    dates = isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return F.coalesce(day_text(c) if dates else _cell(c, dtype), F.lit("")).alias(col)


def sheet_rows(df: DataFrame) -> DataFrame:
    """The whole frame as text cells, column order kept."""
    return df.select(*[sheet_cell(f.name, f.dataType) for f in df.schema.fields])


def raw_cell(col: str, dtype: T.DataType):
    """K5 for one column: the value as text, nulls -> ""."""
    return F.coalesce(_cell(F.col(col), dtype), F.lit("")).alias(col)


def raw_rows(df: DataFrame) -> DataFrame:
    """K5 cells: values as text with nulls -> "" (no date formatting)."""
    return df.select(*[raw_cell(f.name, f.dataType) for f in df.schema.fields])


def upload_sheet(df: DataFrame, path: str, skip_if_empty: bool = True,
                 formatted: bool = True) -> bool:
    """K4 (``formatted``) / K5: replace the tab's content with ``df`` as CSV.

    The tab is staged and switched like a truncate load: an empty or failed
    upload leaves the previous content.
    """
    rows = sheet_rows(df) if formatted else raw_rows(df)
    return staged_write(rows, path, lambda d, place: d.write.option("header", True).csv(place), skip_if_empty)


def grid(df: DataFrame, order: Sequence[str], formatted: bool = True) -> DataFrame:
    """K4 / K5: the tab as text rows in order: the header, then the rows by ``order``.

    ``order`` must tell rows apart (a source sequence); ``_seq`` itself is no column of the tab.
    Rows are range-sorted, so the parts in turn are the tab; ``_line`` is 0 for the header. More
    than 26 columns are refused.
    """
    missing = [c for c in order if c not in df.columns]
    if missing:
        raise ValueError(f"a grid needs its order column(s) {missing}")
    fields = [f for f in df.schema.fields if f.name != SEQ]
    if len(fields) > GRID_COLUMNS:
        raise ValueError(f"{len(fields)} columns do not fit the tab's {GRID_COLUMNS}")
    cell = sheet_cell if formatted else raw_cell
    names = [f.name for f in fields]
    keys = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    rows = df.select(F.lit(1).alias(_LINE), *keys, *[cell(f.name, f.dataType) for f in fields])
    head = df.sparkSession.range(1).select(F.lit(0).alias(_LINE), *[F.lit(None).cast(df.schema[c].dataType).alias(f"_o{i}") for i, c in enumerate(order)],
                                           *[F.lit(n).alias(n) for n in names])
    by = [_LINE, *[F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))]]
    return head.unionByName(rows).repartitionByRange(*by).sortWithinPartitions(*by).select(_LINE, *names)


def upload_grid(df: DataFrame, target: str | Table, order: Sequence[str], formatted: bool = True, skip_if_empty: bool = True) -> bool:
    """K4 (``formatted``) / K5: replace the tab's content with ``grid`` as CSV parts.

    In a snapshot store the tab appears at once; in a folder it is staged and switched. An
    empty or failed upload leaves the previous content.
    """
    rows = grid(df, order, formatted)
    counted = F.col(_LINE) > 0
    if isinstance(target, Table):
        return target.store.begin().overwrite(target.name, rows.drop(_LINE), skip_if_empty, "csv", options=_CSV, spare_rows=1).commit()
    return staged_write(rows, target, lambda d, place: d.drop(_LINE).write.options(**_CSV).csv(place), skip_if_empty, counted)

"""The error channel of the casts (X10-X12): what they turn into 0 or null is kept with its reason.

``rejects`` is one more column, made in the pass that makes the others: an array of
(column, raw text, reason), empty for clean rows. ``load_with_rejects`` writes the rows once
and publishes two tables of a store over the same files: the target's columns, and the
rejects with the id of their row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.functions.common import strip_ws
from ledgerspark.functions.dates import parse_date
from ledgerspark.functions.numbers import parse_number, to_id
from ledgerspark.sinks.snapshots import Load, Table

REJECTS = "_rejects"
SUFFIX = "_rejects"
# What an ERP lands for an empty field (any case); that is no error.
EMPTY = ("", "false", "none", "nan", "nat", "null", "<na>")
NUMBER, INTEGER, DATE = "not a number", "not an integer", "not a date"


def _reject(raw: DataFrame, name: str, parsed, reason: str) -> Column:
    text = F.col(name).cast("string")
    bad = text.isNotNull() & ~F.lower(strip_ws(text)).isin(*EMPTY) & parsed(F.col(name), raw.schema[name].dataType).isNull()
    return F.when(bad, F.struct(F.lit(name).alias("column"), text.alias("raw"), F.lit(reason).alias("reason")))


def rejects(raw: DataFrame, numbers: Sequence[str] = (), integers: Sequence[str] = (), dates: Sequence[str] = ()) -> Column:
    """The values of a raw row that its casts cannot read; columns that are not there are passed over."""
    kinds = ((numbers, parse_number, NUMBER), (integers, to_id, INTEGER), (dates, parse_date, DATE))
    found = [_reject(raw, c, parsed, reason) for names, parsed, reason in kinds for c in names if c in raw.columns]
    if not found:
        return F.array().cast("array<struct<column: string, raw: string, reason: string>>").alias(REJECTS)
    return F.array_compact(F.array(*found)).alias(REJECTS)


def load_with_rejects(change: Load, name: str, df: DataFrame, row_id: str) -> Load:
    """Overwrite table ``name`` with ``df`` less its rejects, and ``name`` + ``_rejects`` with them: one write."""
    return change.overwrite_views(df, {name: [c for c in df.columns if c != REJECTS], name + SUFFIX: [row_id, REJECTS]})


def read_rejects(table: Table, version: int | None = None) -> DataFrame:
    """row id, column, raw, reason: a row per rejected value of a table loaded with rejects."""
    rows = table.store.table(table.name + SUFFIX, version)
    row_id = next(c for c in rows.columns if c != REJECTS)
    return rows.where(F.size(REJECTS) > 0).select(row_id, F.inline(REJECTS))

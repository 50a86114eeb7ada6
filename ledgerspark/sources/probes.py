"""A1 answered from metadata: which months a store has, and the least and greatest dates in file footers."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession, functions as F, types as T

from ledgerspark.functions.periods import as_date, month_start
from ledgerspark.sinks.snapshots import Table


@contextmanager
def _from_footers(spark: SparkSession):
    """Let min and max of Parquet columns come from the footers (Spark's aggregate pushdown)."""
    ours = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def footer_range(spark: SparkSession, paths: list[str], schema: T.StructType, col: str):
    """(least, greatest) date of ``col`` in Parquet files of this ``schema``, without reading rows; nulls where there is none.

    The schema has to be the files' own: the pushed aggregate finds a column in a footer by its place.
    """
    with _from_footers(spark):
        return tuple(spark.read.schema(schema).parquet(*paths).agg(F.min(col), F.max(col)).first())


def day_exists(history: Table, date_col: str, day) -> dict:
    """A1 on a history in parts by month: ``{"existe": bool, "por": how it was decided}``.

    No part for the month: no row (``"meses"``). A footer's least or greatest date is the day, or the day is
    outside them (``"pies"``): decided. Only a day strictly between them needs the rows of that
    month (``"filas"``), which is never so for the first day of a month that the reference asks for.
    """
    d = as_date(day)
    month = month_start(d).isoformat()
    paths = [f"{history.store.path}/{p['path']}" for p in history.store.parts(history.name) if p["key"] == month and p["rows"]]
    if not paths:
        return {"existe": False, "por": "meses"}
    spark = history.store.spark
    rows = history.store.table(history.name, keys=[month])
    low, high = footer_range(spark, paths, rows.schema, date_col)
    if low is None or not low < d < high:
        return {"existe": low is not None and d in (low, high), "por": "pies"}
    return {"existe": not rows.where(F.col(date_col) == F.lit(d)).isEmpty(), "por": "filas"}

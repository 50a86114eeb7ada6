"""Counts, probes and top-k."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ledgerspark.functions.periods import as_date


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_count(df: DataFrame, date_col: str, day) -> DataFrame:
    """A1 as a plan: one row ``(dia, n, existe)`` for rows dated exactly ``day``.

    The filter is a literal date, so it is pushed into the scan (and prunes a
    month-partitioned history table down to one partition).
    """
    d = as_date(day)
    return (df.where(F.to_date(_c(date_col)) == F.lit(d))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(d).alias("dia"), "n", (F.col("n") > 0).alias("existe")))


def month_guard(df: DataFrame, date_col: str) -> DataFrame:
    """A1 for every month at once: per month, rows dated on its first day.

    ``(mes, n_dia_1, existe)``; a grouped count with map-side partial
    aggregation, so a month holding most rows is no hot spot.
    """
    day = F.to_date(_c(date_col))
    return (df.where(day.isNotNull())
            .groupBy(F.trunc(day, "month").alias("mes"))
            .agg(F.count_if(F.dayofmonth(day) == 1).alias("n_dia_1"))
            .withColumn("existe", F.col("n_dia_1") > 0))


def distinct_ids(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """A2: ``SELECT DISTINCT CAST(col AS BIGINT) WHERE col IS NOT NULL``."""
    name = alias or col
    return (df.where(_c(col).isNotNull())
            .select(_c(col).cast("bigint").alias(name)).distinct())


def frequency(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``value_counts`` -- how many rows per value, most frequent first."""
    return (df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(name)))


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """O1/O2: first ``n`` rows by ``order`` (a take-ordered plan, no global sort)."""
    return df.orderBy(*order).limit(n)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach row-count metrics that are filled in by the next action on ``df``.

    No extra job runs; read ``observation.get`` after the write.
    """
    obs = Observation(name)
    return df.observe(obs, *[m.alias(k) for k, m in metrics.items()]), obs

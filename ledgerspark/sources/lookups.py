"""Warehouse lookup lists as DataFrames (never collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark.operators.counts import distinct_ids


def vendor_ids(vendors: DataFrame, col: str = "id_vendedor") -> DataFrame:
    """``SELECT CAST(id_vendedor AS BIGINT) AS id`` (no DISTINCT)."""
    return vendors.select(F.col(col).try_cast("bigint").alias("id"))


def tax_ids(taxes: DataFrame, col: str = "id_impuestos") -> DataFrame:
    """Non-null tax ids as integers."""
    return (taxes.where(F.col(col).isNotNull())
            .select(F.col(col).try_cast("bigint").alias("id_impuestos")))


def master_product_ids(master: DataFrame, col: str = "id_producto") -> DataFrame:
    """``SELECT DISTINCT CAST(id_producto AS BIGINT) WHERE id_producto IS NOT NULL``."""
    return distinct_ids(master, col, "id_producto")

"""The ERP extractors as scans of landed tables with their domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark.functions.periods import minus_months
from ledgerspark.functions.relations import m2o_id
from ledgerspark.operators.joins import semi_join_on
from ledgerspark.sources.landed import fetch, strict_on_or_after, text_on_or_after, text_on_or_before

# Invoice kinds extracted (customer invoices and refunds), the
# posted state, the product line type, the backfill start and
# the default order window in months.
INVOICE_MOVE_TYPES = ["out_invoice", "out_refund"]
POSTED = "posted"
PRODUCT_LINE = "product"
DEFAULT_INVOICE_START = "2023-01-01"
ORDER_WINDOW_MONTHS = 2


def clients_raw(partners: DataFrame, limit: int | None = None) -> DataFrame:
    """Active partners (the ERP hides archived partners by default)."""
    where = F.coalesce(F.col("active"), F.lit(True)) if "active" in partners.columns else None
    return fetch(partners, where=where, limit=limit)


def orders_raw(orders: DataFrame, asof=None, where=None) -> DataFrame:
    """S3: sale orders. Without an explicit ``where``, orders dated from
    ``asof`` minus two months (day clamped to the month end)."""
    if where is None:
        if asof is None:
            raise ValueError("orders_raw needs asof or an explicit where")
        where = text_on_or_after("date_order", minus_months(asof, ORDER_WINDOW_MONTHS))
    return fetch(orders, where=where)


def order_lines_raw(lines: DataFrame, asof=None, where=None) -> DataFrame:
    """Sale-order lines created from ``asof`` minus two months (line date)."""
    if where is None:
        if asof is None:
            raise ValueError("order_lines_raw needs asof or an explicit where")
        where = text_on_or_after("create_date", minus_months(asof, ORDER_WINDOW_MONTHS))
    return fetch(lines, where=where)


def products_raw(products: DataFrame, limit: int | None = None) -> DataFrame:
    """All products, archived ones included on purpose (no ``active`` filter)."""
    return fetch(products, limit=limit)


def taxes_raw(taxes: DataFrame, limit: int | None = None) -> DataFrame:
    """All taxes, or the first ``limit`` in source order."""
    return fetch(taxes, fields=["id", "name", "amount"], limit=limit)


def invoices_raw(moves: DataFrame, start=DEFAULT_INVOICE_START, end=None, strict: bool = False) -> DataFrame:
    """Posted customer invoices / refunds dated on or after ``start``.

    ``end`` (inclusive) is an optional extra bound pushed to the scan. Of an id
    dated on both sides of it, the row kept first may differ from a filter after
    the transform; the jobs that close a month filter afterwards. ``strict``
    raises on a date that cannot be parsed.
    """
    after = strict_on_or_after if strict else text_on_or_after
    where = (F.col("move_type").isin(*INVOICE_MOVE_TYPES) & (F.col("state") == POSTED)
             & after("invoice_date", start))
    if end is not None:
        where = where & text_on_or_before("invoice_date", end)
    return fetch(moves, where=where)


def posted_invoice_ids(moves: DataFrame) -> DataFrame:
    """Ids of posted customer invoices / refunds (the headers S8 traverses to)."""
    return (moves.where(F.col("move_type").isin(*INVOICE_MOVE_TYPES) & (F.col("state") == POSTED))
            .select(F.col("id").cast("bigint").alias("id")))


def invoice_line_scope(lines: DataFrame, start=DEFAULT_INVOICE_START, end=None, strict: bool = False) -> DataFrame:
    """S8's predicates on the line itself: product lines dated in [start, end] (``strict``: bad dates raise)."""
    where = (F.col("display_type") == PRODUCT_LINE) & (strict_on_or_after if strict else text_on_or_after)("date", start)
    if end is not None:
        where = where & text_on_or_before("date", end)
    return lines.where(where)


def invoice_lines_raw(lines: DataFrame, moves: DataFrame, start=DEFAULT_INVOICE_START,
                      end=None) -> DataFrame:
    """Product lines of posted customer invoices, line date in [start, end].

    The ERP evaluates ``move_id.move_type`` / ``move_id.state`` by following
    the relation; here that is a semi join to the qualifying header ids.
    Jobs that transform the lines anyway apply the same semi join after T5 on
    the parsed invoice id (``plans.jobs.invoice_lines_plan``).
    """
    scoped = invoice_line_scope(lines, start, end)
    key = m2o_id("move_id", lines.schema["move_id"].dataType)
    return semi_join_on(scoped, key, posted_invoice_ids(moves), "id")

"""Jobs Q1-Q12: sources -> transforms -> load policies.

Every job takes the landed raw tables as DataFrames, an explicit ``asof``
date and target locations, and returns what it did. The plan-building parts
are exposed separately (``*_plan`` functions) so they can be inspected with
``explain`` and checked without writing.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerspark import schemas
from ledgerspark.functions import list_length, parse_date, to_id
from ledgerspark.functions.periods import (backfill_range, is_close_day, month_start,
                                           previous_month)
from ledgerspark.operators import (SEQ, carry_over, discarded_invoiced, frequency, in_range,
                                   observed, top_n)
from ledgerspark.plans import transforms as tf
from ledgerspark.sinks import load, replace_months, upload_grid
from ledgerspark.sources import (clients_raw, invoice_lines_raw, invoices_raw, master_product_ids,
                                 order_lines_raw, orders_raw, products_raw, tax_ids, vendor_ids,
                                 visits_of_day)
from ledgerspark.operators.joins import semi_join_on
from ledgerspark.sources.erp import (DEFAULT_INVOICE_START, invoice_line_scope,
                                     posted_invoice_ids)
from ledgerspark.sources.landed import strict_on_or_after

# ------------------------------------------------------------ invoice headers


def closed_month_invoices_plan(moves: DataFrame, asof) -> DataFrame:
    """K6 rows: posted invoices of the month before ``asof``.

    The upper bound is applied after the transform, as in the reference (a
    duplicate id is resolved on all rows from the month start onwards).
    """
    pm = previous_month(asof)
    df = tf.invoices(invoices_raw(moves, start=pm.first))
    return df.where(in_range("fecha_factura", None, pm.last))


def current_month_invoices_plan(moves: DataFrame, asof) -> DataFrame:
    """K8 rows: posted invoices from the first day of ``asof``'s month (no upper bound)."""
    return tf.invoices(invoices_raw(moves, start=month_start(asof)))


def sync_invoices(moves: DataFrame, history: str, current: str, asof,
                  close_window_days: int = 1) -> dict:
    """Q1: on close days, replace last month in the history; every day, truncate-load
    the current month. Month replacement is idempotent, so no existence probe is needed."""
    done = {"closed": False}
    if is_close_day(asof, close_window_days):
        done["closed"] = replace_months(closed_month_invoices_plan(moves, asof), history,
                                        "fecha_factura")
    done["current"] = load(current_month_invoices_plan(moves, asof), current)
    return done


# -------------------------------------------------------------- invoice lines


def invoice_lines_plan(lines: DataFrame, moves: DataFrame, start, end=None,
                       with_date: bool = False, strict: bool = False, keep_seq: bool = False) -> DataFrame:
    """S8 + T5: transformed product lines of posted invoices dated in [start, end].

    Same rows as ``T5(S8(...))``: the header traversal and T5's filters are
    all row filters, so the semi join runs last, on the invoice id T5 already
    parsed -- the relation is parsed once and fewer, narrower rows reach the
    join's shuffle.
    """
    df = tf.invoice_lines(invoice_line_scope(lines, start, end, strict), with_date=with_date, keep_seq=keep_seq)
    return semi_join_on(df, F.col("id_factura"), posted_invoice_ids(moves), "id")


def sync_invoice_lines(lines: DataFrame, moves: DataFrame, history: str, current: str, asof,
                       close_window_days: int = 1) -> dict:
    """Q2: like Q1 for lines; the month partition comes from the line date."""
    done = {"closed": False}
    if is_close_day(asof, close_window_days):
        pm = previous_month(asof)
        closed = invoice_lines_plan(lines, moves, pm.first, pm.last, with_date=True)
        done["closed"] = replace_months(closed, history, "fecha", drop_date=True)
    done["current"] = load(invoice_lines_plan(lines, moves, month_start(asof)), current)
    return done


# --------------------------------------------------------------------- orders


def orders_carryover_plan(orders: DataFrame, asof) -> DataFrame:
    """Q3 rows: orders of the window, created this month or last month and not invoiced."""
    df = tf.orders(orders_raw(orders, asof))
    return df.where(carry_over("fecha_creacion", "estado_facturacion", asof))


def sync_orders(orders: DataFrame, target: str, asof) -> dict:
    """Q3 with its A7 counters, observed on the one pass that loads."""
    df = tf.orders(orders_raw(orders, asof))
    keep = carry_over("fecha_creacion", "estado_facturacion", asof)
    df, seen = observed(
        df, "orders", loaded=F.count_if(keep),
        discarded_invoiced=F.count_if(discarded_invoiced("fecha_creacion", "estado_facturacion", asof)))
    done = load(df.where(keep), target)
    return {"loaded": done, "metrics": seen.get}


def carryover_order_ids(orders: DataFrame, asof) -> DataFrame:
    """Ids of raw headers created since last month's start that carry over; an unparsable date raises."""
    m1 = previous_month(asof).first
    heads = orders_raw(orders, where=strict_on_or_after("create_date", m1))
    day = parse_date("create_date", heads.schema["create_date"].dataType)
    return (heads.where(carry_over(day, F.col("invoice_status"), asof))
            .select(to_id("id", heads.schema["id"].dataType).alias("id")))


def order_lines_carryover_plan(orders: DataFrame, lines: DataFrame, asof) -> DataFrame:
    """Q4 rows: lines of the last two months whose order carries over (none if no order does)."""
    ids = carryover_order_ids(orders, asof)
    return tf.order_lines(order_lines_raw(lines, asof), orders=ids, empty_orders="none")


def sync_order_lines(orders: DataFrame, lines: DataFrame, target: str, asof) -> dict:
    """Q4: without carry-over orders nothing is loaded."""
    return {"loaded": load(order_lines_carryover_plan(orders, lines, asof), target)}


# ------------------------------------------------------------ clients, products


def sync_clients(partners: DataFrame, vendors: DataFrame, target: str,
                 tags: Mapping[int, str] | DataFrame | None = None) -> dict:
    """Q5: active partners -> clients restricted to the vendor list (empty = all)."""
    df = tf.clients(clients_raw(partners), tags=tags or {}, vendors=vendor_ids(vendors))
    return {"loaded": load(df, target)}


def sync_products(products: DataFrame, master: DataFrame, taxes: DataFrame,
                  products_target: str, bridge_target: str) -> dict:
    """Q6: products (one per master id) and the product-tax bridge, both schema-checked.

    Two independent plans over the same scan; the bridge is written even when
    the product table was, but an empty result skips its write (D8).
    """
    raw = products_raw(products)
    m = master_product_ids(master)
    prods = tf.products(raw, m)
    if not load(prods, products_target, schema=schemas.PRODUCTS):
        return {"products": False, "bridge": False}
    bridge = tf.product_taxes(raw, m, tax_ids(taxes))
    return {"products": True,
            "bridge": load(bridge, bridge_target, schema=schemas.PRODUCT_TAXES)}


# --------------------------------------------------------------------- sheets


def _from_month(start, asof) -> str:
    """The later of ``start`` and the first day of ``asof``'s month, as ISO text."""
    return max(str(start)[:10], month_start(asof).isoformat())


def invoices_sheet_plan(moves: DataFrame, asof, start=DEFAULT_INVOICE_START, keep_seq: bool = False) -> DataFrame:
    """Q7 rows: posted invoices, raw date in the current month (pushed to the scan; an unparsable one raises), transformed."""
    return tf.invoices(invoices_raw(moves, start=_from_month(start, asof), strict=True), keep_seq=keep_seq)


def sync_invoices_sheet(moves: DataFrame, path: str, asof) -> dict:
    """Q7: one grid in source order."""
    return {"loaded": upload_grid(invoices_sheet_plan(moves, asof, keep_seq=True), path, [SEQ])}


def invoice_lines_sheet_plan(lines: DataFrame, moves: DataFrame, asof,
                             start=DEFAULT_INVOICE_START, keep_seq: bool = False) -> DataFrame:
    """Q8 rows: product lines of posted invoices dated in the current month (pushed to the scan; a bad date raises)."""
    return invoice_lines_plan(lines, moves, _from_month(start, asof), strict=True, keep_seq=keep_seq)


def sync_invoice_lines_sheet(lines: DataFrame, moves: DataFrame, path: str, asof) -> dict:
    """Q8: one grid in source order."""
    return {"loaded": upload_grid(invoice_lines_sheet_plan(lines, moves, asof, keep_seq=True), path, [SEQ])}


def sync_products_sheet(products: DataFrame, master: DataFrame, path: str) -> dict:
    """Q9: products to a grid by master id; dates are formatted like the other sheets."""
    prods = tf.products(products_raw(products), master_product_ids(master))
    return {"loaded": upload_grid(prods, path, ["id_producto_padre"])}


# ------------------------------------------------------------------- backfill


def backfill_invoices_plan(moves: DataFrame, asof, start=DEFAULT_INVOICE_START) -> DataFrame:
    """K9 rows: what the month-by-month loop stores for [start, last day of the previous month], in one pass."""
    rng = backfill_range(start, asof)
    df = tf.invoices(invoices_raw(moves, start=rng.first), by_month=True)
    return df.where(in_range("fecha_factura", rng.first, rng.last))


def backfill_invoice_lines_plan(lines: DataFrame, moves: DataFrame, asof,
                                start=DEFAULT_INVOICE_START) -> DataFrame:
    rng = backfill_range(start, asof)
    return invoice_lines_plan(lines, moves, rng.first, rng.last, with_date=True)


def backfill(moves: DataFrame, lines: DataFrame, headers_target: str, lines_target: str, asof,
             start=DEFAULT_INVOICE_START) -> dict:
    """Q10: the historical load in a single pass per table, partitioned by month.

    The reference loops month by month and re-extracts from each month's start
    to today (quadratic); one range scan that resolves ids month by month is equivalent.
    """
    return {
        "headers": replace_months(backfill_invoices_plan(moves, asof, start), headers_target,
                                  "fecha_factura"),
        "lines": replace_months(backfill_invoice_lines_plan(lines, moves, asof, start),
                                lines_target, "fecha", drop_date=True),
    }


# ------------------------------------------------------------ profile, visits


def tax_array_sample(lines: DataFrame, moves: DataFrame, n: int | None,
                     start=DEFAULT_INVOICE_START) -> DataFrame:
    """Q11 sample: the ``n`` newest invoice lines by id (a top-k, not a sort); all lines with None."""
    sample = invoice_lines_raw(lines, moves, start=start)
    if n is not None:
        sample = top_n(sample, n, [F.col("id").desc_nulls_last(), F.col("_seq").desc()])
    return sample.select("id", "move_id", "tax_ids", "price_unit", "price_subtotal")


def tax_array_profile(lines: DataFrame, moves: DataFrame, n: int | None,
                      start=DEFAULT_INVOICE_START) -> DataFrame:
    """Q11: how many taxes the sampled lines carry (value counts of list length)."""
    sample = tax_array_sample(lines, moves, n, start)
    return frequency(sample, list_length("tax_ids"), "n_taxes")


def route_visits(payloads: DataFrame, day) -> DataFrame:
    """Q12: the visits planned on ``day``."""
    return visits_of_day(payloads, day)

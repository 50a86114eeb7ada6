"""The daily jobs on snapshot stores: increments, months closed as one unit, a backfill that resumes."""

from __future__ import annotations

import datetime as dt
from typing import Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerspark.functions import street_key
from ledgerspark.functions.periods import as_date, backfill_range, current_month, month_start, previous_month
from ledgerspark.operators import in_range
from ledgerspark.operators.increments import BUCKETS, merge, mirror, state
from ledgerspark.operators.membership import member_of
from ledgerspark.plans import jobs, transforms as tf
from ledgerspark.sinks.snapshots import Snapshots
from ledgerspark.sinks.tables import MONTH, with_month
from ledgerspark.sources import clients_raw, invoices_raw, order_lines_raw, orders_raw, products_raw, vendor_ids
from ledgerspark.sources.erp import DEFAULT_INVOICE_START

#: Tables: what is merged by key, and the histories by month.
CLIENTS, INVOICES, VARIANTS, ORDERS, ORDER_LINES = "clients", "invoices", "variants", "sale_orders", "sale_order_lines"
HEAD_HISTORY, LINE_HISTORY = "invoice_history", "invoice_line_history"
_STREET = "_calle_key"

# ---------------------------------------------------- keep-first by increments


def add_clients(store: Snapshots, landed: DataFrame, tags: Mapping[int, str] | DataFrame | None = None,
                batch: tuple[str, int] | None = None, buckets: int = BUCKETS) -> dict:
    """A3 for a new landing of partners. Vendors are chosen on reading, so the list may change."""
    rows = tf.clients(clients_raw(landed), tags=tags or {}, keep_seq=True).withColumn(_STREET, street_key("calle"))
    return merge(store.at(CLIENTS), rows, ["rut", _STREET, "id_vendedor"], batch=batch, buckets=buckets)


def clients(store: Snapshots, vendors: DataFrame | None = None) -> DataFrame:
    """T1 of everything landed so far (J2 keeps or drops whole keys, so it may come last)."""
    rows = state(store.at(CLIENTS)).drop(_STREET, "_seq")
    return rows if vendors is None else member_of(rows, "id_vendedor", vendor_ids(vendors), empty="all")


def add_invoices(store: Snapshots, landed: DataFrame, start=DEFAULT_INVOICE_START,
                 batch: tuple[str, int] | None = None, buckets: int = BUCKETS) -> dict:
    """A4 for a new landing of invoice headers."""
    rows = tf.invoices(invoices_raw(landed, start=start), keep_seq=True)
    return merge(store.at(INVOICES), rows, ["id_factura"], batch=batch, buckets=buckets)


def invoices(store: Snapshots) -> DataFrame:
    """T4 of everything landed so far."""
    return state(store.at(INVOICES)).drop("_seq")


def add_products(store: Snapshots, landed: DataFrame, batch: tuple[str, int] | None = None, buckets: int = BUCKETS) -> dict:
    """A5 for a new landing of products: the first variant of each parent, as raw rows for T6."""
    raw = products_raw(landed)
    parent = tf.parent_id(raw)
    rows = raw.withColumn("_parent", parent).where("_parent IS NOT NULL")
    return merge(store.at(VARIANTS), rows, ["_parent"], batch=batch, buckets=buckets)


def products(store: Snapshots, master: DataFrame) -> DataFrame:
    """T6 of everything landed so far."""
    return tf.products(state(store.at(VARIANTS)).drop("_parent"), master)


# --------------------------------------------------------- incremental extracts


def mirror_orders(store: Snapshots, orders: DataFrame, lines: DataFrame | None = None, late_days: int = 2) -> dict:
    """Records written since the last run replace those of the same id."""
    done = {ORDERS: mirror(store.at(ORDERS), orders, late_days=late_days)}
    if lines is not None:
        done[ORDER_LINES] = mirror(store.at(ORDER_LINES), lines, late_days=late_days)
    return done


def mirrored_orders(store: Snapshots, asof) -> DataFrame:
    """T2 of S3 on the mirror."""
    return tf.orders(orders_raw(state(store.at(ORDERS)), asof))


def mirrored_order_lines(store: Snapshots, asof) -> DataFrame:
    """T3 of S4 on the mirror."""
    return tf.order_lines(order_lines_raw(state(store.at(ORDER_LINES)), asof))


# ---------------------------------------------------------- months of two tables


def close_month(store: Snapshots, moves: DataFrame, lines: DataFrame, asof, batch: tuple[str, int] | None = None) -> bool:
    """K6 and K7 as one unit: headers and lines of the month before ``asof`` appear together or not at all."""
    month = previous_month(asof)
    change = store.begin(batch)
    heads = jobs.closed_month_invoices_plan(moves, asof)
    change.replace(HEAD_HISTORY, with_month(heads, "fecha_factura"), MONTH, checksums=True)
    closed = jobs.invoice_lines_plan(lines, moves, month.first, month.last, with_date=True)
    change.replace(LINE_HISTORY, with_month(closed, "fecha").drop("fecha"), MONTH, checksums=True)
    return change.commit()


def months(first, last) -> list[dt.date]:
    """First days of the months from ``first``'s to ``last``'s."""
    at, out = month_start(first), []
    while at <= as_date(last):
        out.append(at)
        at = current_month(at).last + dt.timedelta(days=1)
    return out


def missing_months(store: Snapshots, asof, start=DEFAULT_INVOICE_START) -> list[dt.date]:
    """Months of the backfill that one of the tables has not, or whose rows are not those recorded."""
    wanted = [m.isoformat() for m in months(*backfill_range(start, asof))]
    good = [{p["key"] for p in store.parts(t)} - set(store.broken(t)) for t in (HEAD_HISTORY, LINE_HISTORY)]
    return [dt.date.fromisoformat(m) for m in wanted if not all(m in g for g in good)]


def resume_backfill(store: Snapshots, moves: DataFrame, lines: DataFrame, asof, start=DEFAULT_INVOICE_START,
                    months_per_commit: int = 12) -> list[str]:
    """K9 / Q10 in steps of some months, each published with its counts and checksums.

    A run that follows an interrupted one computes only the months that are missing or whose
    rows are not those recorded; a month without rows is recorded as empty. Returns the months computed.
    """
    todo = missing_months(store, asof, start)
    for at in range(0, len(todo), months_per_commit):
        step = todo[at:at + months_per_commit]
        first, last = max(step[0], as_date(start)), current_month(step[-1]).last
        chosen = F.col(MONTH).isin(*step)
        heads = tf.invoices(invoices_raw(moves, start=first), by_month=True).where(in_range("fecha_factura", first, last))
        own = jobs.invoice_lines_plan(lines, moves, first, last, with_date=True)
        keys = [m.isoformat() for m in step]
        change = store.begin()
        change.replace(HEAD_HISTORY, with_month(heads, "fecha_factura").where(chosen), MONTH, keys, checksums=True)
        change.replace(LINE_HISTORY, with_month(own, "fecha").drop("fecha").where(chosen), MONTH, keys, checksums=True)
        change.commit()
    return [m.isoformat() for m in todo]

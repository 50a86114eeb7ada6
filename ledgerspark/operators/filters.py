"""Business filters (P1-P7) as predicates; the caller applies them with ``where``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerspark.functions.periods import as_date, month_start, previous_month


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def not_person_contact(company_type="tipo_compania", address_type="tipo_direccion") -> Column:
    """Drop individual contacts (company_type 'person' AND type 'contact')."""
    return ~((_c(company_type) == "person") & (_c(address_type) == "contact"))


def is_posted(state="estado") -> Column:
    """Posted documents only."""
    return _c(state) == "posted"


def all_present(*cols) -> Column:
    """Every listed column is non-null."""
    out = F.lit(True)
    for c in cols:
        out = out & _c(c).isNotNull()
    return out


def non_zero(col="total") -> Column:
    """Drop zero totals (negative totals stay)."""
    return _c(col) != 0


def in_range(col, first=None, last=None) -> Column:
    """P5: inclusive date range; either bound may be open."""
    c = _c(col)
    out = F.lit(True)
    if first is not None:
        out = out & (c >= F.lit(as_date(first)))
    if last is not None:
        out = out & (c <= F.lit(as_date(last)))
    return out


def carry_over(day, status, asof, invoiced: str = "invoiced") -> Column:
    """Created this month, or created last month and not yet invoiced.

    A null day never matches; a null or empty status counts as not invoiced.
    """
    d = _c(day)
    m0 = F.lit(month_start(asof))
    m1 = F.lit(previous_month(asof).first)
    this_month = d >= m0
    last_month_open = (d >= m1) & (d < m0) & ~F.coalesce(_c(status) == invoiced, F.lit(False))
    return F.coalesce(this_month | last_month_open, F.lit(False))


def discarded_invoiced(day, status, asof, invoiced: str = "invoiced") -> Column:
    """A7 helper: last month's orders dropped because they were invoiced."""
    d = _c(day)
    m0 = F.lit(month_start(asof))
    m1 = F.lit(previous_month(asof).first)
    return F.coalesce((d >= m1) & (d < m0) & (_c(status) == invoiced), F.lit(False))

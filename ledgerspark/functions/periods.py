"""Period bounds computed from an explicit ``asof`` date.

These are scalar job parameters (literals in the plan), so Catalyst can push
every bound into the parquet scan. ``current_date()`` is never used inside an
operator: the caller passes ``asof``.
"""

from __future__ import annotations

import calendar
import datetime as dt
from typing import NamedTuple


class Period(NamedTuple):
    first: dt.date
    last: dt.date


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def minus_months(asof, n: int) -> dt.date:
    """``asof`` minus ``n`` months, day clamped to the month end (2024-04-30 - 2 = 2024-02-29)."""
    d = as_date(asof)
    months = d.year * 12 + (d.month - 1) - n
    y, m = divmod(months, 12)
    m += 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def month_start(asof) -> dt.date:
    return as_date(asof).replace(day=1)


def current_month(asof) -> Period:
    """First and last day of the month holding ``asof``."""
    first = month_start(asof)
    return Period(first, dt.date(first.year, first.month,
                                 calendar.monthrange(first.year, first.month)[1]))


def previous_month(asof) -> Period:
    """First and last day of the month before ``asof``'s month."""
    last = month_start(asof) - dt.timedelta(days=1)
    return Period(last.replace(day=1), last)


def backfill_range(start, asof) -> Period:
    """Inclusive range from ``start`` to the last day of the month before ``asof``."""
    return Period(as_date(start), previous_month(asof).last)


def is_close_day(asof, window_days: int = 1) -> bool:
    """Month close runs on the first ``window_days`` days of a month."""
    return as_date(asof).day <= window_days

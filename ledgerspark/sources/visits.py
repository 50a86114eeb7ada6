"""Route visits of a day from landed API payloads.

A payload is either a JSON list of visits or an object whose ``results`` key
holds the list; anything else counts as no visits. Each payload row is parsed
and exploded in place (no shuffle); the day filter is on ``planned_date``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark import schemas
from ledgerspark.functions.text import (strip_ws, visit_reference, visit_status_flag,
                                        visit_title)

_VISIT_LIST = f"array<{schemas.VISIT.simpleString()}>"
_VISIT_PAGE = f"struct<results:{_VISIT_LIST}>"


def visit_list(payload) -> "F.Column":
    """Payload text -> ``array<visit>``: a list as is, else ``results``, else empty.

    ``coalesce(list, object.results)`` would be wrong: Spark reads an object
    as a one-element list of nulls, so the shape is decided from the text.
    """
    p = F.col(payload) if isinstance(payload, str) else payload
    s = strip_ws(p)
    as_list = F.from_json(s, _VISIT_LIST)
    as_page = F.from_json(s, _VISIT_PAGE).getField("results")
    return F.coalesce(F.when(s.startswith("["), as_list)
                      .when(s.startswith("{"), as_page),
                      F.array().cast(_VISIT_LIST))


def visits_of_day(payloads: DataFrame, day, payload_col: str = "payload") -> DataFrame:
    """All visits planned on ``day`` (ISO date), one row per visit."""
    d = str(day)[:10]
    v = payloads.select(F.explode(visit_list(payload_col)).alias("v")).select("v.*")
    return v.where(F.substring(F.col("planned_date"), 1, 10) == F.lit(d))


def visit_listing(visits: DataFrame) -> DataFrame:
    """The listing columns -- status icon, reference and title with defaults."""
    return visits.select(
        "id", "status",
        visit_status_flag("status").alias("icon"),
        visit_reference("reference").alias("referencia"),
        visit_title("title").alias("titulo"),
        "planned_date")

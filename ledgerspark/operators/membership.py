"""Membership filters.

``member_of`` keeps rows whose column value is in an id list. The list is
either a Python sequence (a literal ``IN``; long lists belong in a DataFrame) or
a DataFrame (a semi join; the planner and AQE pick broadcast only after checking
the list's size). Building the plan runs no job.

Two empty-list policies exist in the reference and both are kept:

* ``empty="all"``  (J2-J4): an empty or missing list means *no filter*;
* ``empty="none"`` (J6): an empty list keeps *no rows*.

A null value never matches.
"""

from __future__ import annotations

from typing import Sequence, Union

from pyspark.sql import Column, DataFrame, functions as F

IdList = Union[None, Sequence[int], DataFrame]


def _clean_ids(ids: Sequence) -> list[int]:
    out = []
    for v in ids:
        if v is None:
            continue
        try:
            f = float(v)
        except (TypeError, ValueError):
            continue
        if f != f or f in (float("inf"), float("-inf")):
            continue
        out.append(int(f))
    return sorted(set(out))


def member_of(df: DataFrame, column: Union[str, Column], ids: IdList,
              empty: str = "all", id_column: str | None = None) -> DataFrame:
    """Keep rows whose ``column`` is in ``ids`` (see module doc for ``empty``)."""
    if empty not in ("all", "none"):
        raise ValueError("empty must be 'all' or 'none'")
    col = F.col(column) if isinstance(column, str) else column
    if ids is None:
        return df if empty == "all" else df.where(F.lit(False))
    if isinstance(ids, DataFrame):
        name = id_column or ids.columns[0]
        id_df = ids.select(F.col(name).cast("bigint").alias("_member_id")) \
            .where(F.col("_member_id").isNotNull())
        if empty == "none":
            return df.join(id_df, col == F.col("_member_id"), "left_semi")
        # an empty list is decided at run time, by a scalar subquery
        keyed = df.withColumn("_member_key", col)
        found = id_df.where(F.col("_member_id") == F.col("_member_key").outer()).exists()
        return keyed.where(~id_df.exists() | found).drop("_member_key")
    clean = _clean_ids(ids)
    if not clean:
        return df if empty == "all" else df.where(F.lit(False))
    return df.where(col.isin(clean))

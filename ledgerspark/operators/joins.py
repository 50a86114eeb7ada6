"""Joins of the reference (J1, J7) and the product-tax bridge explode (G1)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.operators.dedup import SEQ, keep_first


def first_per_key(df: DataFrame, key: str, order: str = SEQ) -> DataFrame:
    """A5: the first row (source order) for each non-null ``key`` value."""
    return keep_first(df.where(F.col(key).isNotNull()), [key], order)


def left_from_master(master: DataFrame, master_key: str, detail: DataFrame,
                     detail_key: str, order: str = SEQ) -> DataFrame:
    """Every master row, with the first matching detail row (or nulls).

    The master decides cardinality. The detail side is reduced to one row per
    key *before* the join (same result as join-then-dedup, smaller join); the
    join strategy is left to the planner, which broadcasts a side only when its
    measured size is under the broadcast threshold.
    """
    firsts = first_per_key(detail, detail_key, order)
    return master.join(firsts, master[master_key] == firsts[detail_key], "left")


def semi_join_on(df: DataFrame, key: Column, other: DataFrame, other_key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` appears in ``other[other_key]``.

    Used for relation traversal (lines whose header qualifies). AQE splits a
    skewed left partition of a semi join, so one huge header does not serialise
    the job on a single task.
    """
    ids = other.select(F.col(other_key).alias("_join_id")).where(F.col("_join_id").isNotNull())
    return df.join(ids, key == F.col("_join_id"), "left_semi")

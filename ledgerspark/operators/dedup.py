"""Keep-first deduplication (A3, A4, A5).

``drop_duplicates(keep="first")`` keeps, per key, the row that comes first in
source order. Source order must be explicit on Spark: every landed table has a
unique, non-null sequence column (``_seq``). Null key values compare equal.

Plan: one aggregation, ``groupBy(keys).agg(min(struct(_seq, <other columns>)))``.
Structs compare field by field, so the minimum is the whole first row. The
aggregation runs map-side first (partial aggregation), so a key holding a
third of all rows leaves at most one row per map task before the shuffle; one
scan and one shuffle in total.

A ``row_number()`` window would send every row of a hot key to one task and
sort it there; a min(_seq) aggregate plus a semi join back would scan and
parse the input twice.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

SEQ = "_seq"


def require_order(df: DataFrame, order: str = SEQ) -> None:
    if order not in df.columns:
        raise ValueError(
            f"keep-first needs the source-order column {order!r}; "
            "land a unique sequence column with every raw table")


def keep_first(df: DataFrame, keys: Sequence[str], order: str = SEQ) -> DataFrame:
    """Rows that come first in ``order`` among rows with equal ``keys``.

    ``order`` must be unique and non-null (a source sequence). Column order
    and types of ``df`` are kept.
    """
    require_order(df, order)
    others = [c for c in df.columns if c not in keys and c != order]
    first = F.min(F.struct(order, *others)).alias("_first")
    return (df.groupBy(*keys).agg(first)
            .select(*keys, *[F.col("_first")[c].alias(c) for c in [order] + others])
            .select(*df.columns))

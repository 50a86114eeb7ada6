"""Keyed state that grows by increments (A3, A4, A5 across landings; S3, S4 as a mirror).

The state holds one row per key in a snapshot table, in parts by a hash of the key. An
increment is first reduced to one row per key (an aggregate with map-side combine, so a hot
key leaves one row a task), then joined with the state: only rows that win over the state's
row, and the parts they fall into, are written again. Merging increments in any order gives
what one run over all of them gives, because the least (or greatest) of the order wins
wherever it comes from. The new parts and the batch's ledger entry are published together.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.operators.dedup import SEQ, require_order
from ledgerspark.sinks.snapshots import Table

BUCKET = "_bucket"
BUCKETS = 64


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, nulls equal; the bucket comes first, as a plain equality."""
    return reduce(lambda x, y: x & y, [a[BUCKET] == b[BUCKET], *[a[k].eqNullSafe(b[k]) for k in keys]])


def best_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool = False) -> DataFrame:
    """One row per key (nulls equal): the first by ``order``, or the last."""
    for c in order:
        require_order(rows, c)
    others = [c for c in rows.columns if c not in keys and c not in order]
    best = (F.max if latest else F.min)(F.struct(*order, *others)).alias("_best")
    return rows.groupBy(*keys).agg(best).select(*[c if c in keys else F.col("_best")[c].alias(c) for c in rows.columns])


def merge(target: Table, rows: DataFrame, keys: Sequence[str], order: Sequence[str] = (SEQ,), latest: bool = False,
          buckets: int = BUCKETS, batch: tuple[str, int] | None = None, marks: dict[str, str] | None = None) -> dict:
    """Merge an increment into the state: per key the first row by ``order`` (or the last) stays.

    ``buckets`` holds for the table's life. ``marks`` (mark -> column) leaves the greatest value of
    a column that has been merged, also with the rows. Returns the rows that changed and the parts rewritten.
    """
    store, name = target.store, target.name
    change = store.begin(batch, exclusive=True)
    if change.done_before():
        return {"changed": 0, "parts": 0}
    version = change.base["version"]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    new = change.staged(best_per_key(rows, keys, order, latest).select("*", bucket), f"{name}-increment")
    if store.has(name, version):
        old = store.table(name, version)
        ours, theirs = F.struct(*[new[c] for c in order]), F.struct(*[old[c] for c in order])
        wins = old[BUCKET].isNull() | ((ours > theirs) if latest else (ours < theirs))
        changed = change.staged(new.join(old, _same(new, old, keys), "left").where(wins).select(*[new[c] for c in new.columns]), f"{name}-changed")
        touched = [str(r[0]) for r in changed.select(BUCKET).distinct().collect()]  # at most ``buckets`` numbers
        if touched:
            kept = store.table(name, version, touched)
            kept = kept.join(changed.select(BUCKET, *keys), _same(kept, changed, keys), "left_anti")
            change.replace(name, kept.unionByName(changed), BUCKET)
    else:
        changed = new
        touched = [str(r[0]) for r in changed.select(BUCKET).distinct().collect()]
        if touched:
            change.replace(name, changed, BUCKET)
    for mark, column in (marks or {}).items():
        greatest = new.agg(F.max(column).cast("string")).first()[0]
        before = change.base["marks"].get(mark)
        if greatest is not None:
            change.note(mark, max(greatest, before or greatest))
    n = changed.count()
    change.commit()
    return {"changed": n, "parts": len(touched)}


def state(target: Table, version: int | None = None) -> DataFrame:
    """The rows of a merged table."""
    return target.read(version).drop(BUCKET)


def changed_since(source: DataFrame, column: str, mark: str | None, late_days: int) -> DataFrame:
    """Rows whose ISO text ``column`` is not before ``mark`` less ``late_days``; all rows without a mark.

    A plain comparison of the raw column, so the scan gets it. Rows without a time are always read.
    """
    if mark is None:
        return source
    first = dt.date.fromisoformat(mark[:10]) - dt.timedelta(days=late_days)
    return source.where((F.col(column) >= F.lit(first.isoformat())) | F.col(column).isNull())


def mirror(target: Table, source: DataFrame, key: str = "id", changed: str = "write_date", late_days: int = 2,
           buckets: int = BUCKETS, batch: tuple[str, int] | None = None) -> dict:
    """Bring a mirror of ``source`` up to date: the last written record of each id.

    Only records written since the high-water mark are read, less ``late_days`` for records that
    land after later ones; reading one again changes nothing. Of equal times the greater ``_seq`` wins.
    """
    mark = f"{target.name}.{changed}"
    rows = changed_since(source, changed, target.store.mark(mark), late_days)
    return merge(target, rows, [key], [changed, SEQ], latest=True, buckets=buckets, batch=batch, marks={mark: changed})

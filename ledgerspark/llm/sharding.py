"""Ordered shards of about equal bytes, the same in every run."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of the histogram for each shard.
BINS_PER_SHARD = 16
#: Most shards, and most tasks that they are dealt to; larger inputs have larger shards.
MAX_TASKS = 50_000


def one_per_task(rows: DataFrame, shards: int, col: str) -> DataFrame:
    """``rows`` with shard ``col`` in task ``col`` (by number, not by hash, so no task gets two by chance)."""
    return rows.repartitionById(max(1, min(shards, MAX_TASKS)), col)


def _even(low: int, high: int, bins: int) -> list[int]:
    """First values of at most ``bins`` equal parts of [low, high]."""
    width = max(1, -(-(high - low + 1) // bins))
    return list(range(low, high + 1, width))


def _into_bins(edges: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sizes = (b.column(i).to_numpy() for i in (0, 1))
            if not len(ids):
                continue
            order = np.argsort(ids, kind="stable")
            ids, sizes = ids[order], sizes[order]
            bins = np.searchsorted(edges, ids, side="right") - 1
            first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
            last = np.append(first[1:], len(bins)) - 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (bins[first], np.add.reduceat(sizes, first), ids[first], ids[last])],
                                             names=["bin", "s", "low", "high"])

    return count


def step_of(total: int, shard_bytes: int) -> int:
    """Bytes of a shard: ``shard_bytes``, or more where there would be over MAX_TASKS shards."""
    return max(shard_bytes, -(-total // MAX_TASKS))


def shard_bounds(light: DataFrame, col: str, size: str, shard_bytes: int) -> np.ndarray:
    """First ids of the shards after the first: ``light`` (a written table) ordered by ``col``, cut about every
    ``shard_bytes`` of ``size`` (see ``step_of``).

    From a histogram over the ids, so the cuts depend on the data only (Spark's own range partitioning samples, and
    its cuts differ between runs). A bin that is heavier than a shard is divided again between its least and its greatest
    id, so outliers cost another pass over the ids, not a heavy shard. A shard holds under two steps, or a single id
    with all its rows. There are at most MAX_TASKS bounds and some 16 bins for each, whatever the input: the driver
    gets 32 bytes for every bin that has rows.
    """
    low, high, total = light.agg(F.min(col), F.max(col), F.sum(size)).first()
    if not total:
        return np.zeros(0, np.int64)
    step = step_of(int(total), shard_bytes)
    edges = np.array(_even(int(low), int(high), -(-int(total) // step) * BINS_PER_SHARD), np.int64)
    rows = light.select(F.col(col).cast("long"), F.col(size).cast("long"))
    while True:
        parts = rows.mapInArrow(_into_bins(edges), "bin long, s long, low long, high long")
        bins = parts.groupBy("bin").agg(F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow().sort_by("bin")
        s, lows, highs = (bins.column(c).to_numpy() for c in ("s", "low", "high"))
        heavy = np.flatnonzero((s > step) & (lows < highs))
        if not len(heavy):
            break
        finer = [_even(int(lows[k]), int(highs[k]), -(-int(s[k]) // step) * BINS_PER_SHARD) for k in heavy]
        edges = np.unique(np.concatenate([lows, *(np.array(f, np.int64) for f in finer)]))
    shard = (np.cumsum(s) - s) // step
    return lows[np.flatnonzero(shard[1:] != shard[:-1]) + 1]

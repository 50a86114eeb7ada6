"""Connected components of a graph given as a DataFrame of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import ship, written

#: Links that one union-find holds at a time.
CHUNK = 1 << 20


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over about CHUNK links: each node of them linked to its smallest."""

    def solve(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        names, at = np.unique(np.concatenate((u, v)), return_inverse=True)
        parent = list(range(len(names)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(at[:len(u)].tolist(), at[len(u):].tolist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        root = np.array([find(x) for x in range(len(names))], np.int64)
        out = np.flatnonzero(root != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(names[out]), pa.array(names[root[out]])], names=["u", "v"])

    us, vs, n = [], [], 0
    for b in batches:
        us.append(b.column("u").to_numpy())
        vs.append(b.column("v").to_numpy())
        n += len(us[-1])
        if n >= CHUNK:
            yield solve(np.concatenate(us), np.concatenate(vs))
            us, vs, n = [], [], 0
    if n:
        yield solve(np.concatenate(us), np.concatenate(vs))


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node that each linked node can reach.

    ``links`` has long columns u and v. Union-find within tasks leaves a forest of
    the links that each has read; then alternating star rounds: every node hands
    its smallest neighbour to the larger ones (large star), then to the smaller ones
    (small star), until nothing moves. No task gets more than the links of a few
    nodes' partial minima: minima are aggregated map-side, and the joins are plain.
    """
    ship(links.sparkSession)
    forest = links.where("u <> v").mapInArrow(_forest, "u long, v long")
    edges = written(forest.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        # large star: the larger neighbours of x go to the smallest of x and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "links-large")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "links-step")
        # small star: the smaller neighbours of x, and x, go to the smallest of them
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "links-small")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        small = written(small, "links")
        same = small.count() == edges.count() and small.exceptAll(edges).isEmpty()
        edges = small
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

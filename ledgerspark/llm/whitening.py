"""Operator 11: whitening of embeddings.

An entry c becomes the integer ``x = floor(scale * c) + offset``; the *fit list* is every
distinct integer vector once. The work on rows is Spark's; the driver only sees the
sums and the covariance of a dimension (d and d x d numbers whatever the input).

1. Distinct vectors: a shuffle with map-side combine, so a very common vector leaves one row a task.
2. Exact sums per dimension (two halves of each integer, added up as decimals).
3. Centred covariance: each task multiplies its centred block, the products are added up by
   entry. A vector is centred through an integer pivot near the mean, ``x - p - r/n`` with
   ``S = n*p + r``, so no digits are lost to the offset.
4. Driver: Householder tridiagonalisation, bisection on Sturm counts for the leading
   eigenvalues, inverse iteration on the tridiagonal matrix; components of a cluster of close
   eigenvalues are made orthogonal to each other; then the reflections are undone.
5. Projection of every row: pivot, remainder and components travel with the tasks (17 d numbers).

Defined cases. Rows whose vector is null or holds a null or non-finite entry are dropped.
Vectors of different lengths are whitened apart, each length with its own fit list; empty
vectors have no components and give no rows. Repeated rows count once in the fit list and
each gives its own result rows; ids may be null or repeat. Equal eigenvalues: any orthonormal
basis, fixed by the algorithm. Directions without variance (eigenvalue not above 1e-12 of the
greatest, so that all of a lone vector's) have no whitened value: such components are left
out. The sign of a component makes its largest entry positive. Entries beyond 2**60 after
scaling count as 2**60; a deviation that no long holds is null. An empty table gives an empty
result. Only ``vec_id`` and ``embedding`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.common import ship, written

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
MOST = 2**60
HALF_BITS = 30
#: Eigenvalues below this share of the greatest count as zero.
NO_VARIANCE = 1e-12

# --------------------------------------------------------------- integer vectors


def _integers(scale: int, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _vectors(batch.column("embedding"), scale, offset):
                yield _table(batch.column("vec_id").take(pa.array(rows)), x)
    return run


def _vectors(column: pa.Array, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per vector length: the row numbers of usable vectors and their integers as a matrix."""
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    flat = column.flatten().cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (broken[starts[1:]] == broken[starts[:-1]]) & (lengths > 0)
    for d in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == d))
        block = np.floor(values[starts[rows][:, None] + np.arange(d)] * scale)
        yield rows, np.clip(block, -MOST, MOST).astype(np.int64) + offset


def _table(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.int32()), pa.array(x.ravel()))
    return pa.RecordBatch.from_arrays([ids, pa.array(np.full(len(x), x.shape[1], np.int32)), lists], ["vec_id", "d", "x"])


def integers(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, d (length) and x (array of longs) of the rows with a usable vector."""
    ship(rows.sparkSession)
    id_type = rows.schema["vec_id"].dataType.simpleString()
    vectors = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return vectors.mapInArrow(_integers(scale, offset), f"vec_id {id_type}, d int, x array<long>")


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(d, row numbers, matrix) per vector length in a batch of ``d`` and ``x``."""
    ds = batch.column("d").to_numpy()
    starts = np.concatenate([[0], np.cumsum(ds, dtype=np.int64)])
    flat = batch.column("x").flatten().to_numpy()
    for d in np.unique(ds):
        rows = np.flatnonzero(ds == d)
        yield int(d), rows, flat[starts[rows][:, None] + np.arange(d)]


# ------------------------------------------------------------- sums over the rows


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for d, rows, x in _matrices(batch):
            high, low = x >> HALF_BITS, x & (2**HALF_BITS - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, len(rows), np.int64)),
                 pa.array(high.sum(axis=0)), pa.array(low.sum(axis=0))], ["d", "j", "n", "high", "low"])


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """d -> (rows, exact sum of each dimension)."""
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    parts = fit.select("d", "x").mapInArrow(_sum_parts, "d int, j int, n long, high long, low long")
    found: dict[int, tuple[int, list[int]]] = {}
    for row in parts.groupBy("d", "j").agg(F.sum("n").alias("n"), exact("high"), exact("low")).orderBy("d", "j").collect():
        found.setdefault(row["d"], (row["n"], []))[1].append((int(row["high"]) << HALF_BITS) + int(row["low"]))
    return found


@dataclass
class Model:
    """What whitens vectors of one length. ``components`` has a column each; eigenvalues fall."""

    n: int
    pivot: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.pivot).astype(float) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n*x - S)**2, in integers of any size where a long might not do."""
        y = x - self.pivot
        most = max(int(y.max(initial=0)), -int(y.min(initial=0)))
        if (most * self.n + int(np.abs(self.rest).max(initial=0))) ** 2 * x.shape[1] < 2**63:
            return ((self.n * y - self.rest) ** 2).sum(axis=1).tolist()
        sums = [sum(z * z for z in row) for row in (self.n * y.astype(object) - self.rest.astype(object)).tolist()]
        return [z if z < 2**63 else None for z in sums]


def _gram(fit: DataFrame, models: dict[int, Model], of) -> dict[int, np.ndarray]:
    """d -> sum over the fit list of the outer squares of ``of(model, matrix)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in _matrices(batch):
                rows = of(models[d], x)
                total[d] = total.get(d, 0) + rows.T @ rows
        for d, g in total.items():
            i, j = np.triu_indices(len(g))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)),
                                              pa.array(j.astype(np.int32)), pa.array(g[i, j])], ["d", "i", "j", "v"])

    parts = fit.select("d", "x").mapInArrow(run, "d int, i int, j int, v double")
    found: dict[int, dict] = {}
    for row in parts.groupBy("d", "i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        found.setdefault(row["d"], {})[row["i"], row["j"]] = row["v"]
    out = {}
    for d, entries in found.items():
        size = 1 + max(j for _, j in entries)
        g = np.zeros((size, size))
        for (i, j), v in entries.items():
            g[i, j] = g[j, i] = v
        out[d] = g
    return out


# ------------------------------------------------------- leading eigenvectors


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder: diagonal, off-diagonal and the unit reflection vectors (of the trailing rows) of a symmetric matrix."""
    a, n = a.astype(float).copy(), len(a)
    mirrors = []
    for k in range(n - 2):
        v = a[k + 1:, k].copy()
        size = np.linalg.norm(v)
        v[0] += np.copysign(size, v[0])
        length = np.linalg.norm(v)
        v = v / length if length else v
        block = a[k + 1:, k + 1:]
        w = block @ v
        w -= (v @ w) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = a[k + 1, k] - 2 * v[0] * (v @ a[k + 1:, k])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie above each shift."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    squares = np.concatenate([[0.0], off**2])
    q, count = np.ones_like(shifts), np.zeros(len(shifts), int)
    for d, s in zip(diagonal, squares):
        q = d - shifts - s / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q > 0
    return count


def leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k greatest eigenvalues, falling, by bisection on the counts until no number lies between the bounds."""
    reach = np.concatenate([np.abs(off), [0.0]]) + np.concatenate([[0.0], np.abs(off)])
    width = float((np.abs(diagonal) + reach).max()) * (1 + 1e-9) + np.finfo(float).tiny
    low, high, want = np.full(k, -width), np.full(k, width), np.arange(1, k + 1)
    while True:
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= 1e-17 * width)):
            return high
        enough = above(diagonal, off, middle) >= want
        low, high = np.where(enough, middle, low), np.where(enough, high, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; pivots under ``least`` count as ``least``."""
    n = len(b)
    b = b.copy()
    u = np.zeros((n, 3))
    now = [diagonal[0] - shift, off[0] if n > 1 else 0.0, 0.0]
    for i in range(n - 1):
        below = [off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0]
        if abs(below[0]) > abs(now[0]):
            now, below = below, now
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(now[0]) < least:
            now[0] = np.copysign(least, now[0])
        m = below[0] / now[0]
        u[i] = now
        b[i + 1] -= m * b[i]
        now = [below[1] - m * now[1], below[2] - m * now[2], 0.0]
    if abs(now[0]) < least:
        now[0] = np.copysign(least, now[0])
    u[n - 1] = now
    for i in range(n - 1, -1, -1):
        s = b[i]
        if i + 1 < n:
            s -= u[i, 1] * b[i + 1]
        if i + 2 < n:
            s -= u[i, 2] * b[i + 2]
        b[i] = s / u[i, 0]
        if abs(b[i]) > 1e150:
            b[i:] *= 1e-150
            b[:i] *= 1e-150
    return b


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for its falling ``values``.

    Values closer than a thousandth of the norm are a cluster: each vector is made
    orthogonal to those of its cluster before it, in every round.
    """
    n, norm = len(diagonal), max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0)), np.finfo(float).tiny)
    random = np.random.RandomState(11)
    vectors = np.zeros((n, len(values)))
    first, shift = 0, values[0] if len(values) else 0.0
    least = np.finfo(float).eps * norm
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        shift = min(value, shift - 10 * least) if k > first else value  # equal values get shifts that differ
        cluster = vectors[:, first:k]
        x = random.uniform(-1, 1, n)
        done = 0
        for _ in range(rounds):
            x = _solve(diagonal, off, shift, x / np.abs(x).max(), least)
            grown = np.abs(x).max()
            x = x / np.linalg.norm(x / grown) / grown
            for _ in range(2):
                x -= cluster @ (cluster.T @ x)
            size = np.linalg.norm(x)
            if size < 1e-3:  # nothing new in it: another start
                x = random.uniform(-1, 1, n)
                continue
            x /= size
            done += 1
            if done == 3:
                break
        vectors[:, k] = x
    return vectors


def eigen(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading eigenvalues and unit eigenvectors (columns) of a symmetric matrix."""
    diagonal, off, mirrors = tridiagonal(v)
    values = leading(diagonal, off, k)
    x = inverse_iteration(diagonal, off, values)
    for j in range(len(mirrors) - 1, -1, -1):
        x[j + 1:] -= 2 * np.outer(mirrors[j], mirrors[j] @ x[j + 1:])
    return values, x * np.where(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])] < 0, -1.0, 1.0)


# --------------------------------------------------------------- the operator


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """Models per vector length from the distinct vectors of ``vectors`` (columns d, x)."""
    distinct = written(vectors.select("d", "x").distinct(), "fit-list")
    models = {}
    for d, (n, sums) in _sums(distinct).items():
        pivot = [(2 * s + n) // (2 * n) for s in sums]
        rest = [s - n * p for s, p in zip(sums, pivot)]
        models[d] = Model(n, np.array(pivot, np.int64), np.array(rest, np.int64), np.zeros((d, 0)), np.zeros(0), np.zeros(0))
    for d, g in _gram(distinct, models, lambda m, x: m.centred(x)).items():
        m, v = models[d], g / models[d].n
        values, vectors_ = eigen(v, min(components, d))
        real = values > max(NO_VARIANCE * values[0], np.finfo(float).tiny / np.finfo(float).eps)
        m.eigenvalues, m.components = values[real], vectors_[:, real]
        m.explained = m.eigenvalues / np.trace(v) if real.any() else m.eigenvalues
    whole = {d: m for d, m in models.items() if len(m.eigenvalues)}
    if whole:  # one more column of ones: the sums, by which the whitened rows are centred
        kept = distinct.where(F.col("d").isin(list(whole)))
        for d, g in _gram(kept, whole, lambda m, x: np.column_stack([m.whitened(x), np.ones(len(x))])).items():
            mean = g[:-1, -1] / whole[d].n
            covariance = g[:-1, :-1] / whole[d].n - np.outer(mean, mean)
            whole[d].identity_error = float(np.abs(covariance - np.eye(len(mean))).max())
    return whole


ROWS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def project(vectors: DataFrame, models: dict[int, Model]) -> DataFrame:
    """A row per vector (columns vec_id, d, x) and component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _matrices(batch):
                m = models.get(d)
                if m is None:
                    continue
                k = len(m.eigenvalues)
                repeat = pa.array(np.repeat(rows, k))
                fill = lambda values, kind: pa.array(values, kind)
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(repeat),
                    fill(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows)), pa.int32()),
                    fill(np.full(len(rows) * k, m.n), pa.int64()),
                    fill(m.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                    fill(m.whitened(x).ravel(), pa.float64()),
                    fill(np.tile(m.explained, len(rows)), pa.float64()),
                    fill(np.full(len(rows) * k, m.identity_error), pa.float64()),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"vec_id {id_type}, {ROWS}")


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id and, for each of the leading components, the whitened value with its figures (see the module)."""
    vectors = integers(rows, scale, offset)
    return project(vectors, fit(vectors, components))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11_whitening: every usable row of ``embeddings`` and component up to 16."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

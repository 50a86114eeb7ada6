"""Operator 1: quality classifier, histogram gradient-boosted trees over document statistics.

Statistics of a whole text (byte classes, words, repeats, lines) are taken in
numpy. Trees are grown on the driver from a bounded labelled sample: features are
binned at quantiles, a level of a tree is one histogram of gradients per feature,
and splits maximise the usual second-order gain. The finished trees are flattened
into arrays (feature, threshold, value by node of a complete binary tree), which
tasks traverse for all rows and trees at once. Scoring is one pass over the texts
without a shuffle.

Bounds: at most ``MAX_ROWS`` labelled rows, those with the least id hashes; the
model is ``trees`` times 2^(depth + 1) nodes. Rows held out are never learnt from.

Defined cases: null or empty texts have zero statistics and are scored like any
other; repeated rows score alike; several labels of an id count as the larger;
labels of one class, or none, give every text that class's share (0.5); an empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.blocks import Block, Rolling, blocks
from ledgerspark.llm.common import bounded_sample, held_out, packed, schema_with, ship, training_labels, unpacked

MAX_ROWS = 20000
#: Byte classes: white space, lower, upper, digits, other scripts, each sentence mark, brackets, symbols, the rest.
_GROUPS = [b" \t\x0b\f\r", b"\n", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", bytes(range(128, 256)),
           b".", b",", b"!?", b":;'\"-", b"()[]{}", b"#*$%&|<>", b"@/\\_=+~^`"]
_CLASS = np.full(256, len(_GROUPS), np.int64)
for _i, _g in enumerate(_GROUPS):
    _CLASS[list(_g)] = _i
N_CLASSES = len(_GROUPS) + 1
STATISTICS = (
    ["log_bytes", "log_words", "word_length", "long_words", "short_words", "symbol_end", "mark_end", "upper_words", "capital_words",
     "distinct_words", "repeat_next", "distinct_pairs", "distinct_triples", "log_lines", "words_per_line", "repeat_lines"]
    + [f"class_{i}" for i in range(N_CLASSES)]
)


def _distinct(text: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (values[1:] != values[:-1])
    return np.bincount(text[new], minlength=n)


def statistics(b: Block) -> np.ndarray:
    """(texts, STATISTICS) of a block."""
    n = len(b.rows)
    size = np.diff(b.offsets)
    owner = np.repeat(np.arange(n), size)
    kind = _CLASS[b.bytes]
    classes = np.bincount(owner * N_CLASSES + kind, minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    start, end, offsets = b.words()
    words = np.diff(offsets)
    text = np.repeat(np.arange(n), words)
    length = end - start
    some, one = np.maximum(words, 1), lambda x: np.bincount(text, weights=x, minlength=n)
    hashes = b.word_hashes(start, end)
    uppers = np.concatenate(([0], np.cumsum(kind == 3)))
    upper = uppers[end] - uppers[start]
    last, first = kind[end - 1], kind[start]
    follows = np.zeros(len(text), bool)
    follows[1:] = (text[1:] == text[:-1]) & (hashes[1:] == hashes[:-1])
    roll = Rolling(hashes)

    def grams(k: int) -> np.ndarray:
        count = np.maximum(words - k + 1, 0)
        owner = np.repeat(np.arange(n), count)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + offsets[owner]
        return _distinct(owner, roll.ranges(at, at + k), n) / np.maximum(count, 1)

    # lines: pieces between newlines and text borders, compared by hash
    breaks = np.flatnonzero(kind == 1)
    begin = np.unique(np.concatenate((b.offsets[:-1][size > 0], (breaks + 1)[np.isin(breaks + 1, b.offsets, invert=True)])))
    stop = np.append(begin[1:], len(b.bytes))
    if len(begin):
        stop = stop - (b.bytes[stop - 1] == 10)
    line_of = np.searchsorted(b.offsets, begin, side="right") - 1
    full = stop > begin
    lines = np.bincount(line_of[full], minlength=n)
    distinct_lines = _distinct(line_of[full], b.word_hashes(begin[full], stop[full]), n)
    cols = [np.log1p(size), np.log1p(words), one(length) / some, one(length > 12) / some, one(length <= 3) / some,
            one(last == 11) / some, one((last >= 6) & (last <= 8)) / some, one((upper > 1) & (2 * upper > length)) / some,
            one(first == 3) / some, _distinct(text, hashes, n) / some, one(follows) / some, grams(2), grams(3),
            np.log1p(lines), words / np.maximum(lines, 1), 1 - distinct_lines / np.maximum(lines, 1)]
    return np.column_stack([*cols, classes / np.maximum(size, 1)[:, None]])


@dataclass
class Trees:
    """Complete binary trees by level: children of node i are 2 i + 1 and 2 i + 2. ``value`` is that of the leaves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds: every row walks all trees at once, one level a step."""
        node = np.zeros((len(x), len(self.feature)), np.int64)
        tree = np.arange(len(self.feature))[None, :]
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        return self.base + self.value[tree, node - (2**self.depth - 1)].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -700, 700)))


def train(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, rate: float = 0.15, bins: int = 64,
          least: float = 3.0, ridge: float = 2.0) -> Trees:
    """Second-order boosting with the logistic loss on binned features."""
    n, d = x.shape
    share = float(np.clip(y.mean() if n else 0.5, 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    if n == 0 or y.min() == y.max():
        return Trees(base if n else 0.0, feature, threshold, value, depth)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    z = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            local = node - first
            total_g, total_h = (np.bincount(local, weights=w, minlength=width) for w in (grad, hess))
            whole = total_g**2 / (total_h + ridge)
            best = np.zeros(width)
            cut = np.full(width, -1)
            by = np.zeros(width, np.int64)
            for j in range(d):
                at = local * bins + binned[:, j]
                g = np.bincount(at, weights=grad, minlength=width * bins).reshape(width, bins).cumsum(axis=1)[:, :-1]
                h = np.bincount(at, weights=hess, minlength=width * bins).reshape(width, bins).cumsum(axis=1)[:, :-1]
                rest_g, rest_h = total_g[:, None] - g, total_h[:, None] - h
                gain = g**2 / (h + ridge) + rest_g**2 / (rest_h + ridge) - whole[:, None]
                gain[(h < least) | (rest_h < least)] = 0
                gain[:, len(edges[j]):] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(width), top] > best + 1e-9
                best[better] = gain[np.arange(width), top][better]
                cut[better], by[better] = top[better], j
            for k in np.flatnonzero(cut >= 0):
                feature[t, first + k], threshold[t, first + k] = by[k], edges[by[k]][cut[k]]
            right = (cut[local] >= 0) & (x[np.arange(n), by[local]] > np.append(threshold[t], np.inf)[node])
            node = 2 * node + 1 + right
        leaf = node - inner
        g, h = (np.bincount(leaf, weights=w, minlength=leaves) for w in (grad, hess))
        value[t] = -rate * g / (h + ridge)
        z += value[t][leaf]
    return Trees(base, feature, threshold, value, depth)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches):
        x = statistics(b)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        get = lambda c: b.rows.column(b.rows.schema.get_field_index(c))
        yield pa.RecordBatch.from_arrays([get("doc_id"), get("y"), lists], names=["doc_id", "y", "x"])


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality") -> Trees:
    """Trees from a bounded sample of the labels that may be learnt from."""
    ship(docs.sparkSession)
    known = bounded_sample(training_labels(labels, target), MAX_ROWS).withColumnRenamed(target, "y")
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = texts.mapInArrow(_statistics, "doc_id long, y int, x array<double>").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(STATISTICS))
    order = np.lexsort((*x.T, rows.column("doc_id").to_numpy()))
    return train(x[order], rows.column("y").to_numpy()[order].astype(float))


SCORE = "__score"


def _score(model: Trees):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            yield pa.RecordBatch.from_arrays([*b.rows.columns, pa.array(model.scores(statistics(b)))], names=[*b.rows.schema.names, SCORE])

    return score


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """``docs`` plus ``__score`` (0 to 1), which replaces a column of that name. One pass, no shuffle."""
    ship(docs.sparkSession)
    rows = packed(docs, "text")
    rows = rows.mapInArrow(_score(model), schema_with(rows, SCORE, T.DoubleType()))
    return rows.select(*unpacked(rows, docs, "text", leave=(SCORE,)), SCORE)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: quality of every document; good from 0.7."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.7).cast("int").alias("predicted"))

"""Operator 5: toxicity by non-negative positive-unlabelled learning.

A linear model over hashed words is trained in numpy from confirmed toxic texts
and unlabelled texts only. With class prior p the risk is
p E_P[l(+z)] + max(0, E_U[l(-z)] - p E_P[l(-z)]): unlabelled texts count as
clean, less the share of toxic ones that the prior expects among them. Where that
difference falls below zero the model has begun to fit the toxic texts in the
unlabelled sample, and the step climbs it instead (non-negative correction).

Features of a text: its distinct words, lower-cased, cut at anything that is not a
letter, and the first eight bytes of longer words, as 64-bit hashes. The features
kept are the ``MAX_FEATURES`` that stand out most in toxic texts (G statistic of at
least ``LEAST_G``).

Bounds: training uses at most ``MAX_POSITIVE`` confirmed and ``MAX_UNLABELLED``
unlabelled texts, those with the least id hashes; the model is ``MAX_FEATURES``
hashes and weights. Features are counted by Spark, so the driver gets only those kept,
at most ``MAX_FEATURES`` of a text however long it is. Scoring is one pass without a shuffle. Learning reads labels of rows that are not held out;
held-out texts do not enter either sample.

Defined cases: null or empty texts have no features and get the score of the
intercept; repeated rows score alike; without any confirmed toxic text all score
0; several labels of an id count as the larger; an empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.blocks import Block, Rolling, U, blocks
from ledgerspark.llm.common import bounded_sample, held_out, packed, schema_with, ship, training_labels, unpacked, written

PREFIX = 8
MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 4000, 12000, 2000
LEAST_G = 15


def features(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word of a block and of its prefix; not distinct."""
    b.letters()
    start, end, offsets = b.words()
    roll = Rolling(b.bytes.astype(U) + U(1))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    long = end - start > PREFIX
    hashes = np.concatenate((roll.ranges(start, end), roll.ranges(start[long], start[long] + PREFIX)))
    return np.concatenate((text, text[long])), hashes.view(np.int64)


def _distinct(text: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((f, text))
    text, f = text[order], f[order]
    new = np.ones(len(f), bool)
    new[1:] = (text[1:] != text[:-1]) | (f[1:] != f[:-1])
    return text[new], f[new]


def _list_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of texts."""
    for b in blocks(batches):
        text, f = _distinct(*features(b))
        cut = np.searchsorted(text, np.arange(len(b.rows) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [*(b.rows.column(b.rows.schema.get_field_index(c)) for c in ("doc_id", "positive")),
             pa.ListArray.from_arrays(pa.array(cut), pa.array(f))], names=["doc_id", "positive", "f"])


def _keep_features(only: np.ndarray):
    """Of listed features, those of a sorted list of hashes."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(b.schema.get_field_index("f"))
            flat, text = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            has = _place(only, flat) >= 0
            cut = np.searchsorted(text[has], np.arange(len(lists) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in ("doc_id", "positive")),
                 pa.ListArray.from_arrays(pa.array(cut), pa.array(flat[has]))], names=["doc_id", "positive", "f"])

    return keep


def standing_out(listed: DataFrame, n_pos: int, n_un: int, least_g: float = LEAST_G, most: int = MAX_FEATURES) -> DataFrame:
    """The features ``f`` that stand out most in the positive rows of ``listed`` (positive, f); ties by hash."""
    counts = listed.select("positive", F.explode("f").alias("f")).groupBy("f").agg(
        F.sum(F.col("positive").cast("long")).alias("p"), F.sum((~F.col("positive")).cast("long")).alias("u"))
    rate = (F.col("p") + F.col("u")) / float(n_pos + n_un)

    def g(k, n):
        return (F.when(k > 0, k * F.log(k / (n * rate))).otherwise(0.0)
                + F.when(n - k > 0, (n - k) * F.log((n - k) / (n * (1 - rate)))).otherwise(0.0))

    often = counts.where((F.col("p") > 1) & (F.col("p") / float(n_pos) > 2 * F.col("u") / float(n_un)))
    score = 2 * (g(F.col("p"), F.lit(float(n_pos))) + g(F.col("u"), F.lit(float(n_un))))
    return often.select("f", score.alias("g")).where(F.col("g") >= least_g).orderBy(F.desc("g"), "f").limit(most).select("f")


def _place(hashes: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Where each of ``f`` stands in the sorted ``hashes``, -1 for nowhere."""
    if not len(hashes):
        return np.full(len(f), -1)
    at = np.searchsorted(hashes, f)
    at[at == len(hashes)] = 0
    return np.where(hashes[at] == f, at, -1)


@dataclass
class Model:
    """Sorted feature hashes, their weights, and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float


def train(texts: list[np.ndarray], positive: np.ndarray, prior: float, rounds: int = 400, rate: float = 0.1,
          decay: float = 3e-5, least_g: float = LEAST_G) -> Model:
    """Non-negative PU learning with the logistic loss and Adam, all texts in every step."""
    n_pos, n_un = int(positive.sum()), int((~positive).sum())
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    flat = np.concatenate([*texts, np.zeros(0, np.int64)])
    # a feature has to be in two confirmed texts at least
    names, twice = np.unique(flat[positive[row]], return_counts=True)
    names = names[twice > 1]
    flat = _place(names, flat)
    row, flat = row[flat >= 0], flat[flat >= 0]
    df_p = np.bincount(flat[positive[row]], minlength=len(names)).astype(float)
    df_u = np.bincount(flat[~positive[row]], minlength=len(names)).astype(float)
    rate_all = (df_p + df_u) / (n_pos + n_un)

    def g(k, n):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(k > 0, k * np.log(k / (n * rate_all)), 0) + np.where(
                n - k > 0, (n - k) * np.log((n - k) / (n * (1 - rate_all))), 0)

    stands_out = np.where(df_p / n_pos > 2 * df_u / n_un, 2 * (g(df_p, n_pos) + g(df_u, n_un)), 0)
    chosen = np.argsort(-stands_out, kind="stable")[:MAX_FEATURES]
    chosen = np.sort(chosen[stands_out[chosen] >= least_g])
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    col = place[flat]
    row, col = row[col >= 0], col[col >= 0]

    w, c = np.zeros(len(chosen)), np.log(prior / (1 - prior))
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    weight_p, weight_u = positive / n_pos, ~positive / n_un
    for t in range(1, rounds + 1):
        z = c + np.bincount(row, weights=w[col], minlength=len(texts))
        up = 1 / (1 + np.exp(-np.clip(z, -40, 40)))  # the derivative of l(-z)
        loss_neg = np.logaddexp(0, z)
        negative = (weight_u * loss_neg).sum() - prior * (weight_p * loss_neg).sum()
        rest = (weight_u - prior * weight_p) * up
        slope = prior * weight_p * (up - 1) + rest if negative >= 0 else -rest
        grad = np.append(np.bincount(col, weights=slope[row], minlength=len(chosen)) + decay * w, slope.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, c = w - step[:-1], c - step[-1]
    return Model(names[chosen], w, float(c))


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> Model | None:
    """A model from the confirmed texts among ``labels`` and unlabelled ``docs``; None without confirmed ones.

    The prior is the share of toxic rows among the labels that may be learnt from.
    """
    ship(docs.sparkSession)
    known = training_labels(labels, target)
    prior = known.agg(F.avg(target)).first()[0]
    if not prior:
        return None
    confirmed = bounded_sample(known.where(F.col(target) == 1).select("doc_id"), MAX_POSITIVE)
    unlabelled = bounded_sample(docs.select("doc_id").where(~held_out("doc_id")).distinct(), MAX_UNLABELLED)

    ids = confirmed.withColumn("positive", F.lit(True)).unionByName(unlabelled.withColumn("positive", F.lit(False)))
    schema = "doc_id long, positive boolean, f array<bigint>"
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    listed = written(texts.select("doc_id", "positive", "text").mapInArrow(_list_features, schema), "toxic-features")
    n = {r.positive: r["count"] for r in listed.groupBy("positive").count().collect()}
    if len(n) < 2:
        return None
    kept = np.sort(np.array([r.f for r in standing_out(listed, n[True], n[False]).collect()], np.int64))
    rows = listed.mapInArrow(_keep_features(kept), schema).toArrow().sort_by([("positive", "descending"), ("doc_id", "ascending")])
    f = rows.column("f").combine_chunks()
    flat, off = f.values.to_numpy(), f.offsets.to_numpy()
    return train([flat[a:b] for a, b in zip(off[:-1], off[1:])], rows.column("positive").to_numpy(), min(max(float(prior), 1e-4), 0.9))


SCORE = "__score"


def _score(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            rows = b.rows
            text, f = features(b)
            at = _place(model.hashes, f)
            text, at = _distinct(text[at >= 0], at[at >= 0])
            z = model.intercept + np.bincount(text, weights=model.weights[at], minlength=len(rows))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))], names=[*rows.schema.names, SCORE])

    return score


def _scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """text, the other columns packed, and the score. One pass, no shuffle."""
    rows = packed(docs, "text")
    if model is None:
        return rows.withColumn(SCORE, F.lit(0.0))
    ship(docs.sparkSession)
    return rows.mapInArrow(_score(model), schema_with(rows, SCORE, T.DoubleType()))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` plus ``__score`` (0 to 1), which replaces a column of that name."""
    rows = _scored(docs, model)
    return rows.select(*unpacked(rows, docs, "text", leave=(SCORE,)), SCORE)


def below(docs: DataFrame, model: Model | None, limit: float) -> DataFrame:
    """The rows of ``docs`` that score less than ``limit``, all columns kept."""
    rows = _scored(docs, model).where(F.col(SCORE) < limit)
    return rows.select(*unpacked(rows, docs, "text"))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: toxicity of every document; rejected from 0.3."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= 0.3).cast("int").alias("predicted"))

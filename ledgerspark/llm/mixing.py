"""Operator 2: mixing sources to target weights by weighted fair queueing.

Native: DataFrame functions only. Every source is a queue that serves its
documents in a shuffled order (md5 of the id). A document's virtual finish time
is the words its source has served so far, this document included, divided by
the source's target; a source may serve its documents ``max_repeats`` times, one
round after another. All sources' documents are then ordered by virtual finish
time and the order is truncated at the total budget. As each target is reached
at virtual time 1, the mix holds every source at its target, give or take one
document.

No task ever holds a whole source: running sums are taken over 4,096 slices of
the shuffled order (a third of all rows in one source is 1/12,288 of them per
slice), and the slices' offsets come from their sums. The global order is cut by
slices of virtual time in the same way: only the slice that holds the cut is
ever sorted.

Defined cases: null text has size 0; a null source is a source of its own and
sorts last; null ids are ordinary ids; rows that are equal throughout are
interchangeable and each is counted; documents of size 0 are returned with
taken 0; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import EXTRAS, WORD, packed, unpacked, written

WEIGHTS = (5, 2, 1)
#: Hex digits of the md5 that name a slice of a source's shuffled order.
SLICE_DIGITS = 3
#: Slices of virtual time between 0 and 1, and of the one slice that holds the cut.
TIME_SLICES = 4096


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget_x: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """(no_source, src, source_size) to the same plus ``target``.

    The budget, ``budget_x`` times all sizes, is shared by weight. A target stops
    at ``max_repeats`` times its source's size and the excess is shared again:
    with the sources ordered by cap / weight, those before the first one that its
    share does not fill are at their caps, the others get weight times the level
    that is left there. One row per source.
    """
    by_name = Window.orderBy("no_source", "src")
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "no_source", "src")
    everything = Window.partitionBy()
    w = F.array(*[F.lit(x) for x in weights])
    t = (
        sizes.withColumn("weight", F.element_at(w, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("all_size", F.sum("source_size").over(everything))
        .withColumn("capped", F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open_weight", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("place", F.row_number().over(by_cap))
    )
    level = (F.col("all_size") * F.lit(budget_x) - F.coalesce("capped", F.lit(0))) / F.col("open_weight")
    t = t.withColumn("level", level)
    short = F.col("level") * F.col("weight") < F.col("cap")
    t = t.withColumn("first", F.min(F.when(short, F.struct("place", "level"))).over(everything))
    share = F.when(F.col("place") >= F.col("first.place"), F.col("weight") * F.col("first.level"))
    return t.select("no_source", "src", "source_size", F.coalesce(share, F.col("cap").cast("double")).alias("target"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``n`` rows for each one, with their numbers as ``copy``; arrays stay short however many they are."""
    step = F.lit(4096)
    some = rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / step))))
    last = F.least(F.col("n") - 1, F.col("at") * step + step - 1)
    return some.withColumn("copy", F.explode(F.sequence(F.col("at") * step, last))).drop("at", "n")


def _mixed(docs: DataFrame, weights, budget_x: float, max_repeats: int) -> DataFrame:
    """doc_id, key (hash of the text), no_source, src, size, source_size, target and taken of every row."""
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("key"),
        F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("src"),
        word_count(F.col("text")).alias("size"),
    )
    # a document's place comes from its id; copies, which are counted and numbered, and rows without id have places of
    # their own, so that they spread over the slices like all others
    rows = _numbered(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")))
    place = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("key").cast("string"), F.col("copy").cast("string"))
    place = F.when((F.col("copy") == 0) & F.col("doc_id").isNotNull(), F.col("doc_id").cast("string")).otherwise(place)
    light = written(rows.withColumn("h", F.md5(place.cast("binary"))).withColumn("slice", F.substring("h", 1, SLICE_DIGITS)), "mix-sizes")
    key = ["no_source", "src"]
    slices = light.groupBy(*key, "slice").agg(F.sum("size").alias("slice_size"))
    offset = F.sum("slice_size").over(Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    targets = source_targets(slices.groupBy(*key).agg(F.sum("slice_size").alias("source_size")), weights, budget_x, max_repeats)
    slices = slices.select(*key, "slice", F.coalesce(offset, F.lit(0)).alias("before")).join(targets, key)
    inside = Window.partitionBy(*key, "slice").orderBy("h", "doc_id", "size", "key", "copy").rowsBetween(Window.unboundedPreceding, 0)
    served = light.join(slices, [*key, "slice"]).withColumn("served", F.col("before") + F.sum("size").over(inside))
    finish = lambda k: (F.col("served") + k * F.col("source_size")).cast("double") / F.col("target")
    queued = written(
        served.select("doc_id", "key", *key, "size", "source_size", "target",
                      *[F.when(F.col("size") > 0, finish(k)).alias(f"finish{k}") for k in range(max_repeats)]),
        "mix-queues",
    )
    rounds = queued.where("size > 0").select(
        "size", *key, F.explode(F.array(*[F.col(f"finish{k}") for k in range(max_repeats)])).alias("finish"))
    total = light.agg(F.sum("size")).first()[0] or 0
    cut = _cut(rounds, int(total * budget_x))
    taken = sum((F.when((F.col("size") > 0) & _up_to(F.col(f"finish{k}"), cut), F.col("size")).otherwise(0)
                 for k in range(max_repeats)), F.lit(0).cast("long"))
    return queued.select("doc_id", "key", *key, "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, budget_x: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """Documents with the words that the mix takes from them.

    ``docs`` needs doc_id, text and source. Returns doc_id, size, source_size,
    target (of the source), taken (size times the rounds that take the document).
    """
    return _mixed(docs, weights, budget_x, max_repeats).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, budget_x: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns kept.

    Rows equal in id, text and source are interchangeable: their repeats carry the columns of one of them.
    """
    taken = _mixed(docs, weights, budget_x, max_repeats).where("taken > 0")
    taken = taken.groupBy(F.col("doc_id").alias("__d"), F.col("key").alias("__k"), F.col("no_source").alias("__n"),
                          F.col("src").alias("__s")).agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("__times"))
    keys = ["__k", "__n", "__s"]
    reads = ("doc_id", "text", "source")
    rows = packed(docs, *reads).withColumns({"__d": F.col("doc_id"), "__k": F.xxhash64("text"), "__n": F.col("source").isNull(),
                             "__s": F.coalesce("source", F.lit(""))})
    taken = written(taken, "mix-taken").withColumnRenamed("__d", "__e")
    on = F.col("__d").eqNullSafe(F.col("__e"))
    for k in keys:
        on = on & (rows[k] == taken[k])
    both = rows.join(taken, on).drop(*[taken[k] for k in keys], "__e").dropDuplicates(["__d", *keys])
    both = both.select(*reads, EXTRAS, F.explode(F.sequence(F.lit(1), "__times")))
    return both.select(*unpacked(both, docs, *reads))


def _up_to(finish: Column, cut: tuple | None) -> Column:
    """True for what stands at or before the cut in the order (finish, source)."""
    if cut is None:
        return F.lit(True)
    at, no_source, src = cut
    source = F.struct("no_source", "src") <= F.struct(F.lit(no_source), F.lit(src))
    return (finish < F.lit(at)) | ((finish == F.lit(at)) & source)


def _cut(rounds: DataFrame, budget: int) -> tuple | None:
    """(finish, no_source, src) of the last document that fits the budget; None where all fit.

    Three rows reach the driver: the slice of virtual time with the cut, the
    slice within that slice, and the cut. Finish times rise strictly within a
    source, so (finish, source) is a total order.
    """
    last = 4 * TIME_SLICES
    slices = F.least(F.floor(F.col("finish") * TIME_SLICES), F.lit(last)).cast("long")
    rounds = rounds.withColumn("t", slices)
    rounds = rounds.withColumn(
        "t2", F.least(F.floor((F.col("finish") * TIME_SLICES - F.col("t")) * TIME_SLICES), F.lit(last)).cast("long"))
    before = 0
    for level in ("t", "t2"):
        sums = rounds.groupBy(level).agg(F.sum("size").alias("s"))
        run = F.sum("s").over(Window.orderBy(level).rowsBetween(Window.unboundedPreceding, 0))
        row = sums.withColumn("upto", run).where(F.col("upto") + before > budget).orderBy(level).first()
        if row is None:
            return None
        before += row["upto"] - row["s"]
        rounds = rounds.where(F.col(level) == row[level])
    order = ["finish", "no_source", "src"]
    run = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    fits = rounds.withColumn("upto", run + before).where(F.col("upto") <= budget)
    row = fits.orderBy(*[F.desc(c) for c in order]).first()
    if row is not None:
        return tuple(row[c] for c in order)
    first = rounds.orderBy(*order).first()  # the slice's first document does not fit: the cut is just before it
    return (math.nextafter(first["finish"], -math.inf), True, "")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: the mix of all documents, weights 5, 2, 1 over the sources by code point, 150% of all words."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH d AS (
  SELECT doc_id, source, source IS NULL AS no_source, coalesce(source, '') AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT no_source, src, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY no_source, src) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY no_source, src),
l AS (
  SELECT *, row_number() OVER w AS place,
         ((SELECT sum(size) FROM d)::DOUBLE * 1.5
          - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM s WINDOW w AS (ORDER BY cap / weight, no_source, src)),
f AS (SELECT place, level FROM l WHERE level * weight < cap ORDER BY place LIMIT 1),
t AS (
  SELECT no_source, src, source_size,
         CASE WHEN place >= (SELECT place FROM f) THEN weight * (SELECT level FROM f) ELSE cap::DOUBLE END AS target
  FROM l),
q AS (
  SELECT d.*, source_size, target,
         sum(size) OVER (PARTITION BY no_source, src ORDER BY h, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS served
  FROM d JOIN t USING (no_source, src)),
r AS (
  SELECT no_source, src, doc_id, size, h, (served + k * source_size)::DOUBLE / target AS finish, served
  FROM q, (VALUES (0), (1)) AS rounds(k) WHERE size > 0),
c AS (
  SELECT no_source, src, served, size,
         sum(size) OVER (ORDER BY finish, no_source, src ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           <= floor((SELECT sum(size) FROM d) * 1.5) AS fits
  FROM r),
m AS (SELECT no_source, src, served, sum(CASE WHEN fits THEN size ELSE 0 END)::BIGINT AS taken
      FROM c GROUP BY no_source, src, served)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM q LEFT JOIN m USING (no_source, src, served)
WHERE size > 0
UNION ALL SELECT doc_id, size, source_size, target, 0::BIGINT FROM q WHERE size = 0
"""

"""Operator 8: quality rules with robust multivariate outlier rejection.

Native: DataFrame functions only. Five counts are taken of every whole text. A
base rule rejects texts that are too short or mostly repeat themselves. The
others become vectors of four transformed statistics, and each (language,
source) group gets a minimum-covariance-determinant estimate. A search goes from
four deterministic starts (``STARTS``): a concentration step takes mean and
covariance of the three quarters of the group that lie nearest to an estimate,
and steps go on until the determinant stops falling; of the four ends the one with
the least determinant stands. A document is rejected when its squared Mahalanobis
distance from it exceeds ``cutoff``.

Groups of every size are treated alike: the estimate of the language, found by the
same search, counts as ``prior`` documents of the group in every step, so a small
group leans on its language and a large one hardly feels it. The language's own
search counts all documents' medians, with ``FLOORS`` as scales, the same way.

Scale: texts are read once; what the steps read is a table of a few numbers per
document in the shared folder. A step is one map-side aggregation for all groups and
starts: distances fall into bins of fixed width, every (group, start, bin) carries
count, sums and sums of products, and the nearest three quarters are the bins up to
a running count. So no group is ever sorted or gathered, and quantised integers make
the sums exact, hence reruns agree. The join with the estimates (a few rows per
group) is salted, since a group may hold a third of all rows.

Covariances get a floor per statistic (``FLOORS``): clean text often has no
symbol and no repeated line at all, and a zero variance would reject the first one.

Defined cases: null text counts as empty (no words, base_failed); null lang or
source is a group of its own; rows that repeat are judged alike; an empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.llm.common import WORD, written

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Statistics are kept as integers of 1 / SCALE.
SCALE = 1000
#: Least standard deviation of: log word length, symbol share, share of repeated words, log(1 + repeated lines).
FLOORS = (0.08, 0.01, 0.08, 0.35)
DIM = len(FLOORS)
X = [f"x{i}" for i in range(DIM)]
PAIRS = list(combinations_with_replacement(range(DIM), 2))
#: Share of a group that a concentration step keeps, and the factor that makes its covariance consistent
#: for normal data in four dimensions: 0.75 / P(chi2_6 <= 5.385).
NEAR, CONSISTENT = 0.75, 1.485
#: Chi-square quantile 1 - 1e-6 in four dimensions.
CUTOFF = 33.4
SALTS = 64
BINS_PER_DOUBLING = 64
#: Documents that the language's estimate counts for in a group's.
PRIOR = 20
#: The search's starts: medians with the floors as scales; mean and covariance of the half nearest to the medians; of
#: all; and of the directions from the medians (spatial signs).
STARTS = ("medians", "half", "all", "signs")
#: A determinant has stopped falling when a step takes off less than this share; so many steps at most.
FALLS, MOST_STEPS = 1e-3, 30


def _covered(starts: Column, width: int) -> Column:
    """Number of positions covered by windows of ``width`` at sorted distinct ``starts``."""
    gaps = F.transform(starts, lambda a, i: F.least(F.get(starts, i + 1) - a, F.lit(width)))
    return F.aggregate(gaps, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(width)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the five counts of every whole text."""
    d = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select(
        "doc_id", "lang", "source",
        F.regexp_extract_all("text", F.lit(WORD), 0).alias("w"),
        F.char_length(F.translate("text", SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))).alias("lines"),
    )
    none = F.array().cast("array<bigint>")
    triples = F.transform(F.sequence(F.lit(1), F.size("w") - 2),
                          lambda i: F.xxhash64(F.get("w", i - 1), F.get("w", i), F.get("w", i + 1)))
    d = d.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 3, triples).otherwise(none).alias("g"),
    )
    # most texts repeat no window: only the others are sorted
    some = F.size("g") > F.size(F.array_distinct("g"))
    pairs = F.array_sort(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.select("*", F.when(some, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("p")).drop("g")
    twice = F.filter("p", lambda x, k: (F.get("p", k - 1)["h"] == x["h"]) | (F.get("p", k + 1)["h"] == x["h"]))
    d = d.withColumn("r", F.array_sort(F.transform(twice, lambda x: x["i"])))
    return d.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size("r") > 0, _covered(F.col("r"), 3)).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def _vector() -> list[Column]:
    """The four transformed statistics of a text with words, as integers of 1 / SCALE."""
    logs = [F.log(F.col("word_chars") / F.col("n_words")), F.col("n_symbols") / F.col("word_chars"),
            F.col("n_repeat_words") / F.col("n_words"), F.log1p(F.col("n_dup_lines"))]
    return [F.round(c * SCALE).cast("long").alias(x) for c, x in zip(logs, X)]


SUMS = ["n", *[f"s{i}" for i in range(DIM)], *[f"q{i}{j}" for i, j in PAIRS]]
SHAPE = [*[f"m{i}" for i in range(DIM)], *[f"l{j}{i}" for i, j in PAIRS]]


def _with(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """Each point beside its group's estimates; these are repeated for each salt."""
    salted = estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return points.join(salted, ["grp", "salt"])


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}{j}") for i, j in PAIRS]]


def _distance() -> Column:
    """Squared Mahalanobis distance from the Cholesky factor: forward substitution."""
    y: list[Column] = []
    for i in range(DIM):
        rest = F.col(X[i]) / SCALE - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * y[j]
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((c * c for c in y[1:]), y[0] * y[0])


def _factored(t: DataFrame, prior: DataFrame | None, weight: float) -> DataFrame:
    """(grp, start, sums) to means, Cholesky factor and log determinant, with the prior's (grp, m*, c*) counted in."""
    n = F.col("n").cast("double")
    means = {i: F.col(f"s{i}") / n / SCALE for i in range(DIM)}
    cov = {(i, j): (F.col(f"q{i}{j}") / n / SCALE / SCALE - means[i] * means[j]) * CONSISTENT + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in PAIRS}
    t = t.select("grp", "start", "n", *[c.alias(f"a{i}") for i, c in means.items()], *[c.alias(f"b{i}{j}") for (i, j), c in cov.items()])
    if prior is not None:
        share = F.col("n") / (F.col("n") + F.lit(float(weight)))
        mixed = [(share * F.col(f"a{i}") + (1 - share) * F.col(f"m{i}")).alias(f"a{i}") for i in range(DIM)]
        both = [(share * F.col(f"b{i}{j}") + (1 - share) * F.col(f"c{i}{j}")).alias(f"b{i}{j}") for i, j in PAIRS]
        t = t.join(prior, "grp").select("grp", "start", "n", *mixed, *both)
    t = t.select("grp", "start", *[F.col(f"a{i}").alias(f"m{i}") for i in range(DIM)], *[F.col(f"b{i}{j}").alias(f"c{i}{j}") for i, j in PAIRS])
    for j in range(DIM):
        for i in range(j, DIM):
            c = F.col(f"c{j}{i}")
            for k in range(j):
                c = c - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            t = t.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(1e-12))) if i == j else c / F.col(f"l{j}{j}"))
    det = sum((F.log(F.col(f"l{i}{i}")) for i in range(1, DIM)), F.log(F.col("l00"))) * 2
    return t.select("grp", "start", *SHAPE, *[f"c{i}{j}" for i, j in PAIRS], det.alias("det"))


def _medians(points: DataFrame) -> DataFrame:
    """Coordinate-wise medians (from bins of SCALE / 100), with three floors as scales."""
    width = SCALE // 100
    long = points.select("grp", F.posexplode(F.array(*[F.floor(F.col(x) / width) for x in X])).alias("i", "bin"))
    bins = long.groupBy("grp", "i", "bin").count()
    w = Window.partitionBy("grp", "i").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("count").over(w)).withColumn("all", F.sum("count").over(Window.partitionBy("grp", "i")))
    mid = bins.where("2 * upto >= all").groupBy("grp", "i").agg(((F.min("bin") + 0.5) * width / SCALE).alias("m"))
    one = mid.groupBy("grp").agg(*[F.max(F.when(F.col("i") == i, F.col("m"))).alias(f"m{i}") for i in range(DIM)])
    lower = [F.lit(3 * FLOORS[j] if i == j else 0.0).alias(f"l{j}{i}") for i, j in PAIRS]
    square = [F.lit((3 * FLOORS[j]) ** 2 if i == j else 0.0).alias(f"c{i}{j}") for i, j in PAIRS]
    return one.select("grp", F.lit("medians").alias("start"), *[f"m{i}" for i in range(DIM)], *lower, *square,
                      F.lit(float("inf")).alias("det"))


def _starts(points: DataFrame, medians: DataFrame, prior: DataFrame, weight: float) -> DataFrame:
    """The four starts of each group."""
    shape = ["grp", *SHAPE]
    near = _nearest(points, medians.select(*shape, F.lit("half").alias("start")), 0.5)
    every = points.groupBy("grp").agg(*_sums()).withColumn("start", F.lit("all"))
    # a direction from the medians in units of the floors, as long as the floors are: its covariance has the data's shape
    beside = _with(points, medians.select(*shape))
    steps = [(F.col(x) / SCALE - F.col(f"m{i}")) / FLOORS[i] for i, x in enumerate(X)]
    length = F.sqrt(F.greatest(sum((c * c for c in steps[1:]), steps[0] * steps[0]), F.lit(1e-12)))
    signs = beside.select("grp", *[F.round((F.col(f"m{i}") + 2 * FLOORS[i] * c / length) * SCALE).cast("long").alias(x)
                                   for i, (x, c) in enumerate(zip(X, steps))])
    signs = signs.groupBy("grp").agg(*_sums()).withColumn("start", F.lit("signs"))
    others = near.select("grp", "start", *SUMS).unionByName(every.select("grp", "start", *SUMS)).unionByName(signs.select("grp", "start", *SUMS))
    ends = _factored(others, prior, weight).withColumn("det", F.lit(float("inf")))
    return medians.unionByName(ends.select(medians.columns))


def _nearest(points: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """(grp, start, sums) of the points nearest to each estimate: whole bins of distance, until ``share`` of the group is in."""
    bin_ = F.floor(F.log2(1 + _distance()) * BINS_PER_DOUBLING).alias("bin")
    bins = _with(points, estimates).select("grp", "start", bin_, *X).groupBy("grp", "start", "bin").agg(*_sums())
    own = Window.partitionBy("grp", "start")
    w = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = bins.select("grp", "start", "bin", F.sum("n").over(own).alias("all"), *[F.sum(c).over(w).alias(c) for c in SUMS])
    kept = run.where(F.col("n") >= F.ceil(F.col("all") * share)).groupBy("grp", "start").agg(F.min_by(F.struct(*SUMS), "bin").alias("t"))
    return kept.select("grp", "start", "t.*")


def least_determinants(points: DataFrame, prior: DataFrame | None, weight: float) -> DataFrame:
    """grp, m*, l*, c*, det: of each group the concentrated estimate with the least determinant.

    ``points`` has grp, salt and the statistics; ``prior`` (grp, m*, c*) counts as ``weight`` documents.
    """
    medians = written(_medians(points), "rules-medians")
    if prior is None:
        prior = medians.select("grp", *[f"m{i}" for i in range(DIM)], *[F.lit(FLOORS[i] ** 2 if i == j else 0.0).alias(f"c{i}{j}") for i, j in PAIRS])
    best = written(_starts(points, medians, prior, weight), "rules-starts")
    columns, active = best.columns, best
    for _ in range(MOST_STEPS):
        step = _factored(_nearest(points, active.select("grp", "start", *SHAPE), NEAR), prior, weight)
        new = step.select("grp", "start", F.struct(*[c for c in columns if c not in ("grp", "start")]).alias("new"))
        both = best.join(new, ["grp", "start"], "left").withColumn("fell", F.coalesce(F.col("new.det") < F.col("det") - FALLS, F.lit(False)))
        both = written(both.select("grp", "start", *[F.when(F.col("fell"), F.col("new")[c]).otherwise(F.col(c)).alias(c)
                                                    for c in columns if c not in ("grp", "start")], "fell"), "rules-step")
        best, active = both.select(columns), both.where("fell")
        if active.isEmpty():
            break
    order = F.struct("det", "start")
    won = best.groupBy("grp").agg(F.min_by(F.struct(*[c for c in columns if c not in ("grp", "start")]), order).alias("t"))
    return written(won.select("grp", "t.*"), "rules-won")


def reject_outliers(docs: DataFrame, cutoff: float = CUTOFF, prior: float = PRIOR,
                    min_words: int = 50, max_repeat_pct: int = 50) -> DataFrame:
    """The counts of every document, base_failed, kept and the squared ``distance`` (null where base_failed).

    ``docs`` needs doc_id, text, lang and source.
    """
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    s = statistics(docs).withColumn("base_failed", failed)
    own, all_of = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    stats = written(s.select("*", *[F.when(~F.col("base_failed"), c).alias(x) for c, x in zip(_vector(), X)], own.alias("own"), all_of.alias("wide"),
                             F.pmod(F.xxhash64("doc_id", "word_chars"), F.lit(SALTS)).cast("int").alias("salt")), "rules-stats")
    good = stats.where("not base_failed")
    means, square = [f"m{i}" for i in range(DIM)], [f"c{i}{j}" for i, j in PAIRS]
    wide = least_determinants(good.select(F.col("wide").alias("grp"), "salt", *X), None, prior)
    groups = good.select("own", "wide").distinct()
    lean = written(groups.join(wide.withColumnRenamed("grp", "wide"), "wide").select(F.col("own").alias("grp"), *means, *square), "rules-prior")
    points = good.withColumnRenamed("own", "grp")
    estimates = least_determinants(points.select("grp", "salt", *X), lean, prior)
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = _with(points, estimates.select("grp", *SHAPE)).select(*counts, _distance().alias("distance"))
    out = judged.select(*counts, (F.col("distance") <= cutoff).alias("kept"), "distance")
    rest = stats.where("base_failed").select(*counts, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return out.unionByName(rest)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: counts and verdict of every document."""
    return reject_outliers(spark.read.parquet(f"{sf_dir}/documents.parquet"))

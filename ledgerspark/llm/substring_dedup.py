"""Operator 9: repeated passages by level-wise doubling.

A window of ``width`` words that also starts in a document with a smaller id is
removed. Levels have lengths START, 2 * START, 4 * START and so on below ``width``, and
``width`` itself. Windows that repeat in another document at one length alone are
extended to twice that length (at last to ``width``, under three times it), until no
candidate survives.
Nothing longer has to be looked at, because a longer repeat is covered by repeats of
``width``.

At the first level every window of ``width`` is represented by its anchor, the
window of the first length in it with the least hash, so some two anchors are shuffled
for every ``width - START`` words; neighbouring windows with one anchor are a run. Equal
windows have equal anchors at equal places, so an anchor that does not repeat rules out all
windows it stands for. An anchor is doubled to the right where that stays inside its
window and to the left otherwise: what it is doubled to lies at the same place in equal
windows as well, and rules them out if it does not repeat. A run is split where the
direction changes. At the last level the windows of a surviving anchor are compared run
by run: an equal run (128-bit hash of its words) is settled at once, and only runs that
differ under one anchor are opened into single windows.

Scale: counting is map-side aggregation, so a passage in a third of all documents
costs a task no more than its share of documents; joins with the survivors have
plain exchanges on both sides, which Spark splits when skewed. Texts are shuffled
only where a bit map of fixed size says that their document has something to
remove. All intermediate tables are in the shared folder.

Defined cases: null text has no words and becomes ""; texts under ``width`` words
are kept whole; null ids sort last and never remove each other's words; rows with
equal ids do not either; rows equal in id and text are treated alike; an empty
table gives an empty result; other columns pass through (an input column
``repeats`` is replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.llm.blocks import Block, Rolling, U, blocks, mix, runs
from ledgerspark.llm.common import EXTRAS, bitmap, keyed, marked, packed, schema_with, unpacked, written

REPEATS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
#: Words of the first level (a quarter of ``width`` where that is less).
START = 13


def levels(width: int) -> list[int]:
    """Lengths of the levels below ``width``, each twice the one before, as long as a block anywhere in a window of
    ``width`` can be doubled inside it to one side at least."""
    out = [min(START, -(-width // 4))]
    while 2 * out[-1] < width and 3 * out[-1] - 1 <= width:
        out.append(2 * out[-1])
    return out


def _hashes(b: Block) -> tuple[Rolling, Rolling, np.ndarray]:
    """The words of a block as two independent rolling hashes, and the texts' word offsets."""
    start, end, offsets = b.words()
    return Rolling(b.word_hashes(start, end, 0), 0), Rolling(b.word_hashes(start, end, 1), 1), offsets


def _doubled(first: np.ndarray, n: np.ndarray, at: np.ndarray, length: int, width: int):
    """Runs of windows around blocks of ``length`` at ``at``, split by the side to which the block is doubled.

    Returns (run it was, first window, number of windows, where the doubled block begins, to the right?).
    """
    turn = at - (width - 2 * length)  # from here on the block doubled to the right ends inside the window
    k = np.arange(len(first))
    left = np.clip(turn - first, 0, n)  # the windows before are doubled to the left
    old = np.concatenate([k, k])
    some = np.concatenate([left, n - left])
    right = np.repeat([False, True], len(k))
    begin = np.where(right, first[old] + left[old], first[old])
    place = np.where(right, at[old], at[old] - length)
    has = some > 0
    return old[has], begin[has], some[has], place[has], right[has]


def _find_runs(width: int):
    lengths = levels(width)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            one, two, offsets = _hashes(b)
            values = one.windows(lengths[0])
            first, n, anchor = runs(int(offsets[-1]), offsets, values, width, lengths[0])
            if not len(first):
                continue
            keys, at = [values[anchor]], anchor
            for length in lengths[:-1]:
                old, first, n, at, right = _doubled(first, n, at, length, width)
                keys = [k[old] for k in keys]
                keys.append(mix(one.ranges(at, at + 2 * length) + right.astype(U)))
                anchor = anchor[old]
            end, lead = first + n - 1 + width, (anchor - first).astype(U)
            doc = np.searchsorted(offsets, first, side="right") - 1
            ids, texts = (b.rows.column(c).to_numpy() for c in ("__id", "__key"))
            cols = [ids[doc], texts[doc], *(k.view(np.int64) for k in keys), mix(one.ranges(first, end) + lead).view(np.int64),
                    mix(two.ranges(first, end) + lead).view(np.int64), (first - offsets[doc]).astype(np.int32), n.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=_run_names(width))

    return find


def _run_names(width: int) -> list[str]:
    return ["__id", "__key", *(f"a{length}" for length in levels(width)), "d1", "d2", "first", "n"]


def _run_schema(width: int) -> str:
    return ", ".join(f"{c} {'int' if c in ('first', 'n') else 'long'}" for c in _run_names(width))


def _candidates(texts: DataFrame, width: int) -> DataFrame:
    """Runs whose anchors repeat in another document at every level, with the last level's ``anchor``."""
    cand = texts.mapInArrow(_find_runs(width), _run_schema(width))
    for length in levels(width):
        key = f"a{length}"
        found = cand.groupBy(key).agg(F.min("__id").alias("low"), F.max("__id").alias("high"))
        alive = written(found.where("low < high").select(key), f"repeats-alive-{length}")
        near = marked(cand, bitmap(alive, key), key).where("__hit").drop("__hit")
        cand = written(near.join(alive, key), f"repeats-runs-{length}")
        if cand.isEmpty():
            break
    return cand.withColumnRenamed(f"a{levels(width)[-1]}", "anchor")


def _open_runs(width: int):
    """Single windows of listed runs: (__id, __key, w1, w2, first)."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            one, two, offsets = _hashes(b)
            lists = b.rows.column(b.rows.schema.get_field_index("runs")).to_pylist()
            first = np.concatenate([np.concatenate([np.arange(r["first"], r["first"] + r["n"]) for r in rs]) for rs in lists])
            doc = np.repeat(np.arange(len(lists)), [sum(r["n"] for r in rs) for rs in lists])
            at = first + offsets[doc]
            ids, keys = (b.rows.column(c).to_numpy() for c in ("__id", "__key"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (ids[doc], keys[doc], one.ranges(at, at + width).view(np.int64),
                                       two.ranges(at, at + width).view(np.int64), first.astype(np.int32))],
                names=["__id", "__key", "w1", "w2", "first"])

    return windows


def repeated_spans(docs: DataFrame, width: int = 50) -> DataFrame:
    """(__id, __key, start, stop): word spans covered by windows that start in a document with a smaller id.

    ``docs`` needs __id, __key and text (see ``keyed``). The table is in the shared folder.
    """
    texts = docs.select("__id", "__key", "text")
    cand = _candidates(texts, width)

    same = ["anchor", "d1", "d2"]
    kinds = written(cand.groupBy(*same).agg(F.min("__id").alias("least")), "repeats-kinds")
    mixed = kinds.groupBy("anchor").count().where("count > 1").select("anchor", F.lit(True).alias("mixed"))
    kinds = written(kinds.join(mixed, "anchor", "left"), "repeats-mixed")
    judged = cand.join(kinds, same).select(
        "__id", "__key", "first", "n", (F.col("__id") > F.col("least")).alias("whole"), "mixed")
    judged = written(judged.where("whole or mixed"), "repeats-judged")
    whole = judged.where("whole").select("__id", "__key", F.col("first").alias("start"),
                                         (F.col("first") + F.col("n") - 1 + width).alias("stop"))

    # the first document of each differing run: its windows may start in another run of a smaller id
    rest = written(judged.where("not whole").groupBy("__id", "__key").agg(
        F.collect_set(F.struct("first", "n")).alias("runs")), "repeats-open")
    there = marked(texts, bitmap(rest, "__id"), "__id").where("__hit").drop("__hit").dropDuplicates(["__id", "__key"])
    windows = written(there.join(rest, ["__id", "__key"]).mapInArrow(
        _open_runs(width), "__id long, __key long, w1 long, w2 long, first int"), "repeats-windows")
    least = windows.groupBy("w1", "w2").agg(F.min("__id").alias("low"), F.max("__id").alias("high"))
    least = written(least.where("low < high").drop("high"), "repeats-least")
    single = windows.join(least, ["w1", "w2"]).where("__id > low").select(
        "__id", "__key", F.col("first").alias("start"), (F.col("first") + width).alias("stop"))
    return written(whole.unionByName(single), "repeats-spans")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their spans, with counts and digest; white space before kept words stays."""
    for b in blocks(batches):
        start, end, offsets = b.words()
        raw = b.bytes.tobytes()
        keep = np.ones(len(start), bool)
        spans = b.rows.column(b.rows.schema.get_field_index("spans")).to_pylist()
        texts, n_words, n_removed, shas = [], [], [], []
        for i, ss in enumerate(spans):
            lo, hi = offsets[i], offsets[i + 1]
            here = raw[b.offsets[i]:b.offsets[i + 1]]
            if ss:
                for s in ss:
                    keep[lo + s["start"]:lo + s["stop"]] = False
                k = keep[lo:hi]
                begin = start[lo:hi] - b.offsets[i]
                stop = np.append(begin[1:], len(here))  # a removed word goes with the white space after it
                edge = np.flatnonzero(np.diff(np.concatenate(([False], k, [False]))))
                parts = [here[begin[x]:stop[y - 1]] for x, y in zip(edge[::2], edge[1::2])]
                here = (here[:begin[0]] if len(begin) else b"") + b"".join(parts)
            words = here.split()
            texts.append(here)
            n_words.append(int(hi - lo))
            n_removed.append(int(hi - lo) - len(words))
            shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
        out = pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(shas)],
            names=["n_words", "n_removed", "kept_sha256"])
        names = [c for c in b.rows.schema.names if c not in ("spans", "repeats")]
        cols = [pa.array(texts, pa.binary()).cast(pa.string()) if c == "text" else b.rows.column(b.rows.schema.get_field_index(c)) for c in names]
        yield pa.RecordBatch.from_arrays([*cols, out], names=[*names, "repeats"])


READS = ("doc_id", "text")


def remove_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text`` and a struct ``repeats``: n_words (before),
    n_removed and kept_sha256 (of the kept words joined by one space), which replaces a column of that name."""
    rows = _cut_rows(docs, width)
    return rows.select(*unpacked(rows, docs, *READS, leave=("repeats",)), "repeats")


def without_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """``docs`` with the repeated words cut out of ``text``; all columns are kept, and there are no others."""
    rows = _cut_rows(docs, width)
    return rows.select(*unpacked(rows, docs, *READS))


def _cut_rows(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, cut text, the other columns packed, and ``repeats``."""
    docs = keyed(packed(docs, *READS))
    own = [*READS, EXTRAS]
    spans = repeated_spans(docs, width)
    lists = written(spans.groupBy("__id", "__key").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "repeats-lists")
    both = marked(docs, bitmap(lists, "__id"), "__id")
    plain = both.where("not __hit").select(*own, F.lit(None).cast(lists.schema["spans"].dataType).alias("spans"))
    joined = both.where("__hit").join(lists, ["__id", "__key"], "left").select(*own, "spans")
    schema = schema_with(docs.select(*own), "repeats", REPEATS)
    return plain.mapInArrow(_cut, schema).unionByName(joined.mapInArrow(_cut, schema))


def query(spark, sf_dir: str) -> DataFrame:
    """op9: 50-word windows that start in an earlier document, removed from every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "repeats.n_words", "repeats.n_removed", "repeats.kept_sha256")


#: A window is compared as its words joined by one space. Words are unnested in their order.
SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) < doc_id AS again FROM s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM f WHERE again),
g AS (SELECT doc_id, list(k) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(words, lambda x, k: NOT coalesce(list_contains(gone, k), false)), ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""

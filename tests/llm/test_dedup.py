"""Operators 3, 4 and 9 against brute force."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import components, near_dedup, substring_dedup, suffix_dedup
from tests.llm import cases

ROWS = cases.corpus()


@pytest.mark.parametrize("width", [50, 7, 1, 60])
def test_repeated_words(spark, width):
    docs = cases.frame(spark, ROWS)
    out = substring_dedup.remove_repeats(docs, width)
    assert out.columns == [c for c in docs.columns if c != "repeats"] + ["repeats"]  # an input column of that name is replaced
    got = out.select("doc_id", "repeats.n_words", "repeats.n_removed", "repeats.kept_sha256", "text").collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter(cases.remove_words(ROWS, width))
    assert all(len(cases.words(r.text)) == r.n_words - r.n_removed for r in got)
    whole = {r[0]: r[1] for r in ROWS}
    assert all(r.text == whole[r.doc_id] for r in got if not r.n_removed and r.doc_id in whole and r.doc_id not in (None, 700, 802))


@pytest.mark.parametrize("width, part, segments", [(60, 20, 2000), (60, 20, 2), (400, 128, 2000), (400, 128, 2)])
def test_repeated_bytes(spark, monkeypatch, width, part, segments):
    monkeypatch.setattr(suffix_dedup, "SHARD_SEGMENTS", segments)  # 2: most anchors are split over shards
    out = suffix_dedup.remove_repeated_bytes(cases.frame(spark, ROWS), width, part)
    got = out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.length("kept").alias("n")).collect()
    assert Counter(tuple(r)[:5] for r in got) == Counter(cases.remove_bytes(ROWS, width))
    assert all(r.n == r.n_bytes - r.n_removed for r in got)


@pytest.mark.parametrize("size, block", [(2, 1 << 20), (5, 1 << 20), (2, 50)])
def test_near_duplicates(spark, monkeypatch, size, block):
    monkeypatch.setattr(near_dedup, "BLOCK_ELEMENTS", block)
    got = near_dedup.near_duplicates(cases.frame(spark, ROWS), size).collect()
    assert Counter(tuple(r) for r in got if r.doc_id is not None) == Counter(cases.near_groups(ROWS, size))
    none = [r for r in got if r.doc_id is None]
    assert len(none) == 3 and all(r.component_id is None and r.kept for r in none)


def test_links_among_members_that_miss_their_hub(spark):
    """Two texts at 0.75 of the hub but at 0.9 of each other: found through their common differences."""
    base = [f"b{i}" for i in range(200)]
    far = base[:170] + [f"x{i}" for i in range(30)]
    rows = [cases.row(i, " ".join(base[:k] + ["y"] + base[k + 1:])) for i, k in enumerate(range(20, 160, 4))]
    rows += [cases.row(500 + i, " ".join(far[:5 + i] + ["z"] + far[6 + i:])) for i in range(4)]
    got = near_dedup.near_duplicates(cases.frame(spark, rows), 1).collect()
    assert Counter(map(tuple, got)) == Counter(cases.near_groups(rows, 1))
    assert len({r.component_id for r in got}) == 2


def test_one_of_each(spark):
    docs = cases.frame(spark, ROWS)
    out = near_dedup.one_of_each(docs)
    assert out.columns == docs.columns
    kept = cases.kept_ids(ROWS, 5)
    assert kept.count(802) == 2  # an id with two unrelated texts loses neither
    got = [r.doc_id for r in out.select("doc_id").collect()]
    assert Counter(i for i in got if i is not None) == Counter(kept)
    assert got.count(None) == 3


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 101), (300, 300), (7, 3), (7, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "u long, v long").repartition(7)).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 105: 100}


def test_empty_tables(spark):
    docs = cases.frame(spark, [])
    assert substring_dedup.remove_repeats(docs).count() == 0
    assert suffix_dedup.remove_repeated_bytes(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0
    assert near_dedup.one_of_each(docs).count() == 0

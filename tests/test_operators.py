"""Relational operators: keep-first, membership, filters, counts."""

import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerspark.operators import (carry_over, day_count, frequency, keep_first, member_of,
                                   month_guard, top_n)


def test_keep_first_nulls_equal_and_order(spark):
    df = spark.createDataFrame(
        [(1, "a", None, "x1"), (2, "a", None, "x2"), (3, "a", 1, "x3"), (4, None, None, "x4"),
         (5, None, None, "x5"), (0, "b", 2, "x0")],
        "_seq long, k1 string, k2 long, v string")
    out = sorted(tuple(r) for r in keep_first(df, ["k1", "k2"]).collect())
    assert out == [(0, "b", 2, "x0"), (1, "a", None, "x1"), (3, "a", 1, "x3"), (4, None, None, "x4")]
    assert keep_first(df, ["k1", "k2"]).columns == df.columns


def test_keep_first_requires_sequence(spark):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    with pytest.raises(ValueError):
        keep_first(df, ["k"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 2)), min_size=1,
                max_size=40), st.integers(1, 5))
def test_keep_first_matches_drop_duplicates(spark, data, parts):
    recs = [(i, k, v) for i, (k, v) in enumerate(data)]
    pdf = pd.DataFrame(recs, columns=["_seq", "k", "v"])
    expected = sorted(map(tuple, pdf.drop_duplicates(subset=["k"], keep="first")
                          .astype(object).where(pdf.notna(), None).values.tolist()))
    # shuffle the physical order: the result must depend on _seq only
    df = spark.createDataFrame(list(reversed(recs)), "_seq long, k string, v long").repartition(parts)
    got = sorted(tuple(r) for r in keep_first(df, ["k"]).collect())
    assert got == expected
    again = sorted(tuple(r) for r in keep_first(keep_first(df, ["k"]), ["k"]).collect())
    assert again == got                           # idempotent


def test_member_of_policies(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x long")
    ids = spark.createDataFrame([(2,), (3,)], "id long")
    empty = spark.createDataFrame([], "id long")
    col = lambda d: sorted((r.x for r in d.collect()), key=lambda v: (v is None, v))
    assert col(member_of(df, "x", None)) == [1, 2, None]              # no list: no filter
    assert col(member_of(df, "x", [])) == [1, 2, None]                # empty: no filter
    assert col(member_of(df, "x", empty)) == [1, 2, None]
    assert col(member_of(df, "x", [2, None, "3", 2.0])) == [2]        # null never matches
    assert col(member_of(df, "x", ids)) == [2]
    assert col(member_of(df, "x", [], empty="none")) == []            # J6: empty -> nothing
    assert col(member_of(df, "x", empty, empty="none")) == []
    assert col(member_of(df, "x", ids, empty="none")) == [2]


def test_carry_over_boundaries(spark):
    asof = "2024-03-15"
    data = [("2024-03-01", "invoiced"), ("2024-03-31", None), ("2024-02-29", "invoiced"),
            ("2024-02-01", "to invoice"), ("2024-02-15", None), ("2024-02-15", ""),
            ("2024-01-31", "no"), (None, "no")]
    df = spark.createDataFrame(data, "d string, s string").withColumn("d", F.to_date("d"))
    keep = [bool(r.k) for r in df.select(carry_over("d", "s", asof).alias("k")).collect()]
    assert keep == [True, True, False, True, True, True, False, False]


def test_day_count_and_month_guard(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-01",), ("2024-01-02",), ("2024-02-03",)],
                               "d string").withColumn("d", F.to_date("d"))
    assert [tuple(r) for r in day_count(df, "d", "2024-01-01").collect()] == \
        [(dt.date(2024, 1, 1), 2, True)]
    assert [tuple(r) for r in day_count(df, "d", "2024-02-01").collect()] == \
        [(dt.date(2024, 2, 1), 0, False)]
    got = sorted(tuple(r) for r in month_guard(df, "d").collect())
    assert got == [(dt.date(2024, 1, 1), 2, True), (dt.date(2024, 2, 1), 0, False)]


def test_frequency_and_top_n(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(10)], "id long, g long")
    assert [tuple(r) for r in frequency(df, F.col("g"), "g").collect()] == [(0, 4), (1, 3), (2, 3)]
    assert [r.id for r in top_n(df, 3, [F.col("id").desc()]).collect()] == [9, 8, 7]


def test_few_row_groups_are_dealt_to_all_cores(spark, tmp_path):
    from ledgerspark.sources.landed import SPREAD_ROWS, spread

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def read(name, files, rows):
        path = str(tmp_path / name)
        spark.range(0, rows, 1, files).selectExpr("id", "id % 7 AS k", "'x' AS other").write.parquet(path)
        return spark.read.parquet(path)

    cores = spark.sparkContext.defaultParallelism
    one = read("one", 1, SPREAD_ROWS)
    dealt = spread(one)
    assert dealt.rdd.getNumPartitions() == cores
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, one.collect()))
    asked = plan(dealt.where("k = 3").select("id"))
    assert "Exchange RoundRobin" in asked and "EqualTo(k,3)" in asked and "ReadSchema: struct<id:bigint,k:bigint>" in asked
    assert "Exchange" not in plan(spread(read("small", 1, SPREAD_ROWS - 1)))
    assert "Exchange" not in plan(spread(read("files", cores, SPREAD_ROWS * cores)))
    assert spread(spark.read.schema("id long").parquet(str(tmp_path / "one")).limit(0)).count() == 0

"""Unit tables for the scalar normalisers (X1-X25); edge rows from FIXTURES.md."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F, types as T

from ledgerspark.functions import (amount, clean_markers, clean_strip, exception_label, id_text,
                                   iso_datetime, list_length, m2m_names, m2o_id, m2o_list_id,
                                   m2o_list_name, m2o_name, parse_date, parse_timestamp,
                                   round_half_even, street_key, strip_doc_code, strip_ws,
                                   tag_names, to_id)
from ledgerspark.functions import periods
from ledgerspark.sinks import sheet_rows


def apply(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    out = df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()
    return [r.o for r in out]


RELATIONS = ['[5, "A, b"]', "[5, 'A']", '[0, "zero"]', "[5]", "[]", "false", "None", "", "12.7",
             "1e3", ' [7, "x"]', "[5, None]", "7", None, "[5.7, 'x']", '["5.7", "x"]',
             '["5", "x"]', "[5, null]", "abc", " 5 ", "[True, 'x']"]


def test_m2o_id_x1(spark):
    got = apply(spark, RELATIONS, m2o_id)
    assert got == [5, 5, 0, 5, None, None, None, None, 12, 1000, 7, 5, 7, None, 5, None, 5, 5,
                   None, 5, 1]


def test_m2o_id_x2_keeps_first_untruncated(spark):
    got = apply(spark, RELATIONS, lambda c: m2o_id(c, allow_scalar=True))
    assert got[14] is None          # [5.7, 'x'] -> 5.7 is not an integer id
    assert got[15] is None          # ["5.7", "x"]
    assert got[16] == 5             # ["5", "x"] -> numeric text accepted
    assert got[8] == 12             # bare text still int(float(...))


def test_m2o_id_bare_number_column(spark):
    x1 = apply(spark, [7, 0, None], lambda c: m2o_id(c, T.LongType()), "bigint")
    x2 = apply(spark, [7, 0, None], lambda c: m2o_id(c, T.LongType(), allow_scalar=True), "bigint")
    assert x1 == [None, None, None]
    assert x2 == [7, None, None]


def test_m2o_id_array_and_struct_columns(spark):
    df = spark.createDataFrame([(["5", "A"], (5, "A")), (["x"], (None, None))],
                               "a array<string>, s struct<id:bigint,name:string>")
    out = df.select(m2o_id("a", T.ArrayType(T.StringType())).alias("a"),
                    m2o_id("s", df.schema["s"].dataType).alias("s"),
                    m2o_name("s", df.schema["s"].dataType).alias("n")).collect()
    assert [tuple(r) for r in out] == [(5, 5, "A"), (None, None, None)]


def test_m2o_name_x3(spark):
    got = apply(spark, RELATIONS, m2o_name)
    assert got[:12] == ["A, b", "A", "zero", None, None, None, None, None, None, None, None, "None"]
    assert got[17] == "None"        # JSON null is Python None -> str -> "None"
    assert got[20] == "x"


def test_m2o_list_name_only_real_lists(spark):
    got = apply(spark, ['[5, "A"]', "[5, 'A']", "[5]", ' [5, "A"]', "[5, null]", None],
                m2o_list_name)
    assert got == ["A", None, None, None, None, None]
    got = apply(spark, ["[5, null]"], lambda c: m2o_list_name(c, none_as_text=True))
    assert got == ["None"]


def test_m2o_list_id_x5(spark):
    assert apply(spark, ['[5, "T"]', "[5, 'T']", '["5", "T"]', "[5.5]", "false"],
                 m2o_list_id) == [5, None, 5, None, None]


def test_exception_label_x7(spark):
    got = apply(spark, ['[3, "Credit"]', "[4]", "[]", "false", "NONE", "NaN", None,
                        "[1,'x']", "manual"], exception_label)
    assert got == ["Credit", "4", "[]", "", "", "", "", "[1,'x']", "manual"]


def test_tag_names_x8(spark):
    m = {1: "one", 2: "two", 3: ""}
    got = apply(spark, ["[1, 2]", "[2, 9, 1]", "[3]", "[]", None, "false", "x"],
                lambda c: tag_names(c, m))
    assert got == ["one, two", "two, one", "", "", "", "", ""]
    assert apply(spark, ["[1]"], lambda c: tag_names(c, {})) == [""]


def test_m2m_names_x9(spark):
    got = apply(spark, ['[[1, "a"], [2, "b"]]', "[[1, 'a'], [3]]", "[1, 2]", "[]", None, "False"],
                m2m_names)
    assert got == ["a,b", "a", None, None, None, None]


def test_list_length_x25(spark):
    assert apply(spark, ["[1, 2]", "[]", "[1]", "false", None, "x"], list_length) == [2, 0, 1, 0, 0, 0]


def test_amount_x10(spark):
    got = apply(spark, [None, "NaN", "1.5", " 5 ", "", "abc", "1d", "-2", "0", "+3", ".5", "inf",
                        "1e3", "1_000"], amount)
    assert got[:11] == [0.0, 0.0, 1.5, 5.0, 0.0, 0.0, 0.0, -2.0, 0.0, 3.0, 0.5]
    assert math.isinf(got[11]) and got[12] == 1000.0 and got[13] == 0.0
    doubles = apply(spark, [None, float("nan"), 2.5], amount, "double")
    assert doubles == [0.0, 0.0, 2.5]


def test_to_id_x11(spark):
    assert apply(spark, ["12", "12.0", "12.5", "abc", None, " 7 "], to_id) == [12, 12, None, None,
                                                                          None, 7]
    assert apply(spark, [3.0, 2.5, float("nan")], lambda c: to_id(c, T.DoubleType()),
                 "double") == [3, None, None]


def test_parse_date_x12(spark):
    got = apply(spark, ["2024-01-01", "2024-01-02 10:00:00", "false", None, "x", "2024",
                        " 2024-02-29 ", "2024-02-30", "2024-03-31T23:59:59"], parse_date)
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None, None, None, None,
                   dt.date(2024, 2, 29), None, dt.date(2024, 3, 31)]
    ts = apply(spark, ["2024-01-02 10:00:00"], parse_timestamp)
    assert ts == [dt.datetime(2024, 1, 2, 10, 0)]


def test_round_half_even_x13(spark):
    got = apply(spark, [0.0000005, 0.0000015, 1.23456789, -33.1234565], round_half_even, "double")
    assert got[0] == 0.0 and got[1] == 0.000002 and got[2] == 1.234568


def test_sheet_rows_x14(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), None, float("nan"), 3, "x"),
                                (None, dt.datetime(2024, 2, 1, 10), 1.5, None, None)],
                               "d date, t timestamp, f double, n bigint, s string")
    got = [tuple(r) for r in sheet_rows(df).collect()]
    assert got == [("2024-01-05", "", "", "3", "x"), ("", "2024-02-01", "1.5", "", "")]


def test_clean_markers_x15(spark):
    got = apply(spark, [None, "None", "False", "nan", "<NA>", "false", "True", " x "], clean_markers)
    assert got == ["", "", "", "", "", "", "True", " x "]


def test_clean_strip_x16(spark):
    got = apply(spark, [None, "false", " x ", "\t x\n", "\xa0x\xa0", "None", "\x1cx"], clean_strip)
    assert got == ["", "", "x", "x", "x", "None", "x"]
    assert apply(spark, ["　y "], strip_ws) == ["y"]


def test_strip_doc_code_x17(spark):
    got = apply(spark, ["(39) Electronic Receipt", "Receipt (39)", "(AB) x", None, "(61)x"],
                strip_doc_code)
    assert got == ["Electronic Receipt", "Receipt (39)", "(AB) x", "", "x"]


def test_street_key_x18(spark):
    assert apply(spark, ["  Main   ST\t 5 ", "MAIN ST 5"], street_key) == ["main st 5", "main st 5"]


def test_iso_datetime_x21(spark):
    got = apply(spark, ["2024-01-01", "2024-01-01 00:00:07.179575", "False", "nan", "x"],
                iso_datetime)
    assert got == ["2024-01-01T00:00:00", "2024-01-01T00:00:07.179575", None, None, None]


def test_id_text_x22(spark):
    got = apply(spark, [12.0, float("nan"), None, 7.5], lambda c: id_text(c, T.DoubleType()),
                "double")
    assert got == ["12", None, None, "7"]


@pytest.mark.parametrize("asof,prev_first,prev_last,minus2", [
    ("2024-03-31", "2024-02-01", "2024-02-29", "2024-01-31"),
    ("2024-04-30", "2024-03-01", "2024-03-31", "2024-02-29"),
    ("2024-01-01", "2023-12-01", "2023-12-31", "2023-11-01"),
    ("2024-01-02", "2023-12-01", "2023-12-31", "2023-11-02"),
])
def test_periods_x6(asof, prev_first, prev_last, minus2):
    pm = periods.previous_month(asof)
    assert (pm.first.isoformat(), pm.last.isoformat()) == (prev_first, prev_last)
    assert periods.minus_months(asof, 2).isoformat() == minus2
    assert periods.is_close_day("2024-05-01") and not periods.is_close_day("2024-05-02")
    assert periods.is_close_day("2024-05-05", window_days=5)

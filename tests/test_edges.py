"""Raising dates, ordered grids, rejects, the footer probe, and the jobs Q5, Q8 and Q9."""

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerspark import schemas
from ledgerspark.functions.rejects import load_with_rejects, read_rejects, rejects
from ledgerspark.plans import jobs, transforms as tf
from ledgerspark.sinks import load, replace_months, upload_grid
from ledgerspark.sinks.snapshots import Snapshots
from ledgerspark.sources.landed import strict_on_or_after
from ledgerspark.sources.probes import day_exists
from tests.test_jobs import LINES, MOVES
from tests.test_transforms import PRODUCTS, raw


def written_grid(path):
    """The parts in turn, as one CSV text."""
    return list(csv.reader("".join(open(f).read() for f in sorted(glob.glob(os.path.join(path, "part-*.csv")))).splitlines()))


# ------------------------------------------------------------ raising dates

@pytest.mark.parametrize("text", ["soon", "2024-13-45", "31/12/2024", "2024-3-1"])
def test_unparsable_dates_raise(spark, tmp_path, text):
    moves = raw(spark, schemas.RAW_INVOICES, [*MOVES, dict(MOVES[2], id=9, _seq=9, invoice_date=text)])
    lines = raw(spark, schemas.RAW_INVOICE_LINES, [*LINES, dict(LINES[1], id=99, _seq=9, date=text)])
    orders = raw(spark, schemas.RAW_ORDERS, [dict(id=1, _seq=1, create_date=text)])
    with pytest.raises(Exception, match="unparsable date"):
        jobs.sync_invoices_sheet(moves, str(tmp_path / "a"), "2024-03-05")
    with pytest.raises(Exception, match="unparsable date"):
        jobs.sync_invoice_lines_sheet(lines, raw(spark, schemas.RAW_INVOICES, MOVES), str(tmp_path / "b"), "2024-03-05")
    with pytest.raises(Exception, match="unparsable date"):
        jobs.carryover_order_ids(orders, "2024-03-05").collect()


def test_empty_dates_match_nothing(spark):
    df = spark.createDataFrame([(None,), ("false",), ("",), (" None ",), ("2024-03-05 10:00:00",), ("2024-02-05",)], "d string")
    assert [r.d for r in df.where(strict_on_or_after("d", "2024-03-01")).collect()] == ["2024-03-05 10:00:00"]


def test_a_bad_date_of_a_draft_is_not_looked_at(spark, tmp_path):
    moves = raw(spark, schemas.RAW_INVOICES, [*MOVES, dict(MOVES[4], id=9, _seq=9, invoice_date="soon")])
    assert jobs.sync_invoices_sheet(moves, str(tmp_path / "a"), "2024-03-05")["loaded"]


def test_clean_dates_reach_the_scan(spark, tmp_path):
    raw(spark, schemas.RAW_INVOICES, MOVES).write.parquet(str(tmp_path / "moves"))
    moves = spark.read.schema(schemas.RAW_INVOICES).parquet(str(tmp_path / "moves"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = jobs.invoices_sheet_plan(moves, "2024-03-05")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(invoice_date,2024-03-01)" in plan


# ------------------------------------------------------------------- grids

def test_the_parts_are_the_tab(spark, tmp_path):
    df = spark.range(500).repartition(7).select(
        (F.col("id") * 7 % 500).alias("_seq"), F.col("id").alias("n"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('a "q", '), "id")).alias("t"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"), (F.col("id") / 4).alias("x"))
    assert upload_grid(df, str(tmp_path / "g"), ["_seq"])
    want = [["n", "t", "day", "x"]] + [[str(r.n), r.t or "", r.day.isoformat(), str(r.x)] for r in sorted(df.collect(), key=lambda r: r._seq)]
    assert written_grid(str(tmp_path / "g")) == want
    assert not upload_grid(df.where("false"), str(tmp_path / "g"), ["_seq"])  # the old tab stays
    assert written_grid(str(tmp_path / "g")) == want


def test_a_tab_has_26_columns(spark, tmp_path):
    wide = lambda n: spark.range(2).select(F.col("id").alias("_seq"), *[F.lit(i).alias(f"c{i}") for i in range(n)])
    assert upload_grid(wide(26), str(tmp_path / "g"), ["_seq"])
    with pytest.raises(ValueError, match="27 columns"):
        upload_grid(wide(27), str(tmp_path / "g"), ["_seq"])
    with pytest.raises(ValueError, match="order column"):
        upload_grid(wide(3).drop("_seq"), str(tmp_path / "g"), ["_seq"])


def test_a_tab_in_a_store(spark, tmp_path):
    store = Snapshots(spark, f"file://{tmp_path}/store")
    rows = spark.createDataFrame([(2, "b"), (1, None)], "_seq long, t string")
    assert upload_grid(rows, store.at("tab"), ["_seq"], formatted=False)
    assert not upload_grid(rows.where("false"), store.at("tab"), ["_seq"])
    assert store.version() == 1 and sorted(r.t or "" for r in store.at("tab").read().collect()) == ["", "b", "t"]


def test_invoice_tabs_in_source_order(spark, tmp_path):
    moves = raw(spark, schemas.RAW_INVOICES, [*MOVES, dict(MOVES[2], id=2, _seq=0), dict(MOVES[2], id=30, _seq=20)])
    assert jobs.sync_invoices_sheet(moves, str(tmp_path / "a"), "2024-03-05")["loaded"]
    assert [r[0] for r in written_grid(str(tmp_path / "a"))] == ["id_factura", "2", "3", "30"]
    lines = raw(spark, schemas.RAW_INVOICE_LINES, [dict(LINES[1], id=40, _seq=7), *LINES, dict(LINES[1], id=5, _seq=6)])
    assert jobs.sync_invoice_lines_sheet(lines, moves, str(tmp_path / "b"), "2024-03-05")["loaded"]
    assert [r[0] for r in written_grid(str(tmp_path / "b"))] == ["id_linea_factura", "11", "5", "40"]


def test_products_tab(spark, tmp_path):
    master = spark.createDataFrame([(300,), (100,), (100,)], "id_producto long")
    assert jobs.sync_products_sheet(raw(spark, schemas.RAW_PRODUCTS, PRODUCTS), master, str(tmp_path / "p"))["loaded"]
    got = written_grid(str(tmp_path / "p"))
    want = tf.products(raw(spark, schemas.RAW_PRODUCTS, PRODUCTS), master.distinct()).orderBy("id_producto_padre")
    assert got[0] == want.columns and [r[1] for r in got[1:]] == [str(r.id_producto_padre) for r in want.collect()]


def test_clients_job(spark, tmp_path):
    partner = dict(company_type="company", type="invoice", vat="1-9", street="Calle 1", active=True, user_id='[4, "V"]')
    partners = raw(spark, schemas.RAW_CLIENTS, [dict(partner, id=1, _seq=1), dict(partner, id=2, _seq=2), dict(partner, id=3, _seq=3, user_id='[5, "W"]'),
                                                dict(partner, id=4, _seq=4, vat="2-7", active=False), dict(partner, id=5, _seq=5, vat="2-7")])
    vendors = spark.createDataFrame([(4,)], "id_vendedor long")
    target = str(tmp_path / "c")
    assert jobs.sync_clients(partners, vendors, target) == {"loaded": True}
    assert sorted(r.id_cliente for r in spark.read.parquet(target).collect()) == [1, 5]
    assert jobs.sync_clients(partners, vendors.where("false"), target) == {"loaded": True}
    assert sorted(r.id_cliente for r in spark.read.parquet(target).collect()) == [1, 3, 5]
    assert jobs.sync_clients(partners.where("false"), vendors, target) == {"loaded": False}


# ------------------------------------------------------- probe and rejects

def test_the_probe_reads_rows_only_between_the_footers(spark, tmp_path):
    target = Snapshots(spark, f"file://{tmp_path}/store").at("h")
    rows = spark.createDataFrame([(1, "2024-01-03"), (2, "2024-01-09"), (3, "2024-01-20"), (4, "2024-03-01"), (5, None)], "id long, d string")
    replace_months(rows.select("id", F.col("d").cast("date").alias("d")), target, "d")
    expected = {"2024-01-03": (True, "pies"), "2024-01-20": (True, "pies"), "2024-01-01": (False, "pies"), "2024-01-31": (False, "pies"),
                "2024-01-09": (True, "filas"), "2024-01-10": (False, "filas"), "2024-02-01": (False, "meses"), "2024-03-01": (True, "pies")}
    assert {d: tuple(day_exists(target, "d", d).values()) for d in expected} == expected


def test_rejects_keep_what_the_casts_lose(spark, tmp_path):
    df = spark.createDataFrame([(1, "1.5", "x", "2024-01-01"), (2, "1,5", "3", "01/02/2024"), (3, "false", None, ""), (4, "2.5", "2.5", "2024-13-01")],
                               "id long, n string, i string, d string")
    found = df.select("id", rejects(df, ["n", "absent"], ["i"], ["d"])).select("id", F.inline("_rejects"))
    assert sorted(map(tuple, found.collect())) == [
        (1, "i", "x", "not an integer"), (2, "d", "01/02/2024", "not a date"), (2, "n", "1,5", "not a number"),
        (4, "d", "2024-13-01", "not a date"), (4, "i", "2.5", "not an integer")]
    store = Snapshots(spark, f"file://{tmp_path}/store")
    load_with_rejects(store.begin(), "t", df.select("id", rejects(df, ["n"])), "id").commit()
    assert store.at("t").read().columns == ["id"] and store.table("t").count() == 4
    assert [tuple(r) for r in read_rejects(store.at("t")).collect()] == [(2, "n", "1,5", "not a number")]
    assert len(os.listdir(tmp_path / "store" / "data")) == 1  # one write


def test_order_lines_with_rejects(spark):
    lines = raw(spark, schemas.RAW_ORDER_LINES, [dict(id=1, _seq=1, price_unit=1.0)]).withColumn("discount", F.lit("ten"))
    row = tf.order_lines(lines, with_rejects=True).first()
    assert row.descuento == 0.0 and [tuple(r) for r in row["_rejects"]] == [("discount", "ten", "not a number")]

"""Sources, sinks and jobs: load policies, month close, backfill, sheets, visits."""

import datetime as dt
import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerspark import schemas
from ledgerspark.plans import jobs
from ledgerspark.sinks import load, replace_months, upload_sheet, with_month
from ledgerspark.sources import fetch, read_landed, taxes_raw, visit_listing, visits_of_day
from tests.test_transforms import raw

MOVES = [
    dict(id=1, state="posted", move_type="out_invoice", invoice_date="2024-02-01",
         partner_id='[7, "C"]', _seq=1),
    dict(id=2, state="posted", move_type="out_refund", invoice_date="2024-02-29 12:00:00",
         partner_id='[7, "C"]', _seq=2),
    dict(id=3, state="posted", move_type="out_invoice", invoice_date="2024-03-01",
         partner_id='[8, "D"]', _seq=3),
    dict(id=4, state="posted", move_type="in_invoice", invoice_date="2024-03-02",
         partner_id='[8, "D"]', _seq=4),
    dict(id=5, state="draft", move_type="out_invoice", invoice_date="2024-03-02",
         partner_id='[8, "D"]', _seq=5),
    dict(id=6, state="posted", move_type="out_invoice", invoice_date="2024-01-31",
         partner_id='[8, "D"]', _seq=6),
]
LINES = [
    dict(id=10, move_id='[1, "F1"]', product_id='[5, "P"]', price_subtotal=1.0,
         display_type="product", date="2024-02-01", _seq=1),
    dict(id=11, move_id='[3, "F3"]', product_id='[5, "P"]', price_subtotal=2.0,
         display_type="product", date="2024-03-01", _seq=2),
    dict(id=12, move_id='[3, "F3"]', product_id='[5, "P"]', price_subtotal=2.0,
         display_type="line_section", date="2024-03-01", _seq=3),
    dict(id=13, move_id='[4, "F4"]', product_id='[5, "P"]', price_subtotal=2.0,
         display_type="product", date="2024-03-02", _seq=4),
    dict(id=14, move_id='[6, "F6"]', product_id='[5, "P"]', price_subtotal=3.0,
         display_type="product", date="2024-01-31", _seq=5),
]


def ids(df, col):
    return sorted(r[col] for r in df.collect())


def test_month_close_and_current_month(spark):
    moves = raw(spark, schemas.RAW_INVOICES, MOVES)
    assert ids(jobs.closed_month_invoices_plan(moves, "2024-03-01"), "id_factura") == [1, 2]
    assert ids(jobs.current_month_invoices_plan(moves, "2024-03-15"), "id_factura") == [3]


def test_sync_invoices_idempotent(spark, tmp_path):
    moves = raw(spark, schemas.RAW_INVOICES, MOVES)
    hist, cur = str(tmp_path / "hist"), str(tmp_path / "cur")
    for _ in range(2):                                   # re-run on the same close day
        done = jobs.sync_invoices(moves, hist, cur, "2024-03-01")
        assert done == {"closed": True, "current": True}
    h = spark.read.parquet(hist)
    assert ids(h, "id_factura") == [1, 2]                # no duplicates after a re-run
    assert [str(r.mes) for r in h.select("mes").distinct().collect()] == ["2024-02-01"]
    assert ids(spark.read.parquet(cur), "id_factura") == [3]
    done = jobs.sync_invoices(moves, hist, cur, "2024-03-02")
    assert done["closed"] is False


def test_sync_invoice_lines(spark, tmp_path):
    lines = raw(spark, schemas.RAW_INVOICE_LINES, LINES)
    moves = raw(spark, schemas.RAW_INVOICES, MOVES)
    hist, cur = str(tmp_path / "lh"), str(tmp_path / "lc")
    jobs.sync_invoice_lines(lines, moves, hist, cur, "2024-03-01")
    assert ids(spark.read.parquet(hist), "id_linea_factura") == [10]
    assert ids(spark.read.parquet(cur), "id_linea_factura") == [11]


def test_backfill_single_pass(spark, tmp_path):
    moves = raw(spark, schemas.RAW_INVOICES, MOVES)
    lines = raw(spark, schemas.RAW_INVOICE_LINES, LINES)
    h, ln = str(tmp_path / "bh"), str(tmp_path / "bl")
    jobs.backfill(moves, lines, h, ln, "2024-03-10", start="2024-01-01")
    got = sorted((r.id_factura, str(r.mes)) for r in spark.read.parquet(h).collect())
    assert got == [(1, "2024-02-01"), (2, "2024-02-01"), (6, "2024-01-01")]
    assert ids(spark.read.parquet(ln), "id_linea_factura") == [10, 14]


def test_load_skips_empty_and_keeps_old(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "x long")
    assert load(df, target) is True
    assert load(df.where("x > 5"), target) is False
    assert ids(spark.read.parquet(target), "x") == [1]
    assert load(df.where("x > 5"), target, skip_if_empty=False) is True
    assert spark.read.parquet(target).count() == 0


def test_load_append(spark, tmp_path):
    target = str(tmp_path / "a")
    df = spark.createDataFrame([(1,)], "x long")
    load(df, target, mode="append")
    load(df, target, mode="append")
    assert ids(spark.read.parquet(target), "x") == [1, 1]


def test_replace_months_only_touches_present_months(spark, tmp_path):
    target = str(tmp_path / "h")
    a = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 2, 5))], "x long, d date")
    replace_months(a, target, "d")
    b = spark.createDataFrame([(3, dt.date(2024, 2, 9))], "x long, d date")
    replace_months(b, target, "d")
    assert ids(spark.read.parquet(target), "x") == [1, 3]


def test_sync_orders_metrics(spark, tmp_path):
    recs = [dict(id=1, create_date="2024-03-02", date_order="2024-03-02", invoice_status="invoiced",
                 _seq=1),
            dict(id=2, create_date="2024-02-10", date_order="2024-02-10", invoice_status="invoiced",
                 _seq=2),
            dict(id=3, create_date="2024-02-11", date_order="2024-02-11", invoice_status=None,
                 _seq=3),
            dict(id=4, create_date="2024-01-20", date_order="2024-01-20", invoice_status=None,
                 _seq=4)]
    orders = raw(spark, schemas.RAW_ORDERS, recs)
    out = jobs.sync_orders(orders, str(tmp_path / "o"), "2024-03-15")
    assert out["loaded"] and out["metrics"] == {"discarded_invoiced": 1, "loaded": 2}
    assert ids(spark.read.parquet(str(tmp_path / "o")), "id_pedido") == [1, 3]


def test_sync_order_lines_semi_join(spark, tmp_path):
    orders = raw(spark, schemas.RAW_ORDERS, [
        dict(id=1, create_date="2024-03-02", invoice_status="invoiced", _seq=1),
        dict(id=2, create_date="2024-02-10", invoice_status="invoiced", _seq=2),
        dict(id=3, create_date="2024-02-11", invoice_status="to invoice", _seq=3)])
    lines = raw(spark, schemas.RAW_ORDER_LINES, [
        dict(id=i, order_id=f'[{o}, "SO"]', create_date="2024-03-01", product_uom_qty=1.0,
             price_unit=1.0, price_subtotal=1.0, discount=0.0)
        for i, o in [(10, 1), (11, 2), (12, 3), (13, 9)]])
    jobs.sync_order_lines(orders, lines, str(tmp_path / "ol"), "2024-03-15")
    assert ids(spark.read.parquet(str(tmp_path / "ol")), "id_linea") == [10, 12]
    none = orders.where("id = 2")
    assert jobs.sync_order_lines(none, lines, str(tmp_path / "ol2"), "2024-03-15") == {"loaded": False}


def test_sheet_upload_is_text_csv(spark, tmp_path):
    moves = raw(spark, schemas.RAW_INVOICES, MOVES)
    path = str(tmp_path / "sheet")
    assert jobs.sync_invoices_sheet(moves, path, "2024-03-05")["loaded"]
    text = "".join(open(f).read() for f in glob.glob(os.path.join(path, "*.csv")))
    assert "id_factura" in text and "2024-03-01" in text
    empty = moves.where("id < 0")
    assert upload_sheet(empty, str(tmp_path / "sheet2")) is False


def test_products_job_writes_schema(spark, tmp_path):
    from tests.test_transforms import PRODUCTS
    prods = raw(spark, schemas.RAW_PRODUCTS, PRODUCTS)
    master = spark.createDataFrame([(100,), (300,)], "id_producto long")
    taxes = spark.createDataFrame([(1,), (None,)], "id_impuestos long")
    out = jobs.sync_products(prods, master, taxes, str(tmp_path / "p"), str(tmp_path / "b"))
    assert out == {"products": True, "bridge": True}
    p = spark.read.parquet(str(tmp_path / "p"))
    assert [f.name for f in p.schema.fields] == schemas.names(schemas.PRODUCTS)
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "b")).collect()) == [(11, 1)]


def test_fetch_limit_and_taxes(spark):
    taxes = raw(spark, schemas.RAW_TAXES, [dict(id=i, name=f"T{i}", amount=0.19, _seq=200 - i)
                                           for i in range(150)])
    assert taxes_raw(taxes).count() == 150                # no silent limit
    got = taxes_raw(taxes, limit=100).collect()
    assert len(got) == 100 and got[0].id == 149          # first 100 in source order
    assert fetch(taxes, limit=0).count() == 150


def test_read_landed_json(spark, tmp_path):
    p = tmp_path / "clients.json"
    p.write_text("\n".join(json.dumps(r) for r in [
        {"id": 1, "user_id": [3, "V"], "category_id": [1, 2], "active": True,
         "credit_limit": 12.5, "_seq": 1},
        {"id": 2, "user_id": False, "active": False, "credit_limit": False, "_seq": 2}]))
    df = read_landed(spark, str(p), schemas.RAW_CLIENTS, fmt="json")
    got = {r.id: (r.user_id, r.category_id, r.credit_limit) for r in df.collect()}
    # nested values stay raw JSON text, an ERP false becomes the text "false", numbers too
    assert got == {"1": ('[3, "V"]', "[1, 2]", "12.5"), "2": ("false", None, "false")}
    from ledgerspark.plans import transforms as tf
    from ledgerspark.sources import clients_raw
    active = clients_raw(df)
    assert [r.id for r in active.collect()] == ["1"]
    row = tf.clients(active, tags={1: "A", 2: "B"}).collect()[0]
    assert (row.id_cliente, row.id_vendedor, row.etiquetas, row.credito_limite) == (1, 3, "A, B", 12.5)


def test_visits_of_day(spark):
    payloads = spark.createDataFrame([
        ('[{"id": 1, "status": "success", "planned_date": "2026-01-12"},'
         ' {"id": 2, "status": "failed", "planned_date": "2026-01-13"}]', 1),
        ('{"results": [{"id": 3, "reference": "R-123456789012345678901234", '
         '"title": "A very long visit title that is cut", "planned_date": "2026-01-12"}]}', 2),
        ('{"detail": "nothing"}', 3), ("[]", 4), (None, 5)], "payload string, _seq long")
    out = visit_listing(visits_of_day(payloads, "2026-01-12"))
    got = sorted((r.id, r.status, r.referencia, r.titulo) for r in out.collect())
    assert got == [(1, "success", "S/R", "Sin nombre"),
                   (3, None, "R-123456789012345678901234", "A very long visit title that is cut")]
    assert F is not None


# ------------------------------------------------------------- safe writes

def _lines_of(spark, target):
    df = spark.read.parquet(target) if "/" in target else spark.table(target)
    return sorted(tuple(r) for r in df.select("id", "fecha").collect())


@pytest.fixture(params=["path", "table"])
def target(request, spark, tmp_path):
    if request.param == "path":
        yield str(tmp_path / "target")
        return
    name = f"t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _dated(spark, rows):
    return spark.createDataFrame([(i, dt.date.fromisoformat(d)) for i, d in rows], "id long, fecha date")


def test_replace_months_keeps_other_months(spark, target):
    jan, feb = (1, "2026-01-05"), (2, "2026-02-05")
    assert replace_months(_dated(spark, [jan, feb]), target, "fecha")
    assert replace_months(_dated(spark, [(3, "2026-02-07")]), target, "fecha")
    assert not replace_months(_dated(spark, []), target, "fecha")
    assert [r[0] for r in _lines_of(spark, target)] == [1, 3]


def test_failed_load_keeps_content(spark, target):
    assert load(_dated(spark, [(1, "2026-01-05"), (2, "2026-01-06")]), target)
    bad = _dated(spark, [(3, "2026-01-05")]).withColumn("id", F.expr("id + CAST(raise_error('boom') AS BIGINT)"))
    for skip in (True, False):
        with pytest.raises(Exception, match="boom"):
            load(bad, target, skip_if_empty=skip)
    assert not load(_dated(spark, []), target)
    assert [r[0] for r in _lines_of(spark, target)] == [1, 2]
    assert load(_dated(spark, []), target, skip_if_empty=False)
    assert _lines_of(spark, target) == []


def test_partitioned_load_truncates(spark, target):
    load(with_month(_dated(spark, [(1, "2026-01-05"), (2, "2026-02-06")]), "fecha"), target, partition_by=["mes"])
    load(with_month(_dated(spark, [(3, "2026-01-07")]), "fecha"), target, partition_by=["mes"])
    assert [r[0] for r in _lines_of(spark, target)] == [3]
    load(with_month(_dated(spark, [(4, "2026-03-07")]), "fecha"), target, mode="append", partition_by=["mes"])
    assert [r[0] for r in _lines_of(spark, target)] == [3, 4]


def test_failed_sheet_keeps_content(spark, tmp_path):
    path = str(tmp_path / "sheet")
    wide = spark.range(1).select(*[F.lit(i * 1e7).alias(f"c{i}") for i in range(30)])  # more columns than A:Z
    assert upload_sheet(wide, path)
    assert not upload_sheet(wide.where("false"), path)
    with pytest.raises(Exception, match="boom"):
        upload_sheet(wide.withColumn("c0", F.expr("raise_error('boom')")), path)
    row = spark.read.option("header", True).csv(path).first()
    assert (row.c1, row.c2) == ("10000000.0", "20000000.0")


# ------------------------------------------------------------- empty inputs

def test_empty_inputs_give_empty_results(spark):
    master = spark.createDataFrame([(1,), (2,)], "id_producto long")
    empty = {n: raw(spark, s, []) for n, s in (("p", schemas.RAW_PRODUCTS), ("o", schemas.RAW_ORDERS), ("c", schemas.RAW_CLIENTS),
                                               ("ol", schemas.RAW_ORDER_LINES), ("i", schemas.RAW_INVOICES), ("il", schemas.RAW_INVOICE_LINES))}
    from ledgerspark.plans import transforms as tf
    frames = [tf.products(empty["p"], master), tf.product_taxes(empty["p"], master, spark.range(1).withColumnRenamed("id", "id_impuestos")),
              tf.orders(empty["o"]), tf.clients(empty["c"]), tf.order_lines(empty["ol"]), tf.invoices(empty["i"]),
              tf.invoice_lines(empty["il"])]
    assert all(f.count() == 0 for f in frames)


def test_no_carryover_order_gives_no_lines(spark, tmp_path):
    orders = raw(spark, schemas.RAW_ORDERS, [dict(id=1, create_date="2020-01-01 10:00:00", invoice_status="invoiced", _seq=1)])
    lines = raw(spark, schemas.RAW_ORDER_LINES, [dict(id=1, order_id='[1, "S"]', create_date="2026-07-01 10:00:00",
                                                      product_uom_qty=1.0, price_unit=1.0, price_subtotal=1.0, discount=0.0, _seq=1)])
    assert jobs.order_lines_carryover_plan(orders, lines, "2026-07-15").count() == 0
    assert jobs.sync_order_lines(orders, lines, str(tmp_path / "x"), "2026-07-15") == {"loaded": False}


def test_backfill_is_the_month_loop(spark):
    from ledgerspark.plans import transforms as tf
    rel = dict(partner_id='[1, "C"]', invoice_user_id="false", partner_shipping_id="false", l10n_latam_document_type_id="false",
               invoice_payment_term_id="false", state="posted")
    rows = [dict(id=1, invoice_date="2026-01-05", _seq=1, **rel), dict(id=1, invoice_date="2026-02-05", _seq=2, **rel),
            dict(id=2, invoice_date="2026-01-05", _seq=4, **rel), dict(id=2, invoice_date="2026-02-05", _seq=3, **rel),
            dict(id=3, invoice_date="2026-01-07", _seq=6, **rel), dict(id=3, invoice_date="2026-01-06", _seq=5, **rel)]
    got = tf.invoices(raw(spark, schemas.RAW_INVOICES, rows), by_month=True).select("id_factura", "fecha_factura").collect()
    assert sorted((r[0], r[1].isoformat()) for r in got) == [
        (1, "2026-01-05"), (1, "2026-02-05"), (2, "2026-02-05"), (3, "2026-01-06")]


def test_tags_do_not_depend_on_table_size(spark):
    from ledgerspark.operators import tag_names_from_table
    tags = spark.createDataFrame([(1, "A"), (1, "B"), (2, "C"), (3, "")], "id long, name string")
    df = spark.createDataFrame([("[1, 2]", 1), ("[1, 'x', 2]", 2), ("false", 3), ("[9, 3]", 4), ("[2, 2]", 5)], "t string, _seq long")
    got = {r["_seq"]: r["names"] for r in tag_names_from_table(df, "t", tags, "names").collect()}
    assert got == {1: "B, C", 2: "B, C", 3: "", 4: "", 5: "C, C"}


def test_checkpoint_folder_is_required():
    from ledgerspark.session import checkpoint_dir

    class Context:
        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())

"""Composite transforms T1-T6 on small dirty fixtures (expected rows by hand)."""

import datetime as dt

import pytest
from pyspark.sql import Row

from ledgerspark import schemas
from ledgerspark.plans import transforms as tf


def raw(spark, schema, records):
    """Records as dicts; absent fields are null."""
    names = schemas.names(schema)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def by(df, key):
    return {r[key]: r for r in df.collect()}


# ------------------------------------------------------------------ T4 invoices

INVOICES = [
    # duplicate id: draft first, then posted -> the posted one survives (P2 before A4)
    dict(id=1, name=" F-1 ", state="draft", invoice_date="2024-01-01", partner_id='[7, "C"]',
         _seq=1),
    dict(id=1, name="F-1b", state="posted", invoice_date="2024-01-01", partner_id='[7, "C"]',
         amount_total=10.0, _seq=2),
    # two posted copies -> first in source order
    dict(id=2, name="A", state="posted", invoice_date="2024-01-31 10:00:00",
         partner_id='[8, "D"]', invoice_user_id='[3, "V"]', _seq=3,
         l10n_latam_document_type_id='[39, "(39) Electronic Receipt"]',
         invoice_payment_term_id='[1, "30 days"]', amount_untaxed=None, amount_tax=float("nan")),
    dict(id=2, name="B", state="posted", invoice_date="2024-01-31", partner_id='[8, "D"]', _seq=4),
    # null client, null date -> dropped
    dict(id=3, state="posted", invoice_date="2024-01-05", partner_id="false", _seq=5),
    dict(id=4, state="posted", invoice_date=None, partner_id='[9, "E"]', _seq=6),
    # posted with padding and a tuple-looking doc type text
    dict(id=5, name="\tX\n", state=" posted ", invoice_date="2024-02-01", partner_id="[9, 'E']",
         l10n_latam_document_type_id="[61, 'Credit Note']", invoice_date_due="false", _seq=7),
]


def test_invoices(spark):
    out = tf.invoices(raw(spark, schemas.RAW_INVOICES, INVOICES))
    assert out.columns == schemas.names(schemas.INVOICES)
    got = by(out, "id_factura")
    assert sorted(got) == [1, 2, 5]
    assert got[1].numero_factura == "F-1b" and got[1].total_factura == 10.0
    two = got[2]
    assert (two.numero_factura, two.fecha_factura, two.tipo_documento, two.condicion_pago) == \
        ("A", dt.date(2024, 1, 31), "Electronic Receipt", "30 days")
    assert (two.monto_neto, two.monto_impuesto, two.id_vendedor, two.id_cliente) == (0.0, 0.0, 3, 8)
    five = got[5]
    assert (five.numero_factura, five.estado, five.tipo_documento, five.fecha_vencimiento,
            five.id_cliente) == ("X", "posted", "", None, 9)


def test_invoices_missing_relation_is_error(spark):
    df = raw(spark, schemas.RAW_INVOICES, INVOICES).drop("partner_id")
    with pytest.raises(ValueError):
        tf.invoices(df)


# -------------------------------------------------------------- T5 invoice lines

LINES = [
    dict(id=1, move_id='[10, "F"]', product_id='[5, "P"]', quantity=2.0, price_unit=3.0,
         price_subtotal=6.0, discount=None, cost_price=1.0, date="2024-01-05"),
    dict(id=2, move_id='[10, "F"]', product_id='[5, "P"]', price_subtotal=0.0),       # zero total
    dict(id=3, move_id='[10, "F"]', product_id='[6, "P"]', price_subtotal=-4.0),      # refund kept
    dict(id=4, move_id='[10, "F"]', product_id="false", price_subtotal=5.0),          # no product
    dict(id=5, move_id="false", product_id='[6, "P"]', price_subtotal=5.0),           # no invoice
]


def test_invoice_lines(spark):
    df = raw(spark, schemas.RAW_INVOICE_LINES, LINES)
    out = tf.invoice_lines(df)
    assert out.columns == schemas.names(schemas.INVOICE_LINES)
    got = by(out, "id_linea_factura")
    assert sorted(got) == [1, 3]
    assert tuple(got[1]) == (1, 10, 5, 2.0, 1.0, 3.0, 6.0, 0.0, 6.0)
    assert got[3].total == -4.0
    dated = tf.invoice_lines(df, with_date=True)
    assert dated.columns[-1] == "fecha" and by(dated, "id_linea_factura")[1].fecha == dt.date(2024, 1, 5)


def test_invoice_lines_price_total_wins(spark):
    df = raw(spark, schemas.RAW_INVOICE_LINES, LINES[:1])
    from pyspark.sql import functions as F
    out = tf.invoice_lines(df.withColumn("price_total", F.lit(7.14)))
    assert out.collect()[0].total == 7.14


# ------------------------------------------------------------------- T2 orders

def test_orders(spark):
    recs = [
        dict(id=1, name="SO1", create_date="2024-03-02 10:00:00", date_order="2024-03-02 10:00:00",
             amount_total=None, main_exception_id='[3, "Credit limit"]', note_new="nan",
             state="sale", invoice_status="invoiced", partner_id='[7, "C"]',
             user_id="[2, 'V']", partner_shipping_id="false", _seq=1),
        dict(id=2, name=None, create_date="false", main_exception_id="[4]",
             invoice_status=None, partner_id="7", _seq=2),
        dict(id=3, main_exception_id="FALSE", partner_id='[8, "D"]', user_id='[9, "W"]', _seq=3),
    ]
    df = raw(spark, schemas.RAW_ORDERS, recs)
    got = by(tf.orders(df), "id_pedido")
    assert (got[1].referencia_pedido, got[1].fecha_creacion, got[1].total, got[1].excepcion,
            got[1].comentarios, got[1].id_vendedor, got[1].id_direccion_entrega) == \
        ("SO1", dt.date(2024, 3, 2), 0.0, "Credit limit", "", 2, None)
    assert (got[2].referencia_pedido, got[2].fecha_creacion, got[2].excepcion,
            got[2].estado_facturacion, got[2].id_cliente) == ("", None, "4", "", 7)
    assert got[3].excepcion == ""
    assert sorted(r.id_pedido for r in tf.orders(df, vendors=[9]).collect()) == [3]
    assert sorted(r.id_pedido for r in tf.orders(df, vendors=[], clients=[7]).collect()) == [1, 2]


def test_orders_missing_columns_are_skipped(spark):
    df = raw(spark, schemas.RAW_ORDERS, [dict(id=1, partner_id='[7, "C"]', _seq=1)])
    out = tf.orders(df.drop("note_new", "user_id", "main_exception_id"))
    assert "comentarios" not in out.columns
    row = out.collect()[0]
    assert row.id_vendedor is None and row.excepcion == ""


# -------------------------------------------------------------- T3 order lines

def test_order_lines(spark):
    recs = [dict(id=1, order_id='[10, "SO10"]', product_id='[5, "P"]', product_uom_qty=2.0,
                 price_unit=1.5, price_subtotal=3.0, discount=None),
            dict(id=2, order_id='[11, "SO11"]', product_id="false", product_uom_qty=None),
            dict(id=3, order_id="false", product_id='[6, "P"]')]
    df = raw(spark, schemas.RAW_ORDER_LINES, recs)
    out = tf.order_lines(df)
    assert out.columns == schemas.names(schemas.ORDER_LINES)
    assert tuple(by(out, "id_linea")[1]) == (1, 10, None, 5, 2.0, 1.5, 0.0, 3.0)
    orders = spark.createDataFrame([(10,), (12,)], "id long")
    assert [r.id_linea for r in tf.order_lines(df, orders=orders).collect()] == [1]
    assert sorted(r.id_linea for r in tf.order_lines(df, products=[6]).collect()) == [3]


# ------------------------------------------------------------------ T1 clients

CLIENTS = [
    dict(id=1, company_type="person", type="contact", vat="1-9", street="Main 1",
         user_id='[3, "V"]', _seq=1),                                    # dropped: person contact
    dict(id=2, company_type="company", type="invoice", vat="1-9", street="Main  1",
         user_id='[3, "V"]', commercial_company_name="Acme", partner_latitude=1.0000005,
         category_id="[1, 2]", create_date="2024-01-02 08:00:00", _seq=2),
    dict(id=3, company_type="company", type="invoice", vat="1-9", street=" MAIN 1 ",
         user_id='[3, "V"]', _seq=3),                                    # dup of 2 (street case)
    dict(id=4, company_type="company", type="invoice", vat="", street="Elm 2",
         user_id='[3, "V"]', _seq=4),
    dict(id=5, company_type="company", type="invoice", vat="", street="Elm 2",
         user_id='[3, "V"]', _seq=5),                                    # blank rut pair merges
    dict(id=6, company_type="company", type="invoice", vat="9", street="X", user_id="false",
         _seq=6),
    dict(id=7, company_type="company", type="invoice", vat="9", street="X", user_id=None,
         _seq=7),                                                        # null vendor pair merges
    dict(id=8, company_type="company", type="invoice", vat="8", street="Y", user_id='[99, "Z"]',
         property_payment_term_id='[1, "30 days"]', city_id="False", _seq=8),
]


def test_clients(spark):
    df = raw(spark, schemas.RAW_CLIENTS, CLIENTS)
    out = tf.clients(df, tags={1: "VIP", 2: ""})
    assert out.columns == schemas.names(schemas.CLIENTS)
    got = by(out, "id_cliente")
    assert sorted(got) == [2, 4, 6, 8]
    two = got[2]
    assert (two.nombre_cliente, two.etiquetas, two.geo_latitud, two.calle2, two.id_vendedor,
            two.fecha_creacion) == ("Acme", "VIP", 1.0, "", 3, dt.datetime(2024, 1, 2, 8))
    assert (got[8].id_plazo_pago, got[8].comuna, got[8].credito_limite) == ("30 days", "", 0.0)


def test_clients_vendor_filter(spark):
    df = raw(spark, schemas.RAW_CLIENTS, CLIENTS)
    vendors = spark.createDataFrame([(3,)], "id long")
    assert sorted(r.id_cliente for r in tf.clients(df, vendors=vendors).collect()) == [2, 4]
    assert sorted(r.id_cliente for r in tf.clients(df, vendors=[]).collect()) == [2, 4, 6, 8]


def test_clients_tag_table(spark):
    df = raw(spark, schemas.RAW_CLIENTS, CLIENTS)
    tags = spark.createDataFrame([(1, "VIP"), (2, "Net")], "id long, name string")
    assert by(tf.clients(df, tags=tags), "id_cliente")[2].etiquetas == "VIP, Net"


# ----------------------------------------------------------------- T6 products

PRODUCTS = [
    dict(id=11, default_code="A1", name="Widget S", uom_id='[1, "Units"]', list_price=10.0,
         standard_price=4.0, create_date="2024-01-02 09:00:00", taxes_id="[1, 2]",
         categ_id='[5, "Tools"]', sale_ok=True, product_tmpl_id='[100, "Widget"]', _seq=2),
    dict(id=12, default_code="false", name="Widget L", list_price=None, taxes_id="[2, 2]",
         product_tmpl_id='[100, "Widget"]', _seq=1),                     # first variant of 100
    dict(id=13, name="Other", taxes_id="[1]", product_tmpl_id='[200, "Other"]', _seq=3),
    dict(id=14, name="Archived", taxes_id="[]", product_tmpl_id='[300, "Arch"]', active=False,
         _seq=4),
    dict(id=15, name="No taxes", taxes_id="[9]", product_tmpl_id='[300, "Arch"]', _seq=5),
]


def test_products(spark):
    df = raw(spark, schemas.RAW_PRODUCTS, PRODUCTS)
    master = spark.createDataFrame([(100,), (300,), (400,), (None,), (100,)], "id_producto long")
    from ledgerspark.sources import master_product_ids
    out = tf.products(df, master_product_ids(master))
    assert out.columns == schemas.names(schemas.PRODUCTS)
    got = by(out, "id_producto_padre")
    assert sorted(got) == [100, 300, 400]
    assert tuple(got[100]) == (12, 100, "", "Widget L", None, 0.0, 0.0, None, False, None)
    assert got[300].id_producto_variante == 14
    assert tuple(got[400]) == (400, 400, "", None, None, 0.0, 0.0, None, False, None)


def test_product_taxes(spark):
    df = raw(spark, schemas.RAW_PRODUCTS, PRODUCTS)
    master = spark.createDataFrame([(100,), (300,)], "id_producto long")
    taxes = spark.createDataFrame([(1,), (2,)], "id_impuestos long")
    got = sorted(tuple(r) for r in tf.product_taxes(df, master, taxes).collect())
    # all variants of master parents, duplicates kept, tax 9 not allowed
    assert got == [(11, 1), (11, 2), (12, 2), (12, 2)]
    empty = spark.createDataFrame([], "id_impuestos long")
    assert tf.product_taxes(df, master, empty).count() == 0
    assert tf.product_taxes(df, master, []).count() == 0

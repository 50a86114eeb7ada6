"""The query catalogue: one entry per operator family, run on the test tables.

Each query lands raw ERP records from the driver tables (``landing``), runs
the library on them and returns the result DataFrame. Column names match the
DuckDB oracle in ``oracle.py`` exactly.
"""

from __future__ import annotations

import tempfile
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ledgerspark import schemas
from ledgerspark.catalog import landing as L
from ledgerspark.functions import (amount, clean_markers, clean_strip, exception_label,
                                   id_text, iso_datetime, list_length, m2m_names, m2o_id,
                                   m2o_name, parse_date, round_half_even, street_key,
                                   strip_doc_code, to_id)
from ledgerspark.functions.common import then, with_columns_once
from ledgerspark.functions.rejects import load_with_rejects, read_rejects
from ledgerspark.functions.periods import month_start, previous_month
from ledgerspark.operators import (carry_over, day_count, discarded_invoiced, frequency,
                                   tag_names_from_table, top_n)
from ledgerspark.operators.counts import month_guard
from ledgerspark.plans import incremental, jobs, transforms as tf
from ledgerspark.sinks import (load, raw_rows, replace_months, sheet_rows, upload_grid, upload_sheet,
                               with_month)
from ledgerspark.sinks.snapshots import Snapshots
from ledgerspark.sources.probes import day_exists
from ledgerspark.sources import (clients_raw, invoice_lines_raw, invoices_raw, master_product_ids,
                                 order_lines_raw, orders_raw, products_raw, read_landed, tax_ids,
                                 taxes_raw,
                                 vendor_ids, visit_listing, visits_of_day)

# Fixed parameters of the catalogue (the test data spans 1995-01 .. 2001-11).
ASOF = "1998-07-15"
START = "1992-01-01"
BACKFILL_START = "1996-01-01"
BACKFILL_STOP = "1996-07-10"
VISIT_DAY = "2024-01-15"

Query = Callable[[SparkSession, str], DataFrame]


def _orders(spark, d):
    return L.table(spark, d, "orders")


# ------------------------------------------------------------ scalar operators

def q_m2o_id(spark, d):
    """X1 over eight relation encodings."""
    o = _orders(spark, d)
    rel = F.expr("""CASE pmod(o_orderkey, 10)
        WHEN 8 THEN concat('[', o_custkey, ', ["x"]]')
        WHEN 9 THEN concat('[', o_custkey, ', {"a": 1}]')
        WHEN 0 THEN concat('[', o_custkey, ', "Customer ', o_custkey, '"]')
        WHEN 1 THEN concat('[', o_custkey, ", 'Customer']")
        WHEN 2 THEN 'false'
        WHEN 3 THEN CAST(o_custkey AS STRING)
        WHEN 4 THEN concat('[', o_custkey, ']')
        WHEN 5 THEN concat(' [', o_custkey, ', "x"]')
        WHEN 6 THEN concat(o_custkey, '.7')
        ELSE '[]' END""")
    df = o.select(F.col("o_orderkey").alias("id"), rel.alias("rel"))
    return with_columns_once(df, {"id_cliente": m2o_id("rel")}).drop("rel")


def q_m2o_id_scalar(spark, d):
    """The clients' variant accepts a bare number column."""
    o = _orders(spark, d)
    return o.select(F.col("o_orderkey").alias("id"),
                    m2o_id(F.col("o_custkey"), o.schema["o_custkey"].dataType,
                           allow_scalar=True).alias("id_vendedor"),
                    m2o_id(F.col("o_custkey"), o.schema["o_custkey"].dataType).alias("id_cliente"))


def q_m2o_name(spark, d):
    """X3 over eight encodings (repr lists, None, no strip, bare text)."""
    o = _orders(spark, d)
    rel = F.expr("""CASE pmod(o_orderkey, 9)
        WHEN 8 THEN concat('[', o_custkey, ", '", o_orderpriority, "', ['x']]")
        WHEN 0 THEN concat('[', o_custkey, ', "', o_orderpriority, '"]')
        WHEN 1 THEN concat('[', o_custkey, ", '", o_orderpriority, "']")
        WHEN 2 THEN 'false'
        WHEN 3 THEN concat('[', o_custkey, ']')
        WHEN 4 THEN concat(' [', o_custkey, ', "x"]')
        WHEN 5 THEN concat('[', o_custkey, ', None]')
        WHEN 6 THEN concat('[', o_custkey, ', null]')
        ELSE CAST(o_custkey AS STRING) END""")
    df = o.select(F.col("o_orderkey").alias("id"), rel.alias("rel"))
    return with_columns_once(df, {"nombre": m2o_name("rel")}).drop("rel")


def q_m2m_names(spark, d):
    """Names of [id, name] pairs joined by ','."""
    p = L.table(spark, d, "part")
    rel = F.expr("""CASE pmod(p_partkey, 6)
        WHEN 4 THEN concat('[[', p_size, ", '", p_brand, "'], ", p_size, ']')
        WHEN 5 THEN concat('[[', p_size, ", '", p_brand, "'], [", p_partkey, ', None]]')
        WHEN 0 THEN concat('[[', p_size, ', "', p_brand, '"], [', p_partkey, ', "', p_type, '"]]')
        WHEN 1 THEN concat('[[', p_size, ", '", p_brand, "']]")
        WHEN 2 THEN '[]'
        ELSE concat('[', p_size, ', ', p_partkey, ']') END""")
    return p.select(F.col("p_partkey").alias("id"), m2m_names(rel).alias("nombres"))


def q_tag_map(spark, d):
    """X8 with a tag table (nation names; one id comes twice); every seventh list holds a stray word."""
    raw = clients_raw(L.partners(spark, d))
    raw = raw.withColumn("category_id", F.expr(
        "CASE WHEN pmod(id, 7) = 0 THEN replace(category_id, ', ', \", 'x', \") ELSE category_id END"))
    tags = L.tags(spark, d)
    tags = tags.unionByName(tags.where("id = 3").select("id", F.lit("AAA").alias("name")))
    out = tag_names_from_table(raw, "category_id", tags, "etiquetas")
    return out.select(F.col("id"), "etiquetas")


def q_exception_label(spark, d):
    """X7 then text cleaning A, as in the order transform."""
    raw = L.sale_orders(spark, d)
    label = then(exception_label("main_exception_id"), clean_markers)
    return with_columns_once(raw.select("id", "main_exception_id"), {"excepcion": label}).drop("main_exception_id")


def q_num_default(spark, d):
    """X10 (text amounts with junk -> 0) and X11 (ids: whole numbers only)."""
    o = _orders(spark, d)
    txt = F.expr("""CASE pmod(o_orderkey, 8)
        WHEN 0 THEN CAST(o_totalprice AS STRING)
        WHEN 1 THEN NULL
        WHEN 2 THEN 'abc'
        WHEN 3 THEN '1d'
        WHEN 4 THEN concat(' ', CAST(o_totalprice AS STRING), ' ')
        WHEN 5 THEN 'NaN'
        WHEN 6 THEN concat('+', CAST(o_totalprice AS STRING))
        ELSE '' END""")
    idt = F.expr("""CASE pmod(o_orderkey, 4)
        WHEN 0 THEN CAST(o_custkey AS STRING)
        WHEN 1 THEN concat(o_custkey, '.0')
        WHEN 2 THEN concat(o_custkey, '.5')
        ELSE 'abc' END""")
    return o.select(F.col("o_orderkey").alias("id"), amount(txt).alias("monto"),
                    to_id(idt).alias("id_cliente"))


def q_date_parse(spark, d):
    """Loose date text -> DATE; markers, year-only and junk -> null."""
    o = _orders(spark, d)
    txt = F.expr("""CASE pmod(o_orderkey, 8)
        WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')
        WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd 10:00:00')
        WHEN 2 THEN 'false'
        WHEN 3 THEN NULL
        WHEN 4 THEN 'x'
        WHEN 5 THEN date_format(o_orderdate, 'yyyy')
        WHEN 6 THEN date_format(o_orderdate, "yyyy-MM-dd'T'10:00:00")
        ELSE concat(' ', date_format(o_orderdate, 'yyyy-MM-dd'), ' ') END""")
    df = o.select(F.col("o_orderkey").alias("id"), txt.alias("txt"))
    return with_columns_once(df, {"fecha": parse_date("txt")}).drop("txt")


def q_iso_date(spark, d):
    """Datetime text -> ISO-8601 (microseconds only when non-zero)."""
    ev = L.table(spark, d, "events")
    txt = F.expr("""CASE pmod(event_id, 4)
        WHEN 0 THEN CAST(ts AS STRING)
        WHEN 1 THEN 'None'
        WHEN 2 THEN date_format(ts, 'yyyy-MM-dd')
        ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") END""")
    return ev.select(F.col("event_id").alias("id"), iso_datetime(txt).alias("iso"))


def q_id_to_string(spark, d):
    """Numeric ids as text without the decimal part."""
    c = L.table(spark, d, "customer")
    v = F.expr("""CASE WHEN pmod(c_custkey, 9) = 0 THEN CAST('NaN' AS DOUBLE)
        WHEN pmod(c_custkey, 9) = 1 THEN CAST(NULL AS DOUBLE)
        ELSE CAST(c_custkey AS DOUBLE) END""")
    return c.select(F.col("c_custkey").alias("id"), id_text(v, T.DoubleType()).alias("id_texto"))


def _segment_variants(kind: str):
    if kind == "a":
        return F.expr("""CASE pmod(c_custkey, 8)
            WHEN 0 THEN c_mktsegment WHEN 1 THEN 'None' WHEN 2 THEN 'False' WHEN 3 THEN 'nan'
            WHEN 4 THEN '<NA>' WHEN 5 THEN NULL WHEN 6 THEN concat(' ', c_mktsegment, ' ')
            ELSE 'True' END""")
    return F.expr("""CASE pmod(c_custkey, 8)
        WHEN 0 THEN c_mktsegment WHEN 1 THEN concat(' ', c_mktsegment, '\\t')
        WHEN 2 THEN concat('\\n', c_mktsegment) WHEN 3 THEN 'false' WHEN 4 THEN NULL
        WHEN 5 THEN concat(char(160), c_mktsegment, char(160)) WHEN 6 THEN 'None'
        ELSE concat('  ', c_mktsegment, '  ') END""")


def q_clean_text_a(spark, d):
    c = L.table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), clean_markers(_segment_variants("a")).alias("texto"))


def q_clean_text_b(spark, d):
    c = L.table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("id"), clean_strip(_segment_variants("b")).alias("texto"))


def q_doc_type(spark, d):
    """Leading '(code)' removed from document type names."""
    p = L.table(spark, d, "part")
    txt = F.expr("""CASE pmod(p_partkey, 6)
        WHEN 0 THEN concat('(', p_size, ') ', p_type)
        WHEN 1 THEN concat(p_type, ' (', p_size, ')')
        WHEN 2 THEN concat('(AB) ', p_type)
        WHEN 3 THEN NULL
        WHEN 4 THEN concat('(', p_size, ')', p_type)
        ELSE concat('(', p_size, ')   ', p_type) END""")
    return p.select(F.col("p_partkey").alias("id"), strip_doc_code(txt).alias("tipo_documento"))


def q_street_key(spark, d):
    """Street dedup key."""
    c = L.table(spark, d, "customer")
    street = F.expr("concat('  ', upper(c_name), ' \\t  ', c_nationkey, '\\n')")
    return c.select(F.col("c_custkey").alias("id"), street_key(street).alias("calle_key"))


def q_coord_round(spark, d):
    """Half-even rounding to 6 decimals."""
    s = L.table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("id"),
                    round_half_even(F.col("s_acctbal") / 7, 6).alias("geo"))


def q_list_length(spark, d):
    """Length of the tax list of each invoice line (0 when not a list)."""
    raw = L.move_lines(spark, d)
    return with_columns_once(raw.select("id", "tax_ids"), {"n_taxes": list_length("tax_ids")}).drop("tax_ids")


# ------------------------------------------------------------------- invoices

def q_invoices(spark, d):
    """S7 + T4: posted invoice headers, keep-first per invoice id."""
    return tf.invoices(invoices_raw(L.moves(spark, d), start=START))


def q_invoices_current_month(spark, d):
    """K8 rows."""
    return jobs.current_month_invoices_plan(L.moves(spark, d), ASOF)


def q_invoices_month_close(spark, d):
    """K6 rows."""
    return jobs.closed_month_invoices_plan(L.moves(spark, d), ASOF)


def q_month_exists(spark, d):
    """A1: rows of the invoice history dated on the first day of last month."""
    hist = tf.invoices(invoices_raw(L.moves(spark, d), start=START))
    return day_count(hist, "fecha_factura", previous_month(ASOF).first)


def q_month_guard(spark, d):
    """A1 for every month of the history at once (grouped, partial aggregation)."""
    hist = tf.invoices(invoices_raw(L.moves(spark, d), start=START))
    return month_guard(hist, "fecha_factura")


def q_invoice_lines(spark, d):
    """S8 + T5: product lines of posted invoices, non-zero totals."""
    return jobs.invoice_lines_plan(L.move_lines(spark, d), L.moves(spark, d), START)


def q_invoice_lines_current_month(spark, d):
    return jobs.invoice_lines_plan(L.move_lines(spark, d), L.moves(spark, d), month_start(ASOF))


def q_invoice_lines_month_close(spark, d):
    """K7 rows: lines of last month (line date), for the line history."""
    pm = previous_month(ASOF)
    return jobs.invoice_lines_plan(L.move_lines(spark, d), L.moves(spark, d), pm.first, pm.last)


def q_backfill_by_month(spark, d):
    """K9 headers: one pass with the month partition column."""
    return with_month(jobs.backfill_invoices_plan(L.moves(spark, d), ASOF, BACKFILL_START),
                      "fecha_factura")


def q_backfill_lines_by_month(spark, d):
    """K9 lines: month from the line date, date column then dropped."""
    df = jobs.backfill_invoice_lines_plan(L.move_lines(spark, d), L.moves(spark, d), ASOF,
                                          BACKFILL_START)
    return with_month(df, "fecha").drop("fecha")


def q_sheet_rows(spark, d):
    """Current-month invoices flattened to text cells (Q7)."""
    return sheet_rows(jobs.invoices_sheet_plan(L.moves(spark, d), ASOF, start=START))


def q_invoice_lines_sheet(spark, d):
    """Q8 cells: lines of the current month, text only."""
    return sheet_rows(jobs.invoice_lines_sheet_plan(L.move_lines(spark, d), L.moves(spark, d),
                                                    ASOF, start=START))


def q_top_ids(spark, d):
    """O1: the 100 newest invoice lines by id (ties broken by the other columns)."""
    raw = invoice_lines_raw(L.move_lines(spark, d), L.moves(spark, d), start=START)
    cols = ["id", "move_id", "tax_ids", "price_unit", "price_subtotal"]
    return top_n(raw.select(*cols), 100, [F.col(c).desc() for c in
                                          ["id", "price_subtotal", "price_unit", "move_id", "tax_ids"]])


def q_tax_array_profile(spark, d):
    """Q11: value counts of the tax-list length over the top-100 sample."""
    return frequency(q_top_ids(spark, d), list_length("tax_ids"), "n_taxes")


# --------------------------------------------------------------------- orders

def q_orders(spark, d):
    """S3 + T2: sale orders of the two-month window."""
    return tf.orders(orders_raw(L.sale_orders(spark, d), ASOF))


def q_orders_carryover(spark, d):
    """Q3 rows: T2 + P6."""
    return jobs.orders_carryover_plan(L.sale_orders(spark, d), ASOF)


def q_metrics_discarded(spark, d):
    """The order job's counters as one row."""
    df = tf.orders(orders_raw(L.sale_orders(spark, d), ASOF))
    return df.agg(
        F.count_if(discarded_invoiced("fecha_creacion", "estado_facturacion", ASOF))
        .alias("descartados_facturados"),
        F.count_if(carry_over("fecha_creacion", "estado_facturacion", ASOF)).alias("cargados"),
        F.count(F.lit(1)).alias("leidos"))


def q_order_lines(spark, d):
    """S4 + T3 without membership lists."""
    return tf.order_lines(order_lines_raw(L.sale_order_lines(spark, d), ASOF))


def q_order_lines_carryover(spark, d):
    """Q4 rows: P7 ids semi-joined into T3."""
    return jobs.order_lines_carryover_plan(L.sale_orders(spark, d), L.sale_order_lines(spark, d),
                                           ASOF)


# -------------------------------------------------------------------- clients

def q_clients_dedup(spark, d):
    """S2 + T1: contacts dropped, keep-first on (rut, street key, vendor)."""
    return tf.clients(clients_raw(L.partners(spark, d)), tags=L.tags(spark, d))


def q_clients_vendor_filter(spark, d):
    """T1 + J2: clients whose vendor is in the vendor lookup."""
    return tf.clients(clients_raw(L.partners(spark, d)), tags={},
                      vendors=vendor_ids(L.vendors(spark, d)))


# ------------------------------------------------------------------- products

def q_products_master(spark, d):
    """S5 + S11 + T6: one row per master id, first variant attached."""
    return tf.products(products_raw(L.products(spark, d)),
                       master_product_ids(L.product_master(spark, d)))


def q_product_taxes(spark, d):
    """T6 bridge: all variants of master templates x allowed taxes."""
    return tf.product_taxes(products_raw(L.products(spark, d)),
                            master_product_ids(L.product_master(spark, d)),
                            tax_ids(L.allowed_taxes(spark, d)))


def q_products_sheet(spark, d):
    """K5 cells: product table as raw text (nulls -> "")."""
    return raw_rows(q_products_master(spark, d))


def q_taxes_extract(spark, d):
    """All taxes."""
    return taxes_raw(L.taxes(spark, d)).select("id", "name", "amount")


def q_taxes_limited(spark, d):
    """O2: an extract limit that cuts rows, the first 40 in source order."""
    return taxes_raw(L.taxes(spark, d), limit=40).select("id", "name", "amount")


# ------------------------------------------------- optional lists, missing columns

def q_orders_members(spark, d):
    """Orders of listed vendors and listed clients."""
    clients = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("id_cliente"))
    return tf.orders(orders_raw(L.sale_orders(spark, d), ASOF),
                     vendors=vendor_ids(L.vendors(spark, d)), clients=clients)


def q_orders_missing_columns(spark, d):
    """Target columns whose source is missing are left out."""
    return tf.orders(orders_raw(L.sale_orders(spark, d), ASOF).drop("note_new", "amount_tax"))


def q_invoice_lines_price_total(spark, d):
    """X23 with a price_total column."""
    lines = L.move_lines(spark, d).withColumn("price_total", F.expr("price_subtotal * CAST(2 AS DOUBLE)"))
    return jobs.invoice_lines_plan(lines, L.moves(spark, d), START)


def q_tax_array_profile_all(spark, d):
    """A6 over all lines instead of the sample."""
    return jobs.tax_array_profile(L.move_lines(spark, d), L.moves(spark, d), None, START)


# ---------------------------------------------------- written tables, read back

def _target(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; a local session without one uses its own temporary folder."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="ledgerspark-catalog-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_landed_json(spark, d):
    """JSON lines with false in empty fields, numbers and relations alike, through T2."""
    path = _target(spark, "orders-json")
    line = F.expr("""concat('{"id": ', o_orderkey, ', "_seq": ', o_orderkey,
        ', "name": ', CASE WHEN pmod(o_orderkey, 5) = 0 THEN 'false' ELSE concat('"SO', o_orderkey, '"') END,
        ', "create_date": ', CASE WHEN pmod(o_orderkey, 7) = 0 THEN 'false'
                                  ELSE concat('"', date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss'), '"') END,
        ', "amount_total": ', CASE WHEN pmod(o_orderkey, 3) = 0 THEN 'false' ELSE CAST(o_totalprice AS STRING) END,
        ', "partner_id": ', CASE WHEN pmod(o_orderkey, 4) = 0 THEN 'false'
                                 ELSE concat('[', o_custkey, ', "Customer"]') END,
        ', "user_id": false, "unknown": 1}')""")
    spark.read.parquet(f"{d}/orders.parquet").select(line.alias("value")).write.text(path)
    df = tf.orders(read_landed(spark, path, schemas.RAW_ORDERS, fmt="json"))
    return df.select("id_pedido", "referencia_pedido", "fecha_creacion", "total", "id_cliente", "id_vendedor")


def q_truncate_load(spark, d):
    """K1: a load replaces what another one left, an empty one leaves it; read back."""
    path = _target(spark, "orders-load")
    df = tf.orders(orders_raw(L.sale_orders(spark, d), ASOF))
    load(df.where("id_vendedor < 5"), path)
    load(df, path)
    load(df.where("false"), path)
    return spark.read.parquet(path)


def q_append_load(spark, d):
    """K2: two appends that make up the whole; read back."""
    path = _target(spark, "orders-append")
    for part in _halves(tf.orders(orders_raw(L.sale_orders(spark, d), ASOF))):
        load(part, path, mode="append")
    return spark.read.parquet(path)


def _halves(orders: DataFrame) -> list[DataFrame]:
    """The orders in two parts: sellers below 5, and all others."""
    first = F.coalesce(F.col("id_vendedor") < 5, F.lit(False))
    return [orders.where(first), orders.where(~first)]


def _store(spark: SparkSession, name: str) -> Snapshots:
    return Snapshots(spark, _target(spark, name))


def q_snapshot_load(spark, d):
    """K1 on a snapshot store: what each version holds; the third load is empty and publishes nothing."""
    store = _store(spark, "orders-snapshots")
    df = tf.orders(orders_raw(L.sale_orders(spark, d), ASOF))
    for rows in (_halves(df)[0], df, df.where("false")):
        load(rows, store.at("orders"))
    versions = [store.table("orders", v).withColumn("version", F.lit(v)) for v in store.versions()]
    return versions[0].unionByName(versions[1]) if len(versions) == 2 else versions[-1]


def q_append_once(spark, d):
    """K2 by months, exactly once: two batches, each tried twice; read back."""
    target = _store(spark, "orders-once").at("orders")
    df = with_month(tf.orders(orders_raw(L.sale_orders(spark, d), ASOF)), "fecha_creacion")
    for batch, part in enumerate(_halves(df)):
        for _ in range(2):
            load(part, target, mode="append", partition_by=["mes"], batch=("daily", batch))
    return target.read()


def _landings(raw: DataFrame, key: str, n: int = 3) -> list[DataFrame]:
    """Raw records as ``n`` landings, which are not in source order."""
    return [raw.where(F.pmod(F.col(key), F.lit(n)) == (2 * k + 1) % n) for k in range(n)]


def q_clients_increments(spark, d):
    """A3 merged from three landings, one of them twice; the vendor list is applied on reading."""
    store = _store(spark, "clients-state")
    for batch, landed in enumerate(_landings(L.partners(spark, d), "id")):
        for _ in range(1 + batch % 2):
            incremental.add_clients(store, landed, batch=("clients", batch), buckets=8)
    return incremental.clients(store, L.vendors(spark, d))


def q_invoices_increments(spark, d):
    """A4 merged from three landings."""
    store = _store(spark, "invoices-state")
    for landed in _landings(L.moves(spark, d), "_seq"):
        incremental.add_invoices(store, landed, start=START, buckets=8)
    return incremental.invoices(store)


def q_products_increments(spark, d):
    """A5 merged from three landings, then T6."""
    store = _store(spark, "products-state")
    for landed in _landings(L.products(spark, d), "id"):
        incremental.add_products(store, landed, buckets=8)
    return incremental.products(store, master_product_ids(L.product_master(spark, d)))


def _written(raw: DataFrame, column: str) -> DataFrame:
    return raw.withColumn("write_date", F.coalesce(F.nullif(F.col(column), F.lit("false")), F.col("date_order")))


def q_orders_mirror(spark, d):
    """S3 as a mirror: a first extract, then records written since: changed ones, and late ones that the first missed."""
    store = _store(spark, "orders-mirror")
    raw = _written(L.sale_orders(spark, d), "create_date")
    incremental.mirror_orders(store, raw.where("pmod(id, 4) <> 1"))
    changed, late = F.expr("pmod(id, 3) = 0"), F.expr("pmod(id, 4) = 1")
    later = raw.withColumns({
        "invoice_status": F.when(changed, "changed").otherwise(F.col("invoice_status")),
        "amount_untaxed": F.when(changed, F.col("amount_untaxed") * 2).otherwise(F.col("amount_untaxed")),
        "write_date": F.when(changed | late, "2099-01-01 00:00:00").otherwise(F.col("write_date"))})
    for _ in range(2):
        incremental.mirror_orders(store, later)
    return incremental.mirrored_orders(store, ASOF)


def _history(store: Snapshots) -> DataFrame:
    """Headers and lines of a store's histories as one list."""
    heads = store.table(incremental.HEAD_HISTORY).select(F.lit("factura").alias("tabla"), F.col("id_factura").alias("id"),
                                                         F.col("total_factura").alias("total"), "mes")
    lines = store.table(incremental.LINE_HISTORY).select(F.lit("linea").alias("tabla"), F.col("id_linea_factura").alias("id"), "total", "mes")
    return heads.unionByName(lines)


def q_close_unit(spark, d):
    """K6 + K7: the closed month of both tables from one version, closed twice."""
    store = _store(spark, "close")
    for _ in range(2):
        incremental.close_month(store, L.moves(spark, d), L.move_lines(spark, d), ASOF)
    return _history(store)


def q_backfill_resumed(spark, d):
    """K9 / Q10: a backfill up to an earlier day, then one that computes only what is missing."""
    store = _store(spark, "backfill")
    for asof in (BACKFILL_STOP, ASOF):
        incremental.resume_backfill(store, L.moves(spark, d), L.move_lines(spark, d), asof, BACKFILL_START)
    return _history(store)


def q_schema_load(spark, d):
    """K1 + K3: the product table loaded with its declared schema; read back."""
    path = _target(spark, "products-load")
    load(q_products_master(spark, d), path, schema=schemas.PRODUCTS)
    return spark.read.schema(schemas.PRODUCTS).parquet(path)


def q_history_load(spark, d):
    """K9 then K6 (twice): the backfilled header history with last month closed again; read back."""
    path = _target(spark, "invoices-history")
    moves = L.moves(spark, d)
    replace_months(jobs.backfill_invoices_plan(moves, ASOF, BACKFILL_START), path, "fecha_factura")
    for _ in range(2):
        replace_months(jobs.closed_month_invoices_plan(moves, ASOF), path, "fecha_factura")
    return spark.read.parquet(path)


def q_line_history_load(spark, d):
    """K9 then K7: the backfilled line history with last month closed again; read back."""
    path = _target(spark, "lines-history")
    lines, moves, pm = L.move_lines(spark, d), L.moves(spark, d), previous_month(ASOF)
    replace_months(jobs.backfill_invoice_lines_plan(lines, moves, ASOF, BACKFILL_START), path, "fecha", drop_date=True)
    closed = jobs.invoice_lines_plan(lines, moves, pm.first, pm.last, with_date=True)
    replace_months(closed, path, "fecha", drop_date=True)
    return spark.read.parquet(path)


def q_sheet_upload(spark, d):
    """K4: a sheet written as CSV, amounts above ten million and below a thousandth in plain decimals; read back."""
    path = _target(spark, "sheet")
    o = spark.read.parquet(f"{d}/orders.parquet")
    upload_sheet(o.select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("fecha"),
                          F.expr("round(o_totalprice) * 1000").alias("grande"),
                          F.expr("-pmod(o_orderkey, 10) / CAST(4096 AS DOUBLE)").alias("chico")), path)
    names = ["id", "fecha", "grande", "chico"]
    df = spark.read.option("header", True).schema(", ".join(f"{c} string" for c in names)).csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in names])


def _numbered(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The lines of a grid's parts in turn, numbered from 0 (the header)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    lines = (spark.read.schema(schema).csv(path, quote='"', escape='"')
             .select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_at")))
    files = lines.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))  # a row a part
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.join(files.select("_file", before.alias("_before")), "_file")
    n = F.col("_before") + F.row_number().over(Window.partitionBy("_file").orderBy("_at")) - 1
    return lines.select(n.cast("long").alias("n"), *[F.coalesce(c, F.lit("")).alias(c) for c in names])


def q_sheet_grid(spark, d):
    """K4 / Q7: the invoices' tab as one grid: header, then rows in source order; read back."""
    path = _target(spark, "grid")
    plan = jobs.invoices_sheet_plan(L.moves(spark, d), ASOF, start=START, keep_seq=True)
    upload_grid(plan, path, ["_seq"])
    return _numbered(spark, path, [c for c in plan.columns if c != "_seq"])


def q_products_grid(spark, d):
    """K5 / Q9: the products' upload, values raw, by master id; read back."""
    path = _target(spark, "products-grid")
    plan = q_products_master(spark, d)
    upload_grid(plan, path, ["id_producto_padre"], formatted=False)
    return _numbered(spark, path, plan.columns)


def q_day_probe(spark, d):
    """A1 for the first and 15th day of three months of a closed history, decided by parts, footers or rows."""
    target = _store(spark, "probe").at("invoices")
    replace_months(tf.invoices(invoices_raw(L.moves(spark, d), start=START)), target, "fecha_factura")
    days = ["1996-01-01", "1997-06-15", "1998-06-01", "1998-06-15", "2050-01-01"]
    found = [(day, day_exists(target, "fecha_factura", day)["existe"]) for day in days]
    return spark.createDataFrame(found, "dia string, existe boolean")


def _soiled(raw: DataFrame) -> DataFrame:
    """Orders whose numbers and dates are text, some of it unreadable."""
    return raw.withColumns({
        "amount_untaxed": F.expr("CASE pmod(id, 13) WHEN 0 THEN 'n/a' WHEN 1 THEN 'false' ELSE CAST(amount_untaxed AS STRING) END"),
        "amount_tax": F.expr("CASE WHEN pmod(id, 17) = 0 THEN concat(id, ' pesos') ELSE CAST(amount_tax AS STRING) END"),
        "create_date": F.expr("CASE WHEN pmod(id, 11) = 0 THEN '31/12/1997' ELSE create_date END")})


def q_rejects(spark, d):
    """X10-X12 with an error channel: the values that T2's casts cannot read, loaded with the orders in one write."""
    target = _store(spark, "rejects").at("orders")
    df = tf.orders(orders_raw(_soiled(L.sale_orders(spark, d)), ASOF), with_rejects=True)
    load_with_rejects(target.store.begin(), "orders", df, "id_pedido").commit()
    return read_rejects(target)


def q_orders_beside_rejects(spark, d):
    """The orders that were loaded with their rejects: 0 and null where the casts failed, as without."""
    target = _store(spark, "rejects").at("orders")
    df = tf.orders(orders_raw(_soiled(L.sale_orders(spark, d)), ASOF), with_rejects=True)
    load_with_rejects(target.store.begin(), "orders", df, "id_pedido").commit()
    return target.read()


# --------------------------------------------------------------------- visits

def q_visits_of_day(spark, d):
    """S12 + X26: visits planned on one day, listing columns."""
    return visit_listing(visits_of_day(L.visit_payloads(spark, d), VISIT_DAY))


QUERIES: dict[str, Query] = {
    "m2o_id": q_m2o_id,
    "m2o_id_scalar": q_m2o_id_scalar,
    "m2o_name": q_m2o_name,
    "m2m_names": q_m2m_names,
    "tag_map": q_tag_map,
    "exception_label": q_exception_label,
    "num_default": q_num_default,
    "date_parse": q_date_parse,
    "iso_date": q_iso_date,
    "id_to_string": q_id_to_string,
    "clean_text_a": q_clean_text_a,
    "clean_text_b": q_clean_text_b,
    "doc_type": q_doc_type,
    "street_key": q_street_key,
    "coord_round": q_coord_round,
    "list_length": q_list_length,
    "invoices": q_invoices,
    "invoices_current_month": q_invoices_current_month,
    "invoices_month_close": q_invoices_month_close,
    "month_exists": q_month_exists,
    "month_guard": q_month_guard,
    "invoice_lines": q_invoice_lines,
    "invoice_lines_current_month": q_invoice_lines_current_month,
    "invoice_lines_month_close": q_invoice_lines_month_close,
    "backfill_by_month": q_backfill_by_month,
    "backfill_lines_by_month": q_backfill_lines_by_month,
    "sheet_rows": q_sheet_rows,
    "invoice_lines_sheet": q_invoice_lines_sheet,
    "top_ids": q_top_ids,
    "tax_array_profile": q_tax_array_profile,
    "orders": q_orders,
    "orders_carryover": q_orders_carryover,
    "metrics_discarded": q_metrics_discarded,
    "order_lines": q_order_lines,
    "order_lines_carryover": q_order_lines_carryover,
    "clients_dedup": q_clients_dedup,
    "clients_vendor_filter": q_clients_vendor_filter,
    "products_master": q_products_master,
    "product_taxes": q_product_taxes,
    "products_sheet": q_products_sheet,
    "taxes_extract": q_taxes_extract,
    "taxes_limited": q_taxes_limited,
    "orders_members": q_orders_members,
    "orders_missing_columns": q_orders_missing_columns,
    "invoice_lines_price_total": q_invoice_lines_price_total,
    "tax_array_profile_all": q_tax_array_profile_all,
    "landed_json": q_landed_json,
    "truncate_load": q_truncate_load,
    "append_load": q_append_load,
    "schema_load": q_schema_load,
    "history_load": q_history_load,
    "line_history_load": q_line_history_load,
    "sheet_upload": q_sheet_upload,
    "snapshot_load": q_snapshot_load,
    "append_once": q_append_once,
    "clients_increments": q_clients_increments,
    "invoices_increments": q_invoices_increments,
    "products_increments": q_products_increments,
    "orders_mirror": q_orders_mirror,
    "close_unit": q_close_unit,
    "backfill_resumed": q_backfill_resumed,
    "sheet_grid": q_sheet_grid,
    "products_grid": q_products_grid,
    "day_probe": q_day_probe,
    "rejects": q_rejects,
    "orders_beside_rejects": q_orders_beside_rejects,
    "visits_of_day": q_visits_of_day,
}

"""DuckDB oracle SQL for the query catalogue.

Each statement computes, from the *typed* test tables, the values the
library must derive from the raw ERP-shaped records built by ``landing``.
Where the raw record carries a dirty variant (chosen by ``key % n``), the SQL
states the expected outcome of that variant directly. Every computed column
is aliased to the name the Spark query produces.
"""

from __future__ import annotations

from ledgerspark.catalog.queries import ASOF, BACKFILL_START, START, VISIT_DAY
from ledgerspark.functions.periods import minus_months, month_start, previous_month
from ledgerspark.functions.text import VISIT_ICON_FAILED, VISIT_ICON_OTHER, VISIT_ICON_SUCCESS

_M0 = month_start(ASOF).isoformat()
_PM = previous_month(ASOF)
_M1, _M1_LAST = _PM.first.isoformat(), _PM.last.isoformat()
_WINDOW = minus_months(ASOF, 2).isoformat()
_BACKFILL_LAST = _M1_LAST
DBL0 = "CAST(0 AS DOUBLE)"


# ----------------------------------------------------------------- invoices

_FIRST_OF_ID = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_factura ORDER BY k) AS rn FROM src)
  WHERE rn = 1"""

#: The backfill's month loop: for each month, everything from its first day on, the first row of an id, stored
#: if it is of the month.
_FIRST_OF_MONTHS = """SELECT * EXCLUDE (rn, m) FROM (
    SELECT src.*, m, row_number() OVER (PARTITION BY m, id_factura ORDER BY k) AS rn
    FROM (SELECT DISTINCT date_trunc('month', d) AS m FROM src) AS months JOIN src ON src.d >= m)
  WHERE rn = 1 AND date_trunc('month', d) = m"""


def _invoices(start: str, where: str = "TRUE", firsts: str = _FIRST_OF_ID) -> str:
    """Posted invoice headers (T4) from ``start``; ``where`` filters the result."""
    return f"""
WITH mv AS (
  SELECT o_orderkey AS k, o_orderkey // 2 AS id_factura, o_custkey, o_orderstatus, o_totalprice,
         o_orderpriority, CAST(o_orderdate AS DATE) AS d,
         CASE WHEN o_orderkey % 17 = 0 THEN 'in_invoice'
              WHEN o_totalprice > 450000 THEN 'out_refund' ELSE 'out_invoice' END AS move_type
  FROM orders),
src AS (
  SELECT * FROM mv
  WHERE move_type IN ('out_invoice', 'out_refund') AND o_orderstatus = 'F'
    AND d >= DATE '{start}' AND k % 10 <> 7),
firsts AS (
  {firsts}),
inv AS (
  SELECT id_factura,
         'INV/' || k AS numero_factura,
         CASE WHEN k % 7 = 3 THEN '' ELSE 'F' || k END AS folio_document,
         CASE k % 4 WHEN 0 THEN 'Electronic Invoice' WHEN 1 THEN 'Credit Note (61)' ELSE '' END
           AS tipo_documento,
         o_orderpriority AS condicion_pago,
         'posted' AS estado,
         d AS fecha_factura,
         CASE WHEN k % 9 = 4 THEN NULL ELSE d + 30 END AS fecha_vencimiento,
         CASE WHEN k % 13 = 0 THEN {DBL0} ELSE o_totalprice END AS monto_neto,
         o_totalprice * CAST(0.19 AS DOUBLE) AS monto_impuesto,
         o_totalprice * CAST(1.19 AS DOUBLE) AS total_factura,
         'paid' AS estado_pago,
         'SO' || k AS origen,
         o_custkey AS id_cliente,
         CASE WHEN k % 8 = 2 THEN NULL ELSE o_custkey % 10 END AS id_vendedor,
         o_custkey AS id_direccion_entrega
  FROM firsts)
SELECT * FROM inv WHERE {where}"""


_INV_COLS = ["id_factura", "numero_factura", "folio_document", "tipo_documento", "condicion_pago",
             "estado", "fecha_factura", "fecha_vencimiento", "monto_neto", "monto_impuesto",
             "total_factura", "estado_pago", "origen", "id_cliente", "id_vendedor",
             "id_direccion_entrega"]


def _sheet_cells(cols: list[str], dates=(), doubles=()) -> str:
    out = []
    for c in cols:
        if c in dates:
            out.append(f"COALESCE(strftime({c}, '%Y-%m-%d'), '') AS {c}")
        elif c in doubles:  # plain decimals: from the 17 digits that DuckDB prints, without an exponent
            out.append(f"COALESCE(CASE WHEN contains(CAST({c} AS VARCHAR), 'e') THEN "
                       f"CASE WHEN abs({c}) >= 1 THEN CAST(CAST({c} AS DECIMAL(38, 0)) AS VARCHAR) || '.0' "
                       f"ELSE rtrim(CAST(CAST({c} AS DECIMAL(38, 20)) AS VARCHAR), '0') END "
                       f"ELSE CAST({c} AS VARCHAR) END, '') AS {c}")
        else:
            out.append(f"COALESCE(CAST({c} AS VARCHAR), '') AS {c}")
    return ", ".join(out)


# ------------------------------------------------------------ invoice lines

_HEADERS = "SELECT DISTINCT o_orderkey // 2 FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 17 <> 0"

_RAW_SUBTOTAL = (f"CASE WHEN (l_orderkey + l_linenumber) % 23 = 0 THEN {DBL0} "
                 "WHEN l_returnflag = 'R' THEN -(l_extendedprice * (1 - l_discount)) "
                 "ELSE l_extendedprice * (1 - l_discount) END")


def _lines(start: str, end: str | None = None, with_month: bool = False) -> str:
    end_cond = f"AND CAST(l_shipdate AS DATE) <= DATE '{end}'" if end else ""
    month = ", CAST(date_trunc('month', CAST(l_shipdate AS DATE)) AS DATE) AS mes" if with_month else ""
    return f"""
SELECT l_orderkey * 10 + l_linenumber AS id_linea_factura,
       l_orderkey // 2 AS id_factura,
       l_partkey AS id_producto,
       l_quantity AS cantidad,
       l_quantity * 10 AS costo_unitario,
       l_extendedprice AS precio_unitario,
       {_RAW_SUBTOTAL} AS subtotal,
       l_discount AS descuento,
       {_RAW_SUBTOTAL} AS total{month}
FROM lineitem
WHERE (l_orderkey + l_linenumber) % 19 <> 0
  AND CAST(l_shipdate AS DATE) >= DATE '{start}' {end_cond}
  AND l_partkey % 50 <> 0
  AND {_RAW_SUBTOTAL} <> 0
  AND l_orderkey // 2 IN ({_HEADERS})"""


def _history(heads: str, lines: str) -> str:
    return f"""
SELECT 'factura' AS tabla, id_factura AS id, total_factura AS total, CAST(date_trunc('month', fecha_factura) AS DATE) AS mes FROM ({heads}) h
UNION ALL SELECT 'linea' AS tabla, id_linea_factura AS id, total, mes FROM ({lines}) l"""


_LINE_COLS = ["id_linea_factura", "id_factura", "id_producto", "cantidad", "costo_unitario",
              "precio_unitario", "subtotal", "descuento", "total"]

_TOP_LINES = f"""
SELECT l_orderkey * 10 + l_linenumber AS id,
       '[' || (l_orderkey // 2) || ', "INV/' || l_orderkey || '"]' AS move_id,
       CASE l_partkey % 3 WHEN 0 THEN '[]' WHEN 1 THEN '[1]' ELSE '[1, 2]' END AS tax_ids,
       l_extendedprice AS price_unit,
       {_RAW_SUBTOTAL} AS price_subtotal
FROM lineitem
WHERE (l_orderkey + l_linenumber) % 19 <> 0
  AND CAST(l_shipdate AS DATE) >= DATE '{START}'
  AND l_orderkey // 2 IN ({_HEADERS})
ORDER BY id DESC, price_subtotal DESC, price_unit DESC, move_id DESC, tax_ids DESC
LIMIT 100"""


# ------------------------------------------------------------------- orders

_ORDERS = f"""
SELECT o_orderkey AS id_pedido,
       CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'SO' || o_orderkey END AS referencia_pedido,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS fecha_creacion,
       CAST(o_orderdate AS DATE) + 1 AS fecha_pedido,
       o_custkey AS id_cliente,
       o_custkey % 10 AS id_vendedor,
       o_totalprice AS base_imponible,
       o_totalprice * CAST(0.19 AS DOUBLE) AS impuestos,
       CASE WHEN o_orderkey % 11 = 0 THEN {DBL0} ELSE o_totalprice * CAST(1.19 AS DOUBLE) END AS total,
       CASE o_orderkey % 6 WHEN 0 THEN 'Credit limit' WHEN 2 THEN '4' ELSE '' END AS excepcion,
       CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority ELSE '' END AS comentarios,
       CASE WHEN o_orderstatus = 'P' THEN 'draft' ELSE 'sale' END AS estado_pedido,
       CASE o_orderstatus WHEN 'F' THEN 'invoiced' WHEN 'O' THEN 'to invoice' ELSE '' END
         AS estado_facturacion,
       o_custkey AS id_direccion_entrega
FROM orders
WHERE CAST(o_orderdate AS DATE) + 1 >= DATE '{_WINDOW}'"""

_IN_WINDOW = f"CAST(o_orderdate AS DATE) + 1 >= DATE '{_WINDOW}'"
_CARRY = (f"(fecha_creacion >= DATE '{_M0}' OR (fecha_creacion >= DATE '{_M1}' "
          f"AND fecha_creacion < DATE '{_M0}' AND estado_facturacion <> 'invoiced'))")
_DISCARDED = (f"(fecha_creacion >= DATE '{_M1}' AND fecha_creacion < DATE '{_M0}' "
              "AND estado_facturacion = 'invoiced')")

_ORDER_LINES = f"""
SELECT l_orderkey * 10 + l_linenumber AS id_linea,
       l_orderkey AS id_pedido,
       CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_suppkey END AS id_cliente,
       l_partkey AS id_producto,
       l_quantity AS cantidad,
       l_extendedprice AS precio_unitario,
       l_discount AS descuento,
       l_extendedprice * (1 - l_discount) AS subtotal
FROM lineitem
WHERE CAST(l_shipdate - INTERVAL 30 DAY AS DATE) >= DATE '{_WINDOW}'"""

_CARRY_IDS = f"""
SELECT o_orderkey FROM orders
WHERE o_orderkey % 29 <> 0 AND CAST(o_orderdate AS DATE) >= DATE '{_M1}'
  AND (CAST(o_orderdate AS DATE) >= DATE '{_M0}' OR o_orderstatus <> 'F')"""


# ------------------------------------------------------------------ clients

def _clients(tags: bool, vendor_filter: bool) -> str:
    etiquetas = "concat_ws(', ', n1.n_name, n2.n_name)" if tags else "''"
    vend = ("AND id_vendedor IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 2)"
            if vendor_filter else "")
    return f"""
WITH c AS (
  SELECT c_custkey AS k, c.*,
         CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_nationkey || '-' || (c_custkey % 50) END AS rut,
         'calle ' || (c_custkey % 40) AS calle_key,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_nationkey % 7 END AS id_vendedor,
         {etiquetas} AS etiquetas
  FROM customer c
  LEFT JOIN nation n1 ON n1.n_nationkey = c.c_nationkey
  LEFT JOIN nation n2 ON n2.n_nationkey = c.c_nationkey + 20
  WHERE c_custkey % 31 <> 0 AND NOT (c_custkey % 3 = 0 AND c_custkey % 4 = 0) {vend}),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rut, calle_key, id_vendedor ORDER BY k) AS rn
                 FROM c) WHERE rn = 1)
SELECT k AS id_cliente,
       CASE WHEN k % 3 = 0 THEN 'person' ELSE 'company' END AS tipo_compania,
       CASE WHEN k % 4 = 0 THEN 'contact' ELSE 'invoice' END AS tipo_direccion,
       CASE WHEN k % 13 = 0 THEN '' ELSE c_name END AS nombre_cliente,
       rut,
       'D' || (k % 5) AS dia_visita,
       CASE WHEN k % 2 = 0 THEN 'Calle ' || (k % 40) ELSE '  CALLE ' || chr(9) || ' ' || (k % 40) || ' ' END
         AS calle,
       '' AS calle2,
       'City ' || c_nationkey AS comuna,
       c_mktsegment AS ciudad,
       lower(c_name) || '@mail.test' AS correo,
       CASE WHEN k % 2 = 1 THEN '' ELSE '+56 ' || k END AS telefono,
       CAST(DATE '1997-01-01' + CAST(k % 365 AS INTEGER) AS TIMESTAMP) + INTERVAL '8 hours 15 minutes'
         AS fecha_creacion,
       c_mktsegment AS id_plazo_pago,
       CASE WHEN k % 9 = 0 THEN {DBL0} ELSE c_acctbal END AS credito_limite,
       CASE WHEN k % 2 = 0 THEN '' ELSE 'Public' END AS id_tarifa,
       round_even(c_acctbal / 7, 6) AS geo_latitud,
       round_even(-c_acctbal / 11, 6) AS geo_longitud,
       id_vendedor,
       etiquetas
FROM firsts"""


# ----------------------------------------------------------------- products

_MASTER = "SELECT DISTINCT CAST(l_suppkey * 5 AS BIGINT) AS id_producto FROM lineitem WHERE l_suppkey IS NOT NULL"

_PRODUCTS = f"""
WITH m AS ({_MASTER}),
f AS (
  SELECT * FROM (SELECT p.*, p_partkey % 400 AS parent,
                        row_number() OVER (PARTITION BY p_partkey % 400 ORDER BY p_partkey) AS rn
                 FROM part p) WHERE rn = 1)
SELECT COALESCE(f.p_partkey, m.id_producto) AS id_producto_variante,
       m.id_producto AS id_producto_padre,
       CASE WHEN f.p_partkey IS NULL OR f.p_partkey % 10 = 0 THEN '' ELSE 'REF-' || f.p_partkey END
         AS referencia_interna,
       f.p_name AS nombre_producto,
       CASE WHEN f.p_partkey IS NULL OR f.p_partkey % 7 = 0 THEN NULL ELSE 'Units' END AS unidad_medida,
       CASE WHEN f.p_partkey IS NULL OR f.p_partkey % 11 = 0 THEN {DBL0} ELSE f.p_retailprice END
         AS precio_unitario,
       COALESCE(f.p_retailprice / 2, {DBL0}) AS coste_unitario,
       CAST(DATE '2020-01-01' + CAST(f.p_partkey % 500 AS INTEGER) AS DATE) AS fecha_creacion,
       COALESCE(CASE WHEN f.p_partkey % 13 = 0 THEN NULL ELSE f.p_partkey % 6 <> 0 END, false)
         AS puede_ser_vendido,
       f.p_type AS categoria
FROM m LEFT JOIN f ON m.id_producto = f.parent"""

_PRODUCT_COLS = ["id_producto_variante", "id_producto_padre", "referencia_interna",
                 "nombre_producto", "unidad_medida", "precio_unitario", "coste_unitario",
                 "fecha_creacion", "puede_ser_vendido", "categoria"]

_PRODUCT_TAXES = f"""
WITH m AS ({_MASTER}),
p AS (SELECT p_partkey, p_size FROM part
      WHERE p_partkey % 400 IN (SELECT id_producto FROM m) AND p_partkey % 9 <> 0),
t AS (SELECT p_partkey AS id_producto_variante, CAST(p_size % 5 + 1 AS BIGINT) AS id_impuestos FROM p
      UNION ALL
      SELECT p_partkey, CAST(p_size % 3 + 10 AS BIGINT) FROM p)
SELECT * FROM t WHERE id_impuestos IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 1)"""


ORACLE_SQL: dict[str, str] = {
    # ---- scalar normalisers
    "m2o_id": """
SELECT o_orderkey AS id,
       CASE o_orderkey % 10 WHEN 2 THEN NULL WHEN 7 THEN NULL ELSE o_custkey END AS id_cliente
FROM orders""",
    "m2o_id_scalar": """
SELECT o_orderkey AS id,
       CASE WHEN o_custkey = 0 THEN NULL ELSE o_custkey END AS id_vendedor,
       CAST(NULL AS BIGINT) AS id_cliente
FROM orders""",
    "m2o_name": """
SELECT o_orderkey AS id,
       CASE o_orderkey % 9 WHEN 0 THEN o_orderpriority WHEN 1 THEN o_orderpriority WHEN 8 THEN o_orderpriority
            WHEN 5 THEN 'None' WHEN 6 THEN 'None' ELSE NULL END AS nombre
FROM orders""",
    "m2m_names": """
SELECT p_partkey AS id,
       CASE p_partkey % 6 WHEN 0 THEN p_brand || ',' || p_type WHEN 1 THEN p_brand WHEN 4 THEN p_brand
            WHEN 5 THEN p_brand || ',None' ELSE NULL END AS nombres
FROM part""",
    "tag_map": """
WITH nation2 AS (
  SELECT n_nationkey, CASE WHEN n_nationkey = 3 THEN greatest(n_name, 'AAA') ELSE n_name END AS n_name FROM nation)
SELECT c_custkey AS id, concat_ws(', ', n1.n_name, n2.n_name) AS etiquetas
FROM customer c
LEFT JOIN nation2 n1 ON n1.n_nationkey = c.c_nationkey
LEFT JOIN nation2 n2 ON n2.n_nationkey = c.c_nationkey + 20
WHERE c_custkey % 31 <> 0""",
    "exception_label": """
SELECT o_orderkey AS id,
       CASE o_orderkey % 6 WHEN 0 THEN 'Credit limit' WHEN 2 THEN '4' ELSE '' END AS excepcion
FROM orders""",
    "num_default": f"""
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 8 IN (0, 4, 6) THEN o_totalprice ELSE {DBL0} END AS monto,
       CASE WHEN o_orderkey % 4 IN (0, 1) THEN o_custkey ELSE NULL END AS id_cliente
FROM orders""",
    "date_parse": """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 8 IN (0, 1, 6, 7) THEN CAST(o_orderdate AS DATE) ELSE NULL END AS fecha
FROM orders""",
    "iso_date": """
SELECT event_id AS id,
       CASE event_id % 4
         WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                     || CASE WHEN microsecond(ts) % 1000000 <> 0 THEN '.' || strftime(ts, '%f') ELSE '' END
         WHEN 1 THEN NULL
         WHEN 2 THEN strftime(ts, '%Y-%m-%d') || 'T00:00:00'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS iso
FROM events""",
    "id_to_string": """
SELECT c_custkey AS id,
       CASE WHEN c_custkey % 9 IN (0, 1) THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS id_texto
FROM customer""",
    "clean_text_a": """
SELECT c_custkey AS id,
       CASE c_custkey % 8 WHEN 0 THEN c_mktsegment WHEN 6 THEN ' ' || c_mktsegment || ' '
            WHEN 7 THEN 'True' ELSE '' END AS texto
FROM customer""",
    "clean_text_b": """
SELECT c_custkey AS id,
       CASE c_custkey % 8 WHEN 3 THEN '' WHEN 4 THEN '' WHEN 6 THEN 'None' ELSE c_mktsegment END
         AS texto
FROM customer""",
    "doc_type": """
SELECT p_partkey AS id,
       CASE p_partkey % 6 WHEN 0 THEN p_type WHEN 1 THEN p_type || ' (' || p_size || ')'
            WHEN 2 THEN '(AB) ' || p_type WHEN 3 THEN '' ELSE p_type END AS tipo_documento
FROM part""",
    "street_key": """
SELECT c_custkey AS id, lower(c_name) || ' ' || c_nationkey AS calle_key FROM customer""",
    "coord_round": """
SELECT s_suppkey AS id, round_even(s_acctbal / 7, 6) AS geo FROM supplier""",
    "list_length": """
SELECT l_orderkey * 10 + l_linenumber AS id,
       CASE l_partkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS n_taxes
FROM lineitem""",
    # ---- invoices
    "invoices": _invoices(START),
    "invoices_current_month": _invoices(_M0),
    "invoices_month_close": _invoices(_M1, f"fecha_factura <= DATE '{_M1_LAST}'"),
    "month_exists": f"""
SELECT DATE '{_M1}' AS dia, count(*) AS n, count(*) > 0 AS existe
FROM ({_invoices(START)}) h WHERE fecha_factura = DATE '{_M1}'""",
    "month_guard": f"""
SELECT CAST(date_trunc('month', fecha_factura) AS DATE) AS mes,
       count(*) FILTER (WHERE day(fecha_factura) = 1) AS n_dia_1,
       count(*) FILTER (WHERE day(fecha_factura) = 1) > 0 AS existe
FROM ({_invoices(START)}) h GROUP BY 1""",
    "invoice_lines": _lines(START),
    "invoice_lines_current_month": _lines(_M0),
    "invoice_lines_month_close": _lines(_M1, _M1_LAST),
    "backfill_by_month": f"""
SELECT *, CAST(date_trunc('month', fecha_factura) AS DATE) AS mes
FROM ({_invoices(BACKFILL_START, f"fecha_factura <= DATE '{_BACKFILL_LAST}'", _FIRST_OF_MONTHS)}) h""",
    "backfill_lines_by_month": _lines(BACKFILL_START, _BACKFILL_LAST, with_month=True),
    "sheet_rows": f"""
SELECT {_sheet_cells(_INV_COLS, dates=("fecha_factura", "fecha_vencimiento"))}
FROM ({_invoices(_M0)}) h""",
    "invoice_lines_sheet": f"""
SELECT {_sheet_cells(_LINE_COLS)} FROM ({_lines(_M0)}) h""",
    "top_ids": _TOP_LINES,
    "tax_array_profile": f"""
SELECT CASE tax_ids WHEN '[]' THEN 0 WHEN '[1]' THEN 1 ELSE 2 END AS n_taxes, count(*) AS count
FROM ({_TOP_LINES}) s GROUP BY 1""",
    # ---- orders
    "orders": _ORDERS,
    "orders_carryover": f"SELECT * FROM ({_ORDERS}) o WHERE {_CARRY}",
    "metrics_discarded": f"""
SELECT count(*) FILTER (WHERE {_DISCARDED}) AS descartados_facturados,
       count(*) FILTER (WHERE {_CARRY}) AS cargados,
       count(*) AS leidos
FROM ({_ORDERS}) o""",
    "orders_members": f"""
SELECT * FROM ({_ORDERS}) o
WHERE id_vendedor IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 2)
  AND id_cliente IN (SELECT s_suppkey FROM supplier)""",
    "orders_missing_columns": f"SELECT * EXCLUDE (comentarios, impuestos) FROM ({_ORDERS}) o",
    "invoice_lines_price_total": f"SELECT * REPLACE (total * CAST(2 AS DOUBLE) AS total) FROM ({_lines(START)}) l",
    "tax_array_profile_all": f"""
SELECT l_partkey % 3 AS n_taxes, count(*) AS count
FROM lineitem
WHERE (l_orderkey + l_linenumber) % 19 <> 0 AND CAST(l_shipdate AS DATE) >= DATE '{START}'
  AND l_orderkey // 2 IN ({_HEADERS})
GROUP BY 1""",
    # ---- written tables, read back
    "landed_json": f"""
SELECT o_orderkey AS id_pedido,
       CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'SO' || o_orderkey END AS referencia_pedido,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS fecha_creacion,
       CASE WHEN o_orderkey % 3 = 0 THEN {DBL0} ELSE o_totalprice END AS total,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS id_cliente,
       CAST(NULL AS BIGINT) AS id_vendedor
FROM orders""",
    "truncate_load": _ORDERS,
    "append_load": _ORDERS,
    "snapshot_load": f"""
SELECT *, 1 AS version FROM ({_ORDERS}) o WHERE id_vendedor < 5
UNION ALL SELECT *, 2 AS version FROM ({_ORDERS}) o""",
    "append_once": f"SELECT *, CAST(date_trunc('month', fecha_creacion) AS DATE) AS mes FROM ({_ORDERS}) o",
    "clients_increments": _clients(tags=False, vendor_filter=True),
    "invoices_increments": _invoices(START),
    "products_increments": _PRODUCTS,
    "orders_mirror": f"""
SELECT * REPLACE (CASE WHEN id_pedido % 3 = 0 THEN base_imponible * 2 ELSE base_imponible END AS base_imponible,
                  CASE WHEN id_pedido % 3 = 0 THEN 'changed' ELSE estado_facturacion END AS estado_facturacion)
FROM ({_ORDERS}) o""",
    "close_unit": _history(_invoices(_M1, f"fecha_factura <= DATE '{_M1_LAST}'"), _lines(_M1, _M1_LAST, with_month=True)),
    "backfill_resumed": _history(_invoices(BACKFILL_START, f"fecha_factura < DATE '{_M0}'", _FIRST_OF_MONTHS),
                                 _lines(BACKFILL_START, _BACKFILL_LAST, with_month=True)),
    "schema_load": _PRODUCTS,
    "history_load": f"""
SELECT *, CAST(date_trunc('month', fecha_factura) AS DATE) AS mes
FROM ({_invoices(BACKFILL_START, f"fecha_factura < DATE '{_M1}'", _FIRST_OF_MONTHS)}) h
UNION ALL
SELECT *, CAST(date_trunc('month', fecha_factura) AS DATE) AS mes
FROM ({_invoices(_M1, f"fecha_factura <= DATE '{_M1_LAST}'")}) c""",
    "line_history_load": _lines(BACKFILL_START, _BACKFILL_LAST, with_month=True),
    "sheet_upload": """
SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS fecha,
       CAST(CAST(round(o_totalprice) AS BIGINT) * 1000 AS VARCHAR) || '.0' AS grande,
       CASE WHEN o_orderkey % 10 = 0 THEN '0.0'
            ELSE '-' || rtrim(CAST(CAST((o_orderkey % 10) / CAST(4096 AS DOUBLE) AS DECIMAL(20, 12)) AS VARCHAR), '0') END AS chico
FROM orders""",
    "sheet_grid": f"""
SELECT row_number() OVER (ORDER BY CAST(substr(origen, 3) AS BIGINT)) AS n, {_sheet_cells(_INV_COLS)} FROM (
  SELECT {_sheet_cells(_INV_COLS, dates=["fecha_factura", "fecha_vencimiento"], doubles=["monto_neto", "monto_impuesto", "total_factura"])}
  FROM ({_invoices(_M0)}) i) t
UNION ALL SELECT 0 AS n, {', '.join(f"'{c}' AS {c}" for c in _INV_COLS)}""",
    "products_grid": f"""
SELECT row_number() OVER (ORDER BY CAST(id_producto_padre AS BIGINT)) AS n, {_sheet_cells(_PRODUCT_COLS)} FROM ({_PRODUCTS}) p
UNION ALL SELECT 0 AS n, {', '.join(f"'{c}' AS {c}" for c in _PRODUCT_COLS)}""",
    "day_probe": f"""
WITH h AS ({_invoices(START)})
SELECT dia, EXISTS (SELECT 1 FROM h WHERE fecha_factura = CAST(dia AS DATE)) AS existe
FROM (VALUES ('1996-01-01'), ('1997-06-15'), ('1998-06-01'), ('1998-06-15'), ('2050-01-01')) AS days(dia)""",
    "rejects": f"""
SELECT o_orderkey AS id_pedido, 'amount_untaxed' AS "column", 'n/a' AS raw, 'not a number' AS reason
FROM orders WHERE o_orderkey % 13 = 0 AND {_IN_WINDOW}
UNION ALL SELECT o_orderkey, 'amount_tax', o_orderkey || ' pesos', 'not a number' FROM orders WHERE o_orderkey % 17 = 0 AND {_IN_WINDOW}
UNION ALL SELECT o_orderkey, 'create_date', '31/12/1997', 'not a date' FROM orders WHERE o_orderkey % 11 = 0 AND {_IN_WINDOW}""",
    "orders_beside_rejects": f"""
SELECT * REPLACE (CASE WHEN id_pedido % 13 IN (0, 1) THEN {DBL0} ELSE base_imponible END AS base_imponible,
                  CASE WHEN id_pedido % 17 = 0 THEN {DBL0} ELSE impuestos END AS impuestos,
                  CASE WHEN id_pedido % 11 = 0 THEN NULL ELSE fecha_creacion END AS fecha_creacion)
FROM ({_ORDERS}) o""",
    "order_lines": _ORDER_LINES,
    "order_lines_carryover": f"SELECT * FROM ({_ORDER_LINES}) l WHERE id_pedido IN ({_CARRY_IDS})",
    # ---- clients
    "clients_dedup": _clients(tags=True, vendor_filter=False),
    "clients_vendor_filter": _clients(tags=False, vendor_filter=True),
    # ---- products
    "products_master": _PRODUCTS,
    "product_taxes": _PRODUCT_TAXES,
    "products_sheet": f"""
SELECT {_sheet_cells(_PRODUCT_COLS)} FROM ({_PRODUCTS}) p""",
    "taxes_extract": """
SELECT s_suppkey AS id, s_name AS name, s_acctbal / 100 AS amount FROM supplier""",
    "taxes_limited": """
SELECT s_suppkey AS id, s_name AS name, s_acctbal / 100 AS amount
FROM supplier ORDER BY s_suppkey LIMIT 40""",
    # ---- visits
    "visits_of_day": f"""
SELECT event_id AS id,
       CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'pending' END
         AS status,
       CASE event_type WHEN 'purchase' THEN '{VISIT_ICON_SUCCESS}' WHEN 'error' THEN '{VISIT_ICON_FAILED}'
            ELSE '{VISIT_ICON_OTHER}' END AS icon,
       COALESCE(CASE WHEN event_id % 4 = 0 THEN NULL
                     ELSE 'REF-' || user_id || '-' || event_id || '-' || event_type END, 'S/R') AS referencia,
       'Visit to customer number ' || user_id || ' (' || event_type || ')' AS titulo,
       strftime(ts, '%Y-%m-%d') AS planned_date
FROM events
WHERE CAST(ts AS DATE) = DATE '{VISIT_DAY}' AND NOT (event_id % 3 = 2 AND event_type = 'error')""",
}

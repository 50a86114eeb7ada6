"""Landing adapters: shape the driver's test tables as raw ERP records.

The test tables are typed (TPC-H-like). The library works on *raw* ERP
records: relations as JSON or Python-repr text, ``false`` markers, text
dates, padded text. These adapters derive such records from the typed
columns with Spark SQL expressions, row by row (no shuffle), so the work
grows with the tables. Dirty variants are chosen deterministically from the
row key (``pmod``), never by dropping rows; the DuckDB oracle computes the
expected typed values straight from the same base columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspark import schemas
from ledgerspark.sources.landed import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _shape(df: DataFrame, exprs: dict, schema) -> DataFrame:
    cols = [F.expr(e).cast(schema[n].dataType).alias(n) for n, e in exprs.items()]
    return df.select(*cols)


def _ts(col: str, fmt: str = "yyyy-MM-dd") -> str:
    return f"date_format({col}, '{fmt}')"


# account.move <- orders: invoice id = o_orderkey div 2, so consecutive orders
# share an invoice id and keep-first has real duplicates to resolve.
MOVES = {
    "id": "o_orderkey div 2",
    "name": "CASE WHEN pmod(o_orderkey, 5) = 0 THEN concat(' INV/', o_orderkey, '\\t') "
            "ELSE concat('INV/', o_orderkey) END",
    "state": "CASE o_orderstatus WHEN 'F' THEN 'posted' WHEN 'O' THEN 'draft' ELSE 'cancel' END",
    "l10n_latam_document_number": "CASE WHEN pmod(o_orderkey, 7) = 3 THEN NULL "
                                  "ELSE concat('F', o_orderkey) END",
    "invoice_date_due": "CASE WHEN pmod(o_orderkey, 9) = 4 THEN 'false' "
                        f"ELSE {_ts('date_add(o_orderdate, 30)')} END",
    "l10n_latam_document_type_id": (
        "CASE pmod(o_orderkey, 4) WHEN 0 THEN '[33, \"(33) Electronic Invoice\"]' "
        "WHEN 1 THEN '[61, \"Credit Note (61)\"]' WHEN 2 THEN 'false' "
        "ELSE \"[39, '(39) Receipt']\" END"),
    "invoice_date": f"CASE WHEN pmod(o_orderkey, 6) = 4 THEN {_ts('o_orderdate', 'yyyy-MM-dd 10:30:00')} "
                    f"ELSE {_ts('o_orderdate')} END",
    "partner_id": "CASE WHEN pmod(o_orderkey, 10) = 7 THEN 'false' "
                  "ELSE concat('[', o_custkey, ', \"Customer ', o_custkey, '\"]') END",
    "invoice_user_id": "CASE WHEN pmod(o_orderkey, 8) = 2 THEN 'false' "
                       "ELSE concat('[', pmod(o_custkey, 10), ', \"Seller\"]') END",
    "amount_untaxed": "CASE WHEN pmod(o_orderkey, 13) = 0 THEN NULL ELSE o_totalprice END",
    "amount_tax": "o_totalprice * CAST(0.19 AS DOUBLE)",
    "amount_total": "o_totalprice * CAST(1.19 AS DOUBLE)",
    "amount_residual": "CAST(0.0 AS DOUBLE)",
    "invoice_origin": "concat('SO', o_orderkey)",
    "invoice_payment_term_id": "concat('[', pmod(o_custkey, 3), ', \"', o_orderpriority, '\"]')",
    "payment_state": "CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'not_paid' END",
    "partner_shipping_id": "concat('[', o_custkey, ', \"Ship\"]')",
    "preferred_payment_method_line_id": "'false'",
    "move_type": "CASE WHEN pmod(o_orderkey, 17) = 0 THEN 'in_invoice' "
                 "WHEN o_totalprice > 450000 THEN 'out_refund' ELSE 'out_invoice' END",
    "_seq": "o_orderkey",
}

# account.move.line <- lineitem (header = l_orderkey div 2).
MOVE_LINES = {
    "id": "l_orderkey * 10 + l_linenumber",
    "move_id": "concat('[', l_orderkey div 2, ', \"INV/', l_orderkey, '\"]')",
    "product_id": "CASE WHEN pmod(l_partkey, 50) = 0 THEN 'false' "
                  "ELSE concat('[', l_partkey, ', \"Part ', l_partkey, '\"]') END",
    "quantity": "l_quantity",
    "discount": "l_discount",
    "product_uom_id": "'[1, \"Units\"]'",
    "price_unit": "l_extendedprice",
    "price_subtotal": "CASE WHEN pmod(l_orderkey + l_linenumber, 23) = 0 THEN CAST(0.0 AS DOUBLE) "
                      "WHEN l_returnflag = 'R' THEN -(l_extendedprice * (1 - l_discount)) "
                      "ELSE l_extendedprice * (1 - l_discount) END",
    "tax_ids": "CASE pmod(l_partkey, 3) WHEN 0 THEN '[]' WHEN 1 THEN '[1]' ELSE '[1, 2]' END",
    "account_id": "'[400, \"Sales\"]'",
    "name": "concat('Part ', l_partkey)",
    "date": _ts("l_shipdate"),
    "cost_price": "l_quantity * 10",
    "display_type": "CASE WHEN pmod(l_orderkey + l_linenumber, 19) = 0 THEN 'line_section' "
                    "ELSE 'product' END",
    "_seq": "l_orderkey * 10 + l_linenumber",
}

# sale.order <- orders.
SALE_ORDERS = {
    "id": "o_orderkey",
    "name": "CASE WHEN pmod(o_orderkey, 9) = 0 THEN 'None' ELSE concat('SO', o_orderkey) END",
    "create_date": "CASE WHEN pmod(o_orderkey, 29) = 0 THEN 'false' "
                   f"ELSE {_ts('o_orderdate', 'yyyy-MM-dd HH:mm:ss')} END",
    "date_order": _ts("o_orderdate + INTERVAL 1 DAY", "yyyy-MM-dd HH:mm:ss"),
    "amount_untaxed": "o_totalprice",
    "amount_tax": "o_totalprice * CAST(0.19 AS DOUBLE)",
    "amount_total": "CASE WHEN pmod(o_orderkey, 11) = 0 THEN NULL "
                    "ELSE o_totalprice * CAST(1.19 AS DOUBLE) END",
    "main_exception_id": "CASE pmod(o_orderkey, 6) WHEN 0 THEN '[3, \"Credit limit\"]' "
                         "WHEN 1 THEN 'false' WHEN 2 THEN '[4]' WHEN 3 THEN 'NaN' ELSE NULL END",
    "note_new": "CASE WHEN pmod(o_orderkey, 4) = 0 THEN o_orderpriority ELSE NULL END",
    "state": "CASE WHEN o_orderstatus = 'P' THEN 'draft' ELSE 'sale' END",
    "invoice_status": "CASE o_orderstatus WHEN 'F' THEN 'invoiced' WHEN 'O' THEN 'to invoice' "
                      "ELSE NULL END",
    "partner_shipping_id": "concat('[', o_custkey, ', \"Ship\"]')",
    "partner_id": "CASE WHEN pmod(o_orderkey, 10) = 3 THEN concat('[', o_custkey, \", 'Customer']\") "
                  "ELSE concat('[', o_custkey, ', \"Customer\"]') END",
    "user_id": "concat('[', pmod(o_custkey, 10), ', \"Seller\"]')",
    "_seq": "o_orderkey",
}

# sale.order.line <- lineitem (line created 30 days before shipping).
SALE_ORDER_LINES = {
    "id": "l_orderkey * 10 + l_linenumber",
    "order_id": "concat('[', l_orderkey, ', \"SO', l_orderkey, '\"]')",
    "create_date": _ts("l_shipdate - INTERVAL 30 DAYS", "yyyy-MM-dd HH:mm:ss"),
    "order_partner_id": "CASE WHEN pmod(l_suppkey, 7) = 0 THEN 'false' "
                        "ELSE concat('[', l_suppkey, ', \"P\"]') END",
    "discount": "l_discount",
    "product_id": "concat('[', l_partkey, ', \"Part\"]')",
    "product_uom_qty": "l_quantity",
    "price_unit": "l_extendedprice",
    "price_subtotal": "l_extendedprice * (1 - l_discount)",
    "_seq": "l_orderkey * 10 + l_linenumber",
}

# res.partner <- customer.
PARTNERS = {
    "id": "c_custkey",
    "commercial_company_name": "CASE WHEN pmod(c_custkey, 13) = 0 THEN 'False' ELSE c_name END",
    "company_type": "CASE WHEN pmod(c_custkey, 3) = 0 THEN 'person' ELSE 'company' END",
    "type": "CASE WHEN pmod(c_custkey, 4) = 0 THEN 'contact' ELSE 'invoice' END",
    "vat": "CASE WHEN pmod(c_custkey, 5) = 0 THEN '' "
           "ELSE concat(c_nationkey, '-', pmod(c_custkey, 50)) END",
    "user_id": "CASE WHEN pmod(c_custkey, 17) = 0 THEN 'false' "
               "ELSE concat('[', pmod(c_nationkey, 7), ', \"Vendor\"]') END",
    "visit_day": "concat('D', pmod(c_custkey, 5))",
    "street": "CASE WHEN pmod(c_custkey, 2) = 0 THEN concat('Calle ', pmod(c_custkey, 40)) "
              "ELSE concat('  CALLE \\t ', pmod(c_custkey, 40), ' ') END",
    "city": "c_mktsegment",
    "email": "concat(lower(c_name), '@mail.test')",
    "phone": "CASE WHEN pmod(c_custkey, 2) = 1 THEN NULL ELSE concat('+56 ', c_custkey) END",
    "create_date": "concat(date_format(date_add(DATE '1997-01-01', CAST(pmod(c_custkey, 365) AS INT)), "
                   "'yyyy-MM-dd'), ' 08:15:00')",
    "property_payment_term_id": "concat('[', pmod(c_custkey, 3), ', \"', c_mktsegment, '\"]')",
    "credit_limit": "CASE WHEN pmod(c_custkey, 9) = 0 THEN NULL ELSE c_acctbal END",
    "property_product_pricelist": "CASE WHEN pmod(c_custkey, 2) = 0 THEN 'false' "
                                  "ELSE '[1, \"Public\"]' END",
    "partner_latitude": "c_acctbal / 7",
    "city_id": "concat('[', c_nationkey, ', \"City ', c_nationkey, '\"]')",
    "partner_longitude": "-c_acctbal / 11",
    "category_id": "concat('[', c_nationkey, ', ', c_nationkey + 20, ']')",
    "active": "pmod(c_custkey, 31) <> 0",
    "street2": "CAST(NULL AS STRING)",
    "_seq": "c_custkey",
}

# product.product <- part (template = p_partkey % 400, so templates have variants).
PRODUCTS = {
    "id": "p_partkey",
    "default_code": "CASE WHEN pmod(p_partkey, 10) = 0 THEN 'false' ELSE concat('REF-', p_partkey) END",
    "name": "p_name",
    "uom_id": "CASE WHEN pmod(p_partkey, 7) = 0 THEN \"[1, 'Units']\" ELSE '[1, \"Units\"]' END",
    "list_price": "CASE WHEN pmod(p_partkey, 11) = 0 THEN NULL ELSE p_retailprice END",
    "standard_price": "p_retailprice / 2",
    "create_date": "concat(date_format(date_add(DATE '2020-01-01', CAST(pmod(p_partkey, 500) AS INT)), "
                   "'yyyy-MM-dd'), ' 12:00:00')",
    "taxes_id": "CASE WHEN pmod(p_partkey, 9) = 0 THEN '[]' "
                "ELSE concat('[', pmod(p_size, 5) + 1, ', ', pmod(p_size, 3) + 10, ']') END",
    "categ_id": "concat('[', p_size, ', \"', p_type, '\"]')",
    "sale_ok": "CASE WHEN pmod(p_partkey, 13) = 0 THEN NULL ELSE pmod(p_partkey, 6) <> 0 END",
    "product_tmpl_id": "concat('[', pmod(p_partkey, 400), ', \"Template\"]')",
    "active": "pmod(p_partkey, 8) <> 0",
    "_seq": "p_partkey",
}

# account.tax <- supplier.
TAXES = {"id": "s_suppkey", "name": "s_name", "amount": "s_acctbal / 100", "_seq": "s_suppkey"}


def moves(spark, sf_dir):
    return _shape(table(spark, sf_dir, "orders"), MOVES, schemas.RAW_INVOICES)


def move_lines(spark, sf_dir):
    return _shape(table(spark, sf_dir, "lineitem"), MOVE_LINES, schemas.RAW_INVOICE_LINES)


def sale_orders(spark, sf_dir):
    return _shape(table(spark, sf_dir, "orders"), SALE_ORDERS, schemas.RAW_ORDERS)


def sale_order_lines(spark, sf_dir):
    return _shape(table(spark, sf_dir, "lineitem"), SALE_ORDER_LINES, schemas.RAW_ORDER_LINES)


def partners(spark, sf_dir):
    return _shape(table(spark, sf_dir, "customer"), PARTNERS, schemas.RAW_CLIENTS)


def products(spark, sf_dir):
    return _shape(table(spark, sf_dir, "part"), PRODUCTS, schemas.RAW_PRODUCTS)


def taxes(spark, sf_dir):
    return _shape(table(spark, sf_dir, "supplier"), TAXES, schemas.RAW_TAXES)


def product_master(spark, sf_dir):
    """Master product list (``productos_atributos``): supplier keys * 5 from lineitem."""
    return table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") * 5).alias("id_producto"))


def allowed_taxes(spark, sf_dir):
    """Tax lookup (``impuestos``): nations of regions 0 and 1."""
    return (table(spark, sf_dir, "nation").where(F.col("n_regionkey") <= 1)
            .select(F.col("n_nationkey").alias("id_impuestos")))


def vendors(spark, sf_dir):
    """Vendor lookup (``vendedores``): nations of regions 0-2."""
    return (table(spark, sf_dir, "nation").where(F.col("n_regionkey") <= 2)
            .select(F.col("n_nationkey").alias("id_vendedor")))


def tags(spark, sf_dir):
    """Tag table (id -> name): the nation names."""
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"),
                                                 F.col("n_name").alias("name"))


# Route-visit payloads <- events: a JSON list, a {"results": [...]} page, or
# (errors on every third event) a page without results.
VISIT_STATUS = ("CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' "
                "ELSE 'pending' END")


def visit_payloads(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    visit = F.struct(
        F.col("event_id").alias("id"),
        F.expr(VISIT_STATUS).alias("status"),
        F.expr("CASE WHEN pmod(event_id, 4) = 0 THEN NULL "
               "ELSE concat('REF-', user_id, '-', event_id, '-', event_type) END").alias("reference"),
        F.expr("concat('Visit to customer number ', user_id, ' (', event_type, ')')").alias("title"),
        F.date_format("ts", "yyyy-MM-dd").alias("planned_date"))
    as_list = F.to_json(F.array(visit))
    as_page = F.to_json(F.struct(F.array(visit).alias("results")))
    payload = (F.when((F.pmod("event_id", F.lit(3)) == 2) & (F.col("event_type") == "error"),
                      F.lit('{"detail": "no visits"}'))
               .when(F.pmod("event_id", F.lit(3)) == 1, as_page)
               .otherwise(as_list))
    return ev.select(payload.alias("payload"), F.col("event_id").alias("_seq"))

"""Raw landing schemas and target table schemas.

Landing rule: relation and many2many fields are declared STRING so the JSON
reader keeps nested lists as raw JSON text and an ERP ``false`` becomes the
text ``"false"``; the normalisers in ``ledgerspark.functions`` parse them.
Every raw table carries ``_seq BIGINT``: the source order that keep-first
deduplication needs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The raw field names and the target column names below.
S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TS = T.DateType(), T.TimestampNTZType()


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SEQ_FIELD = ("_seq", L)

RAW_CLIENTS = struct(
    ("id", L), ("commercial_company_name", S), ("company_type", S), ("type", S), ("vat", S),
    ("user_id", S), ("visit_day", S), ("street", S), ("city", S), ("email", S), ("phone", S),
    ("create_date", S), ("property_payment_term_id", S), ("credit_limit", D),
    ("property_product_pricelist", S), ("partner_latitude", D), ("city_id", S),
    ("partner_longitude", D), ("category_id", S), ("active", B), ("street2", S), SEQ_FIELD)

RAW_ORDERS = struct(
    ("id", L), ("name", S), ("create_date", S), ("date_order", S), ("amount_untaxed", D),
    ("amount_tax", D), ("amount_total", D), ("main_exception_id", S), ("note_new", S),
    ("state", S), ("invoice_status", S), ("partner_shipping_id", S), ("partner_id", S),
    ("user_id", S), SEQ_FIELD)

RAW_ORDER_LINES = struct(
    ("id", L), ("order_id", S), ("create_date", S), ("order_partner_id", S), ("discount", D),
    ("product_id", S), ("product_uom_qty", D), ("price_unit", D), ("price_subtotal", D),
    SEQ_FIELD)

RAW_PRODUCTS = struct(
    ("id", L), ("default_code", S), ("name", S), ("uom_id", S), ("list_price", D),
    ("standard_price", D), ("create_date", S), ("taxes_id", S), ("categ_id", S),
    ("sale_ok", B), ("product_tmpl_id", S), ("active", B), SEQ_FIELD)

RAW_TAXES = struct(("id", L), ("name", S), ("amount", D), SEQ_FIELD)

RAW_INVOICES = struct(
    ("id", L), ("name", S), ("state", S), ("l10n_latam_document_number", S),
    ("invoice_date_due", S), ("l10n_latam_document_type_id", S), ("invoice_date", S),
    ("partner_id", S), ("invoice_user_id", S), ("amount_untaxed", D), ("amount_tax", D),
    ("amount_total", D), ("amount_residual", D), ("invoice_origin", S),
    ("invoice_payment_term_id", S), ("payment_state", S), ("partner_shipping_id", S),
    ("preferred_payment_method_line_id", S), ("move_type", S), SEQ_FIELD)

RAW_INVOICE_LINES = struct(
    ("id", L), ("move_id", S), ("product_id", S), ("quantity", D), ("discount", D),
    ("product_uom_id", S), ("price_unit", D), ("price_subtotal", D), ("tax_ids", S),
    ("account_id", S), ("name", S), ("date", S), ("cost_price", D), ("display_type", S),
    SEQ_FIELD)

RAW_VISITS = struct(("payload", S), SEQ_FIELD)

VISIT = struct(("id", L), ("status", S), ("reference", S), ("title", S), ("planned_date", S))

# ---- targets -------------------------------------------------------------

CLIENTS = struct(
    ("id_cliente", L), ("tipo_compania", S), ("tipo_direccion", S), ("nombre_cliente", S),
    ("rut", S), ("dia_visita", S), ("calle", S), ("calle2", S), ("comuna", S), ("ciudad", S),
    ("correo", S), ("telefono", S), ("fecha_creacion", TS), ("id_plazo_pago", S),
    ("credito_limite", D), ("id_tarifa", S), ("geo_latitud", D), ("geo_longitud", D),
    ("id_vendedor", L), ("etiquetas", S))

ORDERS = struct(
    ("id_pedido", L), ("referencia_pedido", S), ("fecha_creacion", DATE), ("fecha_pedido", DATE),
    ("id_cliente", L), ("id_vendedor", L), ("base_imponible", D), ("impuestos", D), ("total", D),
    ("excepcion", S), ("comentarios", S), ("estado_pedido", S), ("estado_facturacion", S),
    ("id_direccion_entrega", L))

ORDER_LINES = struct(
    ("id_linea", L), ("id_pedido", L), ("id_cliente", L), ("id_producto", L), ("cantidad", D),
    ("precio_unitario", D), ("descuento", D), ("subtotal", D))

PRODUCTS = struct(
    ("id_producto_variante", L), ("id_producto_padre", L), ("referencia_interna", S),
    ("nombre_producto", S), ("unidad_medida", S), ("precio_unitario", D), ("coste_unitario", D),
    ("fecha_creacion", DATE), ("puede_ser_vendido", B), ("categoria", S))

PRODUCT_TAXES = struct(("id_producto_variante", L), ("id_impuestos", L))

INVOICES = struct(
    ("id_factura", L), ("numero_factura", S), ("folio_document", S), ("tipo_documento", S),
    ("condicion_pago", S), ("estado", S), ("fecha_factura", DATE), ("fecha_vencimiento", DATE),
    ("monto_neto", D), ("monto_impuesto", D), ("total_factura", D), ("estado_pago", S),
    ("origen", S), ("id_cliente", L), ("id_vendedor", L), ("id_direccion_entrega", L))

INVOICE_LINES = struct(
    ("id_linea_factura", L), ("id_factura", L), ("id_producto", L), ("cantidad", D),
    ("costo_unitario", D), ("precio_unitario", D), ("subtotal", D), ("descuento", D),
    ("total", D))


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]

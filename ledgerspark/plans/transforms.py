"""Composite transforms T1-T6: landed raw records -> typed target tables.

Each transform is one lazy DataFrame plan built only from Catalyst
expressions (no Python UDFs). Steps follow the reference order wherever the
order changes the result (filters before keep-first, for instance).

Missing-column policies (kept per transform, as in the reference):

* clients, orders: a missing relation column yields nulls; other target
  columns are emitted only when their source column exists;
* invoices, invoice lines: missing relation columns are an error; other
  missing target columns become null columns;
* order lines: missing relation -> null id; any other missing column is an error;
* products: every source column is required.
"""

from __future__ import annotations

from typing import Mapping, Union

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerspark import schemas
from ledgerspark.functions import (amount, clean_markers, clean_strip, exception_label, m2o_id,
                                   m2o_list_id, m2o_list_name, m2o_name, month_of, parse_date,
                                   parse_timestamp, round_half_even, street_key, strip_doc_code,
                                   tag_names, to_id)
from ledgerspark.functions.common import then, with_columns_once
from ledgerspark.functions.rejects import REJECTS, rejects
from ledgerspark.functions.numbers import integral_or_null, parse_number
from ledgerspark.functions.relations import parse_list
from ledgerspark.operators import (SEQ, all_present, is_posted, keep_first, left_from_master,
                                   member_of, non_zero, not_person_contact, tag_names_from_table)
from ledgerspark.operators.membership import IdList

TagSource = Union[None, Mapping[int, str], DataFrame]


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def _require(df: DataFrame, cols, what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing required column(s) {missing}")


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def _target_cols(df: DataFrame, target: T.StructType, present_only: bool) -> list:
    """Ordered target columns; absent ones are skipped or added as typed nulls."""
    cols = []
    for f in target.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif not present_only:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return cols


def _select_target(df: DataFrame, target: T.StructType, present_only: bool,
                   extra=()) -> DataFrame:
    """Ordered select of the target schema, plus ``extra`` columns when present."""
    more = [F.col(c) for c in extra if c in df.columns and c not in target.fieldNames()]
    return df.select(*_target_cols(df, target, present_only), *more)


def _with_seq(df: DataFrame) -> list:
    return [F.col(SEQ)] if SEQ in df.columns else []


# ---------------------------------------------------------------- T4 invoices

# Raw field -> target column.
_INVOICE_TEXT = {"name": "numero_factura", "state": "estado", "payment_state": "estado_pago",
                 "invoice_origin": "origen", "l10n_latam_document_number": "folio_document"}
_INVOICE_AMOUNTS = {"amount_untaxed": "monto_neto", "amount_tax": "monto_impuesto",
                    "amount_total": "total_factura"}
_INVOICE_DATES = {"invoice_date": "fecha_factura", "invoice_date_due": "fecha_vencimiento"}


def invoices(raw: DataFrame, keep: tuple = (), by_month: bool = False, keep_seq: bool = False) -> DataFrame:
    """T4: posted invoice headers, one row per invoice id (first in source order).

    ``keep`` names extra output columns to retain (e.g. ``"fecha_factura"`` is
    already there; jobs use it to derive the month partition), ``keep_seq`` the source order. ``by_month`` gives
    what month-by-month runs store, each of which reads everything from its month's
    first day on, keeps the first row of an id and stores those of its month: of an
    id, a month's first row stays where no later month has an earlier one.
    """
    rel = ["partner_id", "invoice_user_id", "partner_shipping_id",
           "l10n_latam_document_type_id", "invoice_payment_term_id"]
    _require(raw, rel, "invoices")
    d = lambda c: _dtype(raw, c)
    # Parsed once per row (regex work); filters below reuse the results.
    parsed = {
        "id_cliente": m2o_id("partner_id", d("partner_id")),
        "id_vendedor": m2o_id("invoice_user_id", d("invoice_user_id")),
        "id_direccion_entrega": m2o_id("partner_shipping_id", d("partner_shipping_id")),
        "tipo_documento": then(m2o_list_name("l10n_latam_document_type_id", d("l10n_latam_document_type_id"),
                                             none_as_text=True), lambda c: clean_strip(strip_doc_code(c))),
        "condicion_pago": then(m2o_list_name("invoice_payment_term_id", d("invoice_payment_term_id"),
                                             none_as_text=True), clean_strip),
    }
    for src, dst in _INVOICE_DATES.items():
        if src in raw.columns:
            parsed[dst] = parse_date(src, d(src))
    cols = [F.col(k) for k in parsed]
    if "id" in raw.columns:
        cols.append(to_id("id", d("id")).alias("id_factura"))
    for src, dst in _INVOICE_TEXT.items():
        if src in raw.columns:
            cols.append(clean_strip(F.col(src).cast("string")).alias(dst))
    for src, dst in _INVOICE_AMOUNTS.items():
        if src in raw.columns:
            cols.append(amount(src, d(src)).alias(dst))
    df = with_columns_once(raw, parsed, keys=("id_cliente", "fecha_factura"))
    df = df.select(*cols, *_with_seq(raw), *[F.col(k) for k in keep if k in raw.columns])
    _require(df, ["id_factura", "fecha_factura"], "invoices")
    df = df.where(all_present("id_factura", "id_cliente", "fecha_factura"))
    if "estado" in df.columns:
        df = df.where(is_posted("estado"))
    if by_month:
        df = keep_first(df.withColumn("_mes", month_of("fecha_factura")), ["id_factura", "_mes"])
        later = Window.partitionBy("id_factura").orderBy(F.desc("_mes"))
        df = df.withColumn("_least", F.min(SEQ).over(later)).where(F.col(SEQ) == F.col("_least"))
    else:
        df = keep_first(df, ["id_factura"])
    return _select_target(df, schemas.INVOICES, present_only=False, extra=(*keep, SEQ) if keep_seq else keep)


# ---------------------------------------------------------- T5 invoice lines

# Raw field -> target column.
_LINE_AMOUNTS = {"quantity": "cantidad", "price_unit": "precio_unitario",
                 "cost_price": "costo_unitario", "price_subtotal": "subtotal",
                 "discount": "descuento"}


def invoice_lines(raw: DataFrame, with_date: bool = False, keep_seq: bool = False) -> DataFrame:
    """T5: invoice lines with product and invoice ids and a non-zero total.

    ``total`` is ``price_total`` when the raw table has it, else the subtotal.
    ``with_date=True`` appends ``fecha`` (the line date) for month partitions, ``keep_seq`` the source order.
    """
    _require(raw, ["move_id", "product_id", "price_subtotal"], "invoice_lines")
    d = lambda c: _dtype(raw, c)
    total_src = "price_total" if "price_total" in raw.columns else "price_subtotal"
    parsed = {
        "id_factura": m2o_id("move_id", d("move_id")),
        "id_producto": m2o_id("product_id", d("product_id")),
    }
    if with_date:
        parsed["fecha"] = (parse_date("date", d("date")) if "date" in raw.columns
                           else _null("date"))
    cols = [F.col(k) for k in parsed] + [amount(total_src, d(total_src)).alias("total")]
    if "id" in raw.columns:
        cols.append(to_id("id", d("id")).alias("id_linea_factura"))
    for src, dst in _LINE_AMOUNTS.items():
        if src in raw.columns:
            cols.append(amount(src, d(src)).alias(dst))
    df = with_columns_once(raw, parsed, keys=("id_factura", "id_producto", "fecha"))
    df = df.select(*cols, *(_with_seq(raw) if keep_seq else []))
    df = df.where(all_present("id_producto", "id_factura") & non_zero("total"))
    return _select_target(df, schemas.INVOICE_LINES, present_only=False,
                          extra=(*(["fecha"] if with_date else []), *([SEQ] if keep_seq else [])))


# ------------------------------------------------------------------ T2 orders

# Raw field -> target column.
_ORDER_TEXT = {"name": "referencia_pedido", "note_new": "comentarios", "state": "estado_pedido",
               "invoice_status": "estado_facturacion"}
_ORDER_AMOUNTS = {"amount_untaxed": "base_imponible", "amount_tax": "impuestos",
                  "amount_total": "total"}
_ORDER_DATES = {"create_date": "fecha_creacion", "date_order": "fecha_pedido"}


def _rel_id(raw: DataFrame, src: str, allow_scalar: bool = False) -> Column:
    if src not in raw.columns:
        return _null("bigint")
    return m2o_id(src, _dtype(raw, src), allow_scalar=allow_scalar)


def orders(raw: DataFrame, vendors: IdList = None, clients: IdList = None, with_rejects: bool = False) -> DataFrame:
    """Sale-order headers with ids, amounts, dates and cleaned text.

    ``vendors`` / ``clients`` are optional membership lists (empty = no filter). ``with_rejects``
    adds the values that the casts cannot read (``functions.rejects``).
    """
    d = lambda c: _dtype(raw, c)
    parsed = {
        "id_cliente": _rel_id(raw, "partner_id"),
        "id_vendedor": _rel_id(raw, "user_id"),
        "id_direccion_entrega": _rel_id(raw, "partner_shipping_id"),
        "excepcion": (then(exception_label("main_exception_id", d("main_exception_id")), clean_markers)
                      if "main_exception_id" in raw.columns else F.lit("")),
    }
    for src, dst in _ORDER_DATES.items():
        if src in raw.columns:
            parsed[dst] = parse_date(src, d(src))
    cols = [F.col(k) for k in parsed]
    if "id" in raw.columns:
        cols.append(to_id("id", d("id")).alias("id_pedido"))
    for src, dst in _ORDER_TEXT.items():
        if src in raw.columns:
            cols.append(clean_markers(F.col(src).cast("string")).alias(dst))
    for src, dst in _ORDER_AMOUNTS.items():
        if src in raw.columns:
            cols.append(amount(src, d(src)).alias(dst))
    if with_rejects:
        cols.append(rejects(raw, numbers=list(_ORDER_AMOUNTS), integers=["id"], dates=list(_ORDER_DATES)))
    keys = [n for n, ids in (("id_vendedor", vendors), ("id_cliente", clients)) if ids is not None]
    df = with_columns_once(raw, parsed, keys=["fecha_creacion", *keys]).select(*cols, *_with_seq(raw))
    df = member_of(df, "id_vendedor", vendors, empty="all")
    df = member_of(df, "id_cliente", clients, empty="all")
    return _select_target(df, schemas.ORDERS, present_only=True, extra=(REJECTS,) if with_rejects else ())


# ------------------------------------------------------------- T3 order lines

def order_lines(raw: DataFrame, products: IdList = None, orders: IdList = None,
                empty_orders: str = "all", with_rejects: bool = False) -> DataFrame:
    """Sale-order lines; optional product / order membership (empty = no filter; an empty order list
    keeps nothing with ``empty_orders="none"``). ``with_rejects`` as in T2."""
    _require(raw, ["id", "product_uom_qty", "price_unit", "price_subtotal", "discount"],
             "order_lines")
    d = lambda c: _dtype(raw, c)
    parsed = {"id_pedido": _rel_id(raw, "order_id"),
              "id_cliente": _rel_id(raw, "order_partner_id"),
              "id_producto": _rel_id(raw, "product_id")}
    keys = [n for n, ids in (("id_producto", products), ("id_pedido", orders)) if ids is not None]
    df = with_columns_once(raw, parsed, keys=keys).select(
        to_id("id", d("id")).alias("id_linea"),
        "id_pedido", "id_cliente", "id_producto",
        amount("product_uom_qty", d("product_uom_qty")).alias("cantidad"),
        amount("price_unit", d("price_unit")).alias("precio_unitario"),
        amount("discount", d("discount")).alias("descuento"),
        amount("price_subtotal", d("price_subtotal")).alias("subtotal"),
        *([rejects(raw, numbers=["product_uom_qty", "price_unit", "discount", "price_subtotal"], integers=["id"])] if with_rejects else []),
    )
    df = member_of(df, "id_producto", products, empty="all")
    df = member_of(df, "id_pedido", orders, empty=empty_orders)
    return _select_target(df, schemas.ORDER_LINES, present_only=False, extra=(REJECTS,) if with_rejects else ())


# ----------------------------------------------------------------- T1 clients

# Raw field -> target column.
_CLIENT_TEXT = {"commercial_company_name": "nombre_cliente", "vat": "rut", "email": "correo",
                "phone": "telefono", "city": "ciudad", "street": "calle",
                "company_type": "tipo_compania", "type": "tipo_direccion",
                "visit_day": "dia_visita", "street2": "calle2"}
_CLIENT_NAMES = {"property_payment_term_id": "id_plazo_pago",
                 "property_product_pricelist": "id_tarifa", "city_id": "comuna"}


def clients(raw: DataFrame, tags: TagSource = None, vendors: IdList = None, keep_seq: bool = False) -> DataFrame:
    """Partners -> clients.

    Person contacts are dropped, then rows equal on (rut, normalised street,
    vendor) keep the first in source order; ``vendors`` (empty = no filter)
    restricts the vendor id. ``tags`` maps category ids to names (dict or a
    two-column table ``id, name``). ``keep_seq`` keeps the source order.
    """
    d = lambda c: _dtype(raw, c)
    parsed = {"id_vendedor": _rel_id(raw, "user_id", allow_scalar=True)}
    for src, dst in _CLIENT_NAMES.items():
        name = m2o_name(src, d(src)) if src in raw.columns else _null("string")
        parsed[dst] = then(name, clean_markers)
    if "create_date" in raw.columns:
        parsed["fecha_creacion"] = parse_timestamp("create_date", d("create_date"))
    cols = [F.col(k) for k in parsed]
    if "id" in raw.columns:
        cols.append(to_id("id", d("id")).alias("id_cliente"))
    for src, dst in _CLIENT_TEXT.items():
        if src in raw.columns:
            cols.append(clean_markers(F.col(src).cast("string")).alias(dst))
    if "credit_limit" in raw.columns:
        cols.append(amount("credit_limit", d("credit_limit")).alias("credito_limite"))
    for src, dst in (("partner_latitude", "geo_latitud"), ("partner_longitude", "geo_longitud")):
        if src in raw.columns:
            cols.append(round_half_even(amount(src, d(src)), 6).alias(dst))
    has_tags = "category_id" in raw.columns
    if has_tags and not isinstance(tags, DataFrame):
        cols.append(tag_names("category_id", dict(tags or {}), d("category_id")).alias("etiquetas"))
    elif has_tags:
        cols.append(F.col("category_id"))
    else:
        cols.append(_null("string").alias("etiquetas"))
    df = with_columns_once(raw, parsed, keys=("id_vendedor",)).select(*cols, *_with_seq(raw))

    if "tipo_compania" in df.columns and "tipo_direccion" in df.columns:
        df = df.where(not_person_contact())
    # The vendor filter runs before keep-first: the vendor id is one of the
    # dedup keys, so whole groups are kept or dropped -- same result, less data.
    df = member_of(df, "id_vendedor", vendors, empty="all")
    if "calle" in df.columns:
        _require(df, ["rut"], "clients dedup")
        df = df.withColumn("_calle_key", street_key("calle"))
        df = keep_first(df, ["rut", "_calle_key", "id_vendedor"]).drop("_calle_key")
    if has_tags and isinstance(tags, DataFrame):
        df = tag_names_from_table(df, "category_id", tags, "etiquetas")
    return _select_target(df, schemas.CLIENTS, present_only=True, extra=(SEQ,) if keep_seq else ())


# ---------------------------------------------------------------- T6 products

def parent_id(raw: DataFrame) -> Column:
    """The parent id of raw products."""
    return m2o_list_id("product_tmpl_id", _dtype(raw, "product_tmpl_id"))


def _erp_products(raw: DataFrame) -> DataFrame:
    _require(raw, ["id", "product_tmpl_id", "default_code", "name", "uom_id", "list_price",
                   "standard_price", "create_date", "sale_ok", "categ_id"], "products")
    d = lambda c: _dtype(raw, c)
    parsed = {"_parent_id": m2o_list_id("product_tmpl_id", d("product_tmpl_id"))}
    return with_columns_once(raw, parsed, keys=("_parent_id",)).select(
        to_id("id", d("id")).alias("_variant_id"),
        "_parent_id",
        "default_code", "name", "uom_id", "list_price", "standard_price", "create_date",
        "sale_ok", "categ_id", *[c for c in ("taxes_id", SEQ) if c in raw.columns])


def products(raw: DataFrame, master: DataFrame, master_key: str = "id_producto") -> DataFrame:
    """T6 (products): one row per master product id, first variant attached.

    Unmatched master ids keep their id as the variant id, 0 prices, "" code,
    ``false`` sellable and null names. A landed ``false`` code becomes "".
    No raw rows at all give no products (decided at run time, by a subquery).
    """
    variants = _erp_products(raw)
    m = master.select(F.col(master_key).cast("bigint").alias("id_producto")) \
        .where(F.col("id_producto").isNotNull())
    df = left_from_master(m, "id_producto", variants, "_parent_id")
    d = lambda c: _dtype(raw, c)
    code = F.col("default_code").cast("string")
    df = df.select(
        F.coalesce("_variant_id", "id_producto").alias("id_producto_variante"),
        F.col("id_producto").alias("id_producto_padre"),
        F.when(code.isNull() | (code == "false"), F.lit("")).otherwise(code)
        .alias("referencia_interna"),
        F.col("name").cast("string").alias("nombre_producto"),
        m2o_list_name("uom_id", d("uom_id")).alias("unidad_medida"),
        amount("list_price", d("list_price")).alias("precio_unitario"),
        amount("standard_price", d("standard_price")).alias("coste_unitario"),
        parse_date("create_date", d("create_date")).alias("fecha_creacion"),
        F.coalesce(F.col("sale_ok").cast("boolean"), F.lit(False)).alias("puede_ser_vendido"),
        m2o_list_name("categ_id", d("categ_id")).alias("categoria"),
    )
    return _select_target(df.where(raw.select(F.lit(1)).exists()), schemas.PRODUCTS, present_only=False)


def product_taxes(raw: DataFrame, master: DataFrame, taxes: IdList,
                  master_key: str = "id_producto") -> DataFrame:
    """T6 (bridge): (variant, tax) pairs of every variant whose parent is in the master.

    All variants count, not only the one kept in ``products``. Tax ids must be
    in ``taxes``; an empty tax list yields no rows. Pairs are not deduplicated.
    """
    _require(raw, ["taxes_id"], "product_taxes")
    variants = _erp_products(raw)
    m = master.select(F.col(master_key).cast("bigint").alias("_master_id"))
    rel = variants.join(m, F.col("_parent_id") == F.col("_master_id"), "left_semi")
    d = _dtype(raw, "taxes_id")
    arr = F.col("taxes_id") if isinstance(d, T.ArrayType) \
        else parse_list(F.col("taxes_id").cast("string"))
    bridge = rel.select(F.col("_variant_id").alias("id_producto_variante"),
                        F.explode(arr).alias("_tax"))
    bridge = bridge.select(
        "id_producto_variante",
        integral_or_null(parse_number(F.col("_tax").cast("string"))).alias("id_impuestos"))
    bridge = member_of(bridge, "id_impuestos", taxes, empty="none")
    bridge = bridge.where(all_present("id_producto_variante", "id_impuestos"))
    return _select_target(bridge, schemas.PRODUCT_TAXES, present_only=False)

"""Readers over landed ERP files and warehouse lookups."""

from ledgerspark.sources.erp import (clients_raw, invoice_lines_raw, invoices_raw,  # noqa: F401
                                     order_lines_raw, orders_raw, products_raw, taxes_raw)
from ledgerspark.sources.landed import fetch, read_landed  # noqa: F401
from ledgerspark.sources.lookups import master_product_ids, tax_ids, vendor_ids  # noqa: F401
from ledgerspark.sources.visits import visit_listing, visit_list, visits_of_day  # noqa: F401

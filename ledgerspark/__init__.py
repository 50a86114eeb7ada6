"""ledgerspark: back-office ERP analytics as Spark DataFrame plans.

Landed, loosely typed ERP records (clients, sale orders and lines, products,
taxes, invoices and lines, route visits) are normalised with native Catalyst
column expressions, deduplicated keep-first, filtered by membership lists and
loaded into current-month / history tables or flat spreadsheet extracts.

Layout
------
functions/  scalar column normalisers (Column -> Column, no UDFs)
operators/  relational building blocks: keep-first, membership, master join,
            bridge explode, business filters, counts and top-k
sources/    readers over landed files and warehouse lookups
sinks/      table loads (truncate, append, month partitions) and sheet extracts
plans/      the composite transforms and the jobs built from them
streaming/  incremental landing trigger (availableNow) for the batch jobs
catalog/    the query catalogue run against the driver's test tables
"""

from ledgerspark.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]

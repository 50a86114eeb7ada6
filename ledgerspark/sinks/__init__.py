"""Table loads, month-partition policies and sheet extracts (K1-K9)."""

from ledgerspark.sinks.sheets import grid, raw_rows, sheet_rows, upload_grid, upload_sheet  # noqa: F401
from ledgerspark.sinks.tables import MONTH, conform, load, replace_months, with_month  # noqa: F401

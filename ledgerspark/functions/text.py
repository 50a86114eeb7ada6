"""Text normalisers (X15-X19, X22, X26). Column -> Column, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ledgerspark.functions.common import WS_CLASS, strip_ws  # noqa: F401

# Markers cleaned to "" by text cleaning A (exact, whole value).
# The last two are how an ERP False / JSON null look once landed as text.
TEXT_MARKERS = ["None", "False", "nan", "<NA>", "false", "null"]

# Markers dropped to null by the id-to-text normaliser.
ID_TEXT_MARKERS = ["<NA>", "nan", "False", "None", "false", "NaN"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_markers(col, markers=TEXT_MARKERS) -> Column:
    """Text cleaning A: null or an exact marker -> "", else unchanged (no trim)."""
    c = _c(col)
    return F.when(c.isNull() | c.isin(*markers), F.lit("")).otherwise(c)


def clean_strip(col) -> Column:
    """Text cleaning B: null / landed False -> "", else whitespace-stripped."""
    c = _c(col)
    return F.when(c.isNull() | (c == F.lit("false")), F.lit("")).otherwise(strip_ws(c))


def strip_doc_code(col) -> Column:
    """Document type: drop a leading ``(<digits>)`` code and the spaces after it.

    ``"(7) Delivery Slip"`` -> ``"Delivery Slip"``; null -> "".
    """
    c = _c(col)
    return F.when(c.isNull() | (c == F.lit("")) | (c == F.lit("false")), F.lit("")) \
        .otherwise(F.regexp_replace(c, r"^\(\p{Nd}+\)" + WS_CLASS + "*", ""))


def street_key(col) -> Column:
    """Dedup key for streets: lower case, stripped, inner whitespace collapsed."""
    return F.regexp_replace(strip_ws(F.lower(_c(col))), WS_CLASS + "+", " ")


def id_text(col, dtype: T.DataType = T.StringType()) -> Column:
    """Ids rendered as text without a decimal part: ``12.0`` -> ``"12"``.

    Markers and NaN become null; anything after the first ``.`` is dropped.
    """
    c = _c(col)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        s = F.when(F.isnan(c), F.lit(None)).otherwise(c.cast("string"))
    else:
        s = c.cast("string")
    s = F.when(s.isin(*ID_TEXT_MARKERS), F.lit(None).cast("string")).otherwise(s)
    return F.when(s.contains("."), F.substring_index(s, ".", 1)).otherwise(s)


# Route-visit listing status icons and defaults.
VISIT_ICON_SUCCESS = "🟢"
VISIT_ICON_FAILED = "🔴"
VISIT_ICON_OTHER = "🟡"
VISIT_REFERENCE_DEFAULT = "S/R"
VISIT_TITLE_DEFAULT = "Sin nombre"


def visit_status_flag(status) -> Column:
    """Traffic-light marker of a visit status: success / failed / other."""
    s = _c(status)
    return F.when(s == "success", F.lit(VISIT_ICON_SUCCESS)) \
        .when(s == "failed", F.lit(VISIT_ICON_FAILED)) \
        .otherwise(F.lit(VISIT_ICON_OTHER))


def visit_reference(ref) -> Column:
    return F.coalesce(_c(ref).cast("string"), F.lit(VISIT_REFERENCE_DEFAULT))


def visit_title(title) -> Column:
    return F.coalesce(_c(title).cast("string"), F.lit(VISIT_TITLE_DEFAULT))

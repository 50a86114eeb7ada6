"""Relation-field normalisers.

An ERP relation arrives in one of these shapes, all handled without UDFs:

* text holding a JSON list ``[5, "Name"]`` (how a real list is landed),
* text holding a Python repr ``[5, 'Name']`` / ``[5, None]`` (a list that was
  stringified before landing),
* ``false`` / marker text / null (no relation),
* bare id text ``"7"`` or a bare number column,
* an ``array<...>`` or ``struct<id, name>`` column.

The functions take the column and its Spark type, because the reference's
rules differ by Python type (list vs. text vs. number) and the Spark type is
how that distinction survives landing.

Flat list literals are recognised with one anchored regular expression that
also captures the wanted element; the captured token is bound once with
``let`` and then converted with cheap string operations. This costs a single
regex pass per value (a JSON parse plus fallbacks was several times slower).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ledgerspark.functions.common import WS_CLASS, let, memo_by_name, strip_ws
from ledgerspark.functions.numbers import (int_text, integral_or_null, parse_number,
                                           truncate_float_text)

# Whole-value markers meaning "no relation" (reference markers
# plus the landed spellings of False / null).
RELATION_MARKERS = ["None", "False", "[]", "", "false", "null"]

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
            T.FloatType, T.DoubleType, T.DecimalType)

# One element of a flat list literal: quoted text (either quote), a number,
# or a Python / JSON keyword.
_ELEM = (r"""(?>"(?:[^"\\]|\\.)*+"|'(?:[^'\\]|\\.)*+'|[-+]?(?:\d++\.?\d*+|\.\d++)"""
         r"""(?:[eE][-+]?\d++)?|None|True|False|null|true|false)""")
# One element of a JSON list (as landed from a real list).
_JELEM = r"""(?>"(?:[^"\\]|\\.)*+"|-?\d++(?:\.\d++)?(?:[eE][-+]?\d++)?|null|true|false)"""
# A list or object inside a list (its own elements flat).
_NEST = r"""(?>\[[^\[\]{}]*+\]|\{[^\[\]{}]*+\})"""
_SEP = r"\s*+,\s*+"
_END = r"\s*+,?\s*+\]" + WS_CLASS + "*+$"

# Python-literal lists; group 1 = first element. Surrounding space allowed.
LIST_FIRST = rf"^{WS_CLASS}*+\[\s*+({_ELEM})(?:{_SEP}(?:{_ELEM}|{_NEST}))*+{_END}"
# Python-literal lists with 2+ elements, text starting with "["; group 1 = second.
LIST_SECOND = rf"^\[\s*+{_ELEM}{_SEP}({_ELEM}|{_NEST})(?:{_SEP}(?:{_ELEM}|{_NEST}))*+{_END}"
# JSON lists of any length starting with "["; groups 1, 2 = first, second element.
JSON_LIST = (rf"^\[\s*+(?:({_JELEM})(?:{_SEP}({_JELEM}|{_NEST})(?:{_SEP}(?:{_JELEM}|{_NEST}))*+)?)?"
             rf"\s*+\]{WS_CLASS}*+$")

_STRICT_JSON = {"allowSingleQuotes": "false"}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _is_marker(c: Column) -> Column:
    return c.isNull() | c.isin(*RELATION_MARKERS)


# ---- element tokens -> Python values ------------------------------------

def _quoted(t: Column) -> Column:
    return t.startswith('"') | t.startswith("'")


def _unquote(t: Column) -> Column:
    inner = F.substring(t, F.lit(2), F.length(t) - 2)
    return F.when(inner.contains("\\"), F.regexp_replace(inner, r"\\(.)", "$1")).otherwise(inner)


def _token_text(t: Column) -> Column:
    """``str(x)`` of a list element token (None -> "None", true -> "True"; a nested list or object as Python
    would print it)."""
    nested = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, '"', "'"), r"\s*,\s*", ", "), r"\s*:\s*", ": ")
    return (F.when(_quoted(t), _unquote(t))
            .when(t.startswith("[") | t.startswith("{"), nested)
            .when(t.isin("None", "null"), F.lit("None"))
            .when(t.isin("True", "true"), F.lit("True"))
            .when(t.isin("False", "false"), F.lit("False"))
            .otherwise(t))


def _token_value(t: Column) -> Column:
    """The element as a value: text for quoted/number tokens, null for None/null."""
    return F.when(t.isin("None", "null"), F.lit(None).cast("string")).otherwise(_token_text(t))


def _token_int(t: Column) -> Column:
    """``int(x)`` of a list element: text must be a whole number, numbers truncate."""
    return (F.when(_quoted(t), int_text(_unquote(t)))
            .when(t.isin("True", "true"), F.lit(1).cast("bigint"))
            .when(t.isin("False", "false"), F.lit(0).cast("bigint"))
            .when(t.isin("None", "null"), F.lit(None).cast("bigint"))
            .otherwise(t.try_cast("double").try_cast("bigint")))


def _token_numeric_id(t: Column) -> Column:
    """``to_numeric(x)`` then nullable-integer typing (5.0 -> 5, 5.7 -> null)."""
    return (F.when(_quoted(t), integral_or_null(parse_number(_unquote(t))))
            .when(t.isin("True", "true"), F.lit(1).cast("bigint"))
            .when(t.isin("False", "false"), F.lit(0).cast("bigint"))
            .when(t.isin("None", "null"), F.lit(None).cast("bigint"))
            .otherwise(integral_or_null(t.try_cast("double"))))


def _first(c: Column) -> Column:
    return F.regexp_extract(c, LIST_FIRST, 1)


def _json_group(c: Column, i: int) -> Column:
    return F.regexp_extract(c, JSON_LIST, i)


# ---- public normalisers ------------------------------------------------------

@memo_by_name
def m2o_id(col, dtype: T.DataType = T.StringType(), allow_scalar: bool = False) -> Column:
    """X1 (``allow_scalar=False``) / X2 (``allow_scalar=True``): relation -> bigint id.

    X1: list -> ``int(first)``; list text -> parsed then ``int(first)``;
    other text -> ``int(float(text))``; a bare number -> null.
    X2: list first element kept as is, then typed as a nullable integer (so
    ``5.7`` -> null, ``"5"`` -> 5); a bare number is accepted.
    """
    c = _c(col)
    if isinstance(dtype, T.StructType):
        return c.getField(dtype.fieldNames()[0]).try_cast("bigint")
    if isinstance(dtype, T.ArrayType):
        first = F.get(c, 0)
        if allow_scalar:
            return integral_or_null(parse_number(first.cast("string")))
        if isinstance(dtype.elementType, T.StringType):
            return int_text(first)
        return truncate_float_text(first.cast("string"))
    if isinstance(dtype, _NUMERIC):
        if not allow_scalar:
            return F.lit(None).cast("bigint")
        return let(c.cast("double"),
                   lambda v: F.when((v != 0) & ~F.isnan(v), v.try_cast("bigint")))
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("bigint")

    convert = _token_numeric_id if allow_scalar else _token_int
    return let(_first(c), lambda f: (
        F.when(f != "", convert(f))
        .when(_is_marker(c), F.lit(None).cast("bigint"))
        .when(c.rlike(rf"^{WS_CLASS}*+\["), F.lit(None).cast("bigint"))
        .otherwise(truncate_float_text(c))))


@memo_by_name
def m2o_name(col, dtype: T.DataType = T.StringType()) -> Column:
    """Relation -> display name ``str(second element)``, or null.

    Text is parsed only when it starts with ``[`` (no stripping).
    """
    c = _c(col)
    if isinstance(dtype, T.StructType):
        return c.getField(dtype.fieldNames()[1]).cast("string")
    if isinstance(dtype, T.ArrayType):
        return F.when(F.size(c) > 1, F.coalesce(F.get(c, 1).cast("string"), F.lit("None")))
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("string")
    return let(F.regexp_extract(c, LIST_SECOND, 1),
               lambda s: F.when(s != "", _token_text(s)))


@memo_by_name
def m2o_list_name(col, dtype: T.DataType = T.StringType(), none_as_text: bool = False) -> Column:
    """Name (second element) of a real list only -- a JSON list as landed.

    Python-repr text is *not* parsed. ``none_as_text`` renders a null name as
    "None" (the invoice variant applies ``str``).
    """
    c = _c(col)
    if isinstance(dtype, T.StructType):
        return c.getField(dtype.fieldNames()[1]).cast("string")
    if isinstance(dtype, T.ArrayType):
        v = F.get(c, 1).cast("string")
        return F.when(F.size(c) > 1, F.coalesce(v, F.lit("None")) if none_as_text else v)
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("string")
    conv = _token_text if none_as_text else _token_value
    return let(_json_group(c, 2), lambda s: F.when(s != "", conv(s)))


@memo_by_name
def m2o_list_id(col, dtype: T.DataType = T.StringType()) -> Column:
    """First element of a real list as a nullable id, else null."""
    c = _c(col)
    if isinstance(dtype, T.StructType):
        return c.getField(dtype.fieldNames()[0]).try_cast("bigint")
    if isinstance(dtype, T.ArrayType):
        return integral_or_null(parse_number(F.get(c, 0).cast("string")))
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("bigint")
    return let(_json_group(c, 1), lambda f: F.when(f != "", _token_numeric_id(f)))


# Lower-cased texts the exception normaliser maps to "".
EXCEPTION_MARKERS = ["false", "none", "nan"]


@memo_by_name
def exception_label(col, dtype: T.DataType = T.StringType()) -> Column:
    """Order exception. List -> its name (or only element); markers -> "";
    any other text kept as it is (even list-looking text)."""
    c = _c(col)
    if isinstance(dtype, T.ArrayType):
        n = F.size(c)
        return (F.when(c.isNull(), F.lit(""))
                .when(n > 1, F.coalesce(F.get(c, 1).cast("string"), F.lit("None")))
                .when(n == 1, F.coalesce(F.get(c, 0).cast("string"), F.lit("None")))
                .otherwise(F.lit("[]")))
    s = c.cast("string")
    parts = F.array(F.regexp_extract(s, JSON_LIST, 1), F.regexp_extract(s, JSON_LIST, 2),
                    F.when(s.rlike(JSON_LIST), F.lit("1")).otherwise(F.lit("")))
    return let(parts, lambda p: (
        F.when(c.isNull(), F.lit(""))
        .when(p[1] != "", _token_text(p[1]))
        .when(p[0] != "", _token_text(p[0]))
        .when(p[2] != "", F.lit("[]"))
        .when(F.lower(s).isin(*EXCEPTION_MARKERS), F.lit(""))
        .otherwise(s)))


def parse_list(text: Column, strict: bool = False, element: str = "string") -> Column:
    """Text -> ``array<element>`` via the JSON reader (lists of ids, pairs).

    ``strict`` accepts only JSON starting with ``[`` (a list as landed);
    otherwise single-quoted Python lists parse too.
    """
    schema = f"array<{element}>"
    if strict:
        return F.when(text.startswith("["), F.from_json(text, schema, _STRICT_JSON))
    return F.from_json(text, schema)


def _python_words(s: Column) -> Column:
    """Python's keywords as list elements -> JSON's; a text without any is not searched for their places."""
    out = s
    for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
        out = F.regexp_replace(out, rf"(?<=[\[,]\s{{0,4}}){word}(?=\s*[,\]])", json)
    return F.when(s.contains("None") | s.contains("True") | s.contains("False"), out).otherwise(s)


def tag_ids(col, dtype: T.DataType = T.StringType()) -> Column:
    """Many2many id list -> ``array<bigint>`` (null when not a list); an element that is no id is null."""
    c = _c(col)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: x.try_cast("bigint"))
    s = c.cast("string")
    items = F.when(s.startswith("["), parse_list(_python_words(s)))
    return F.transform(items, lambda x: x.try_cast("double").try_cast("bigint"))


def tag_names(col, tag_map: dict, dtype: T.DataType = T.StringType()) -> Column:
    """X8 with a small literal map: ids -> names joined by ", ".

    Order kept; unknown ids and empty names dropped; no list -> "".
    For a tag *table* see ``operators.lookup.tag_names_from_table``.
    """
    if not tag_map:
        return F.lit("")
    ids = tag_ids(col, dtype)
    m = F.create_map(*[x for k, v in tag_map.items() for x in (F.lit(int(k)), F.lit(str(v)))])
    names = F.transform(ids, lambda x: F.try_element_at(m, x))
    kept = F.filter(names, lambda n: n.isNotNull() & (n != F.lit("")))
    return F.coalesce(F.array_join(kept, ", "), F.lit(""))


@memo_by_name
def m2m_names(col, dtype: T.DataType = T.StringType()) -> Column:
    """List of ``[id, name]`` pairs -> names joined by "," ; none -> null."""
    c = _c(col)
    if isinstance(dtype, T.ArrayType):
        pairs = c
    else:
        s = c.cast("string")
        items = F.when(~_is_marker(s) & s.startswith("["), parse_list(_python_words(s)))
        # an element that is no pair drops out, the others stay
        pairs = F.transform(items, lambda x: F.when(x.startswith("["), parse_list(x)))
    return let(pairs, lambda ps: let(
        F.transform(F.filter(ps, lambda p: F.size(p) > 1),
                    lambda p: F.coalesce(F.get(p, 1), F.lit("None"))),
        lambda names: F.when(F.size(names) > 0, F.array_join(names, ","))))


@memo_by_name
def list_length(col, dtype: T.DataType = T.StringType()) -> Column:
    """Length of a real list, 0 for anything else."""
    c = _c(col)
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.size(c), F.lit(0))
    return let(parse_list(c.cast("string"), strict=True),
               lambda a: F.when(a.isNull(), F.lit(0)).otherwise(F.size(a)))


__all__ = ["RELATION_MARKERS", "EXCEPTION_MARKERS", "LIST_FIRST", "LIST_SECOND", "JSON_LIST",
           "m2o_id", "m2o_name", "m2o_list_name", "m2o_list_id", "exception_label",
           "parse_list", "tag_ids", "tag_names", "m2m_names", "list_length", "strip_ws"]

"""Shared building blocks for the column normalisers.

Catalyst copies a sub-expression into every place that uses it, and the
normalisers use their parsed token several times -- a regex would run once per
copy. ``let`` binds the token: used as a column it is a lambda variable
(``transform(array(x), f)[0]``); ``with_columns_once`` takes it apart and puts
the token into a select of its own and the conversion into the next, which stays
in generated code.
"""

from __future__ import annotations

import functools
from typing import Callable

from pyspark.sql import Column, functions as F

# Python's whitespace (what ``str.strip()`` removes), computed from Python's
# own definition: Unicode White_Space plus the ASCII separators \x1c-\x1f.
WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# The same set as a Java regex character class (``\x{h}`` escapes).
WS_CLASS = "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in WS_CHARS) + "]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and evaluate ``body(value)``. The result remembers both."""
    out = F.get(F.transform(F.array(value), body), 0)
    out._let = (value, body)
    return out


def then(c: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(c)``, keeping what ``let`` bound."""
    bound = c.__dict__.get("_let")  # a plain attribute access would be a field of the column
    if bound:
        value, body = bound
        return let(value, lambda v: fn(body(v)))
    return fn(c)


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove Python whitespace at both ends (no regex)."""
    return F.btrim(col(c), F.lit(WS_CHARS))


def with_columns_once(df, cols: dict, keys=()):
    """Add ``cols`` (name -> Column), each parsed once per row.

    Tokens come in one select, conversions in the next: Catalyst does not merge
    two selects when that would copy an expensive expression, and it prunes the
    tokens of columns that nobody uses. Filters and join keys are another
    matter: Catalyst pushes them below selects by copying. So the tokens of the
    columns named in ``keys`` (those that a later filter or join reads) are made in a
    one-element ``inline`` generator, which predicates cannot cross; filters on them then
    run before the other columns are parsed. One output row per input row --
    nothing is dropped or duplicated.
    """
    if not cols:
        return df
    keep = df.columns
    token = {n: f"__token_{n}" for n in cols}
    bound = {n: c.__dict__.get("_let", (c, lambda v: v)) for n, c in cols.items()}
    first = [bound[n][0].alias(token[n]) for n in cols if n in keys]
    if first:
        df = df.select("*", F.inline(F.array(F.struct(*first))))
    rest = [bound[n][0].alias(token[n]) for n in cols if n not in keys]
    if rest:
        df = df.select("*", *rest)
    return df.select(*[F.col(f"`{c}`") for c in keep], *[bound[n][1](F.col(token[n])).alias(n) for n in cols])


def memo_by_name(fn):
    """Memoise a normaliser called with a column *name*.

    The normalisers are pure: the same (name, type, options) always builds
    the same unresolved expression, and an unresolved Column can be reused in
    any plan. Building one costs hundreds of Python -> JVM calls (the lambda
    variables of ``let`` in particular), so repeated builds -- one job run
    per month, several plans over one raw table -- reuse the first. Column
    objects passed in (not names) are never cached.
    """
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(col, *args, **kwargs):
        if not isinstance(col, str):
            return fn(col, *args, **kwargs)
        key = (col, tuple(a.simpleString() if hasattr(a, "simpleString") else a for a in args),
               tuple(sorted((k, v.simpleString() if hasattr(v, "simpleString") else v)
                            for k, v in kwargs.items())))
        hit = cache.get(key)
        if hit is None:
            hit = cache[key] = fn(col, *args, **kwargs)
        return hit

    return wrapper

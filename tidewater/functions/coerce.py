"""Scalar coercion rules as ``Column -> Column`` functions.

All are built-in expressions (whole-stage codegen, no Python). Inputs are raw
JSON scalars read as STRING; anything that does not parse becomes NULL, never
an error, so the rules are safe with ANSI mode on. Timestamp rules assume the
session time zone is UTC (``tidewater.session.ensure_session_defaults``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prefix ad-account ids carry in the API.
ACCOUNT_PREFIX = "act_"
# letters that no number ends with, whatever its spelling
_NEVER_LAST = [c for c in "abcdeghijklmopqrstuvwxzABCDEGHIJKLMOPQRSTUVWXZ"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """NULL for NULL or the empty string."""
    c = _c(c)
    return F.when(c != F.lit(""), c)


def truthy(c: Column | str) -> Column:
    """Python truthiness of a text scalar: not NULL and not ``""``."""
    c = _c(c)
    return c.isNotNull() & (c != F.lit(""))


def truthy_or(a: Column | str, b: Column | str) -> Column:
    """``a or b`` for text: an empty string counts as missing (SC-10)."""
    return F.coalesce(blank_to_null(a), _c(b))


def bare_account_id(c: Column | str) -> Column:
    """Strip one leading ``act_`` (SC-1). ``act_1act_2`` -> ``1act_2``."""
    return F.regexp_replace(_c(c).cast("string"), F.lit("^" + ACCOUNT_PREFIX), F.lit(""))


def as_long(c: Column | str) -> Column:
    return _c(c).try_cast("bigint")


def as_int(c: Column | str) -> Column:
    """``int(x)`` on text (SC-3): ``"3.7"``, ``""``, junk and overflow give NULL."""
    return _c(c).try_cast("int")


def as_bool(c: Column | str) -> Column:
    return _c(c).try_cast("boolean")


def as_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Money and rates are stored as received, rounded to the column scale."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def number_keep_nan(c: Column | str) -> Column:
    """``float(x)`` on text; NaN stays NaN. Spark also accepts a ``d``/``f``
    suffix (``'12d'``) that Python rejects, so such text is NULL here."""
    s = _c(c).cast("string")
    t = F.rtrim(s)
    # cheap character tests instead of a regex per value: last char d/D/f/F
    # preceded by a digit or '.' (so 'inf' still parses). Other text that ends with a
    # letter no number ends with (nan, inf, infinity) is told apart before
    # the cast, which would make an exception of each such value
    last = F.right(t, F.lit(1))
    suffixed = last.isin("f", "F") & F.substring(t, -2, 1).isin(*list("0123456789."))
    return F.when(~(last.isin(*_NEVER_LAST) | suffixed), s.try_cast("double"))


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL before load (SC-12)."""
    c = _c(c)
    return F.when(~F.isnan(c), c)


def as_number(c: Column | str) -> Column:
    """SC-4/SC-5: numeric text -> double, anything else (objects, junk, NaN) NULL."""
    return nan_to_null(number_keep_nan(c))


def as_datetime(c: Column | str) -> Column:
    """SC-2: all-digit text is epoch seconds; other text is parsed with its
    offset, converted to UTC and stored as naive UTC (timestamp_ntz)."""
    s = blank_to_null(_c(c).cast("string"))
    # epoch seconds fit in 12 digits; the regex only runs on short strings
    parsed = F.when(
        (F.length(s) <= 12) & s.rlike(r"^[0-9]+$"),
        F.timestamp_seconds(F.when(s.try_cast("bigint") <= F.lit(253402300799), s.try_cast("bigint"))),
    ).otherwise(s.try_cast("timestamp"))
    return parsed.cast("timestamp_ntz")


def as_date(c: Column | str) -> Column:
    """SC-7: parse -> UTC -> date. Unlike ``as_datetime``, ``yyyyMMdd`` text is
    a calendar date, not epoch seconds."""
    s = blank_to_null(_c(c).cast("string"))
    compact = F.when((F.length(s) == 8) & s.rlike(r"^[0-9]{8}$"),
                     F.to_date(F.try_to_timestamp(s, F.lit("yyyyMMdd"))))
    return F.coalesce(compact, F.to_date(s.try_cast("timestamp")))


def date_key(d: Column | str) -> Column:
    """SC-8: date -> yyyymmdd int, arithmetic (no string formatting)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def as_json_text(c: Column | str, source: Column | str | None = None, key: str | None = None) -> Column:
    """SC-6: JSON text of a nested field, with NULL for ``""``, ``[]`` and ``{}``.

    The raw schema declares the field STRING, so ``from_json`` already yields
    the compact source text of objects and arrays (key order and number
    spelling kept). A JSON *string* scalar arrives unquoted that way; given the
    enclosing JSON text (``source``) and the field name, such a value is
    re-quoted, as ``json.dumps`` would write it. The check runs only for
    values that are not an object or array.
    """
    s = _c(c)
    empty = s.isin("", "[]", "{}")
    if source is None or key is None:
        return F.when(~empty, s)
    scalar = ~(s.startswith("[") | s.startswith("{"))
    is_string = _c(source).rlike('"' + re.escape(key) + r'"\s*:\s*"')
    literal = F.to_json(F.array(s))
    quoted = literal.substr(F.lit(2), F.length(literal) - 2)
    return F.when(empty, F.lit(None).cast("string")).when(scalar & is_string, quoted).otherwise(s)


def epoch_seconds(ts: Column | str) -> Column:
    """SC-13: epoch seconds of a naive-UTC timestamp."""
    return F.unix_seconds(_c(ts).cast("timestamp"))

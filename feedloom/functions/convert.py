"""Null-safe value converters (D1-D4), Column -> Column.

Each converter maps every unparseable input to NULL instead of failing, as
the mapped ingest does. They use ``try_cast`` (ANSI mode is on) and regex
guards so that Spark accepts exactly the number syntax Python's
``Decimal`` accepts (no ``10D`` / ``0x1p3`` suffix forms, underscores
allowed anywhere).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import SPACE
from .text import _c, is_blank, strip_u

# Texts (stripped, lower-cased) that mean true / false.
TRUE_WORDS = ("y", "yes", "true", "1", "included", "include", "t")
FALSE_WORDS = ("n", "no", "false", "0", "not included", "exclude", "f")

# A range such as "120 - 277" keeps the text before its first dash.
RANGE_PATTERN = rf"\p{{Nd}}[{SPACE}]*-[{SPACE}]*\p{{Nd}}"
# Python ``Decimal`` syntax after underscores are dropped, plus the
# infinity words (which ``try_cast`` understands).
DECIMAL_SYNTAX = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"
INT_PATTERN = r"-?[0-9]+"


def to_decimal(c) -> Column:
    """``$1,234.50`` -> 1234.5, ``120 - 277`` -> 120.0, junk -> NULL.

    For a range, the text before the first ``-`` is kept (the first element
    of a split on ``\\s*-\\s*``, whose trailing spaces the strip removes).
    """
    col = _c(c)
    s = F.regexp_replace(strip_u(col), r"[$,]", "")
    s = strip_u(F.when(s.rlike(RANGE_PATTERN), F.substring_index(s, "-", 1)).otherwise(s))
    s = F.regexp_replace(s, "_", "")
    return F.when(~is_blank(col) & s.rlike(DECIMAL_SYNTAX), s.try_cast("double"))


def to_money(c) -> Column:
    """Money uses the decimal rules."""
    return to_decimal(c)


def to_int(c) -> Column:
    """D3: first ``-?[0-9]+`` anywhere (``22W`` -> 22, ``CRI-90`` -> -90)."""
    col = _c(c)
    m = F.regexp_extract(strip_u(col), INT_PATTERN, 0)
    return F.when(~is_blank(col) & (m != F.lit("")), m.try_cast("bigint"))


def to_bool(c) -> Column:
    """yes/no words to boolean, anything else NULL."""
    s = F.lower(strip_u(_c(c)))
    return F.when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False))


def number_text(c: Column, sql_type: str) -> Column:
    """A converted value as Python's ``str`` writes it: ``12345678.0``, never in
    Java's ``1.2345678E7`` form; booleans as ``True`` / ``False``. Doubles from
    1e16 on have an exponent in Python too (``1e+16``)."""
    if sql_type == "boolean":
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if sql_type != "double":
        return c.cast("string")
    plain = (c == 0) | ((F.abs(c) >= 1e-4) & (F.abs(c) < 1e16))
    digits = F.regexp_replace(c.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    short = F.regexp_replace(c.cast("string"), r"(?:\.0)?E", "e")
    signed = F.regexp_replace(short, r"e(\d)", "e+$1")
    return F.when(plain, F.regexp_replace(digits, r"\.$", ".0")).otherwise(F.regexp_replace(signed, r"e-(\d)$", "e-0$1"))


# Conversion kinds of a mapping's ``conversions`` block, in application order.
CONVERTERS = {
    "money": to_money,
    "decimals": to_decimal,
    "int": to_int,
    "bool": to_bool,
}

CONVERTED_TYPES = {"money": "double", "decimals": "double", "int": "bigint", "bool": "boolean"}

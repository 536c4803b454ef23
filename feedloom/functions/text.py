"""Null-safe text helpers shared by every layer (Column -> Column).

All helpers are built-in Spark SQL expressions, so they stay inside
whole-stage codegen. Python-compatible Unicode semantics are kept where
it matters: ``strip`` removes the same characters as ``str.strip()``, and
patterns are written with Python's classes (``functions.patterns``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point for which Python's ``str.isspace()`` is true, derived by
# rule at import time; ``btrim`` with this set matches ``str.strip()``.
PY_WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Source-level missing-value tokens of a spreadsheet parse with
# default NA handling (exact, case-sensitive; blanks with spaces are values).
SOURCE_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Lower-cased, stripped texts that the converters treat as blank.
BLANK_TOKENS = ("", "nan", "none", "null", "n/a", "na", "-", "—")

# Lower-cased, stripped texts that raw landing turns into NULL.
RAW_NULL_TOKENS = ("nan", "none", "n/a", "na", "null")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_u(c) -> Column:
    """``str(v).strip()`` for a string column: Unicode whitespace, both ends."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def has_text(c) -> Column:
    """True when the value is not null and not whitespace-only (never null)."""
    s = strip_u(c)
    return F.coalesce(s != F.lit(""), F.lit(False))


def is_blank(c) -> Column:
    """Converter blank predicate: null, empty, or a blank token (any case)."""
    s = F.lower(strip_u(c))
    return F.coalesce(s.isin(*BLANK_TOKENS), F.lit(True))


def source_na(c) -> Column:
    """Null out spreadsheet NA tokens right after a scan (exact match)."""
    col = _c(c)
    return F.when(~col.isin(*SOURCE_NA_TOKENS), col)


def clean_text(c) -> Column:
    """Raw-landing cell text: stripped, with empty/NA-like words as NULL."""
    s = strip_u(c)
    return F.when((s != F.lit("")) & ~F.lower(s).isin(*RAW_NULL_TOKENS), s)

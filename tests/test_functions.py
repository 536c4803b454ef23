"""Golden scalar values (FIXTURES §3) and properties of the Column functions."""
import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from feedloom.functions.convert import to_bool, to_decimal, to_int
from feedloom.functions.headers import norm_header, norm_header_py, norm_header_raw, shorten_identifier
from feedloom.functions.text import clean_text, has_text, is_blank, source_na, strip_u

NULL = None
GOLDEN = [
    # input, to_decimal, to_int, to_bool
    ("$1,234.50", 1234.5, 1, NULL), ("120 - 277", 120.0, 120, NULL), ("2700-3000-3500", 2700.0, 2700, NULL),
    ("22W", NULL, 22, NULL), ("-5-10", NULL, -5, NULL), ("1.5-2.5", 1.5, 1, NULL), ("CRI-90", NULL, -90, NULL),
    ("1e3", 1000.0, 1, NULL), ("1_000", 1000.0, 1, NULL), ("10D", NULL, 10, NULL), (".5", 0.5, 5, NULL),
    ('12"', NULL, 12, NULL), ("1", 1.0, 1, True), ("0", 0.0, 0, False), (" Yes ", NULL, NULL, True),
    ("N", NULL, NULL, False), ("Not Included", NULL, NULL, False), ("maybe", NULL, NULL, NULL),
    ("", NULL, NULL, NULL), ("  ", NULL, NULL, NULL), ("N/A", NULL, NULL, NULL), ("-", NULL, NULL, NULL),
    ("—", NULL, NULL, NULL), ("None", NULL, NULL, NULL), (None, NULL, NULL, NULL),
    ("2024-01-15", 2024.0, 2024, NULL), ("Infinity", float("inf"), NULL, NULL),
]


def test_converters_golden(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "v string")
    got = df.select(to_decimal("v"), to_int("v"), to_bool("v")).collect()
    for (v, d, i, b), row in zip(GOLDEN, got):
        assert tuple(row) == (d, i, b), v


HEADERS = [
    ("  Fixture   Width ", "fixture_width", "fixture_width"),
    ("Prod. Width(Inches)", "prod_widthinches", "prod_widthinches"),
    ("A - B", "a_b", "a_b"),
    ("shipping_single__height", "shipping_single_height", "shipping_single_height"),
    ("Höhe (in)", "höhe_in", "höhe_in"),
    ("#", "", "col"),
    (None, "", "col"),
]


def test_headers_golden(spark):
    df = spark.createDataFrame([(h[0],) for h in HEADERS], "h string")
    got = df.select(norm_header("h"), norm_header_raw("h")).collect()
    for (h, mapped, raw), row in zip(HEADERS, got):
        assert tuple(row) == (mapped, raw), h
        assert norm_header_py(h) == mapped


def test_long_header_hash(spark):
    long = "x" * 130
    want = "x" * 111 + "_" + hashlib.sha1(long.encode()).hexdigest()[:8]
    got = spark.createDataFrame([(long,)], "h string").select(shorten_identifier(norm_header_raw("h"))).first()[0]
    assert got == want
    assert len(got) == 120


def test_text_predicates(spark):
    vals = ["", "  ", " x　", "N/A", "na", "-", "—", "NULL", "value", None, "nan"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    rows = df.select(strip_u("v"), has_text("v"), is_blank("v"), clean_text("v"), source_na("v")).collect()
    assert [r[0] for r in rows] == ["", "", "x", "N/A", "na", "-", "—", "NULL", "value", None, "nan"]
    assert [r[1] for r in rows] == [False, False, True, True, True, True, True, True, True, False, True]
    assert [r[2] for r in rows] == [True, True, False, True, True, True, True, True, False, True, True]
    # raw landing keeps "-" but drops NA words
    assert [r[3] for r in rows] == [None, None, "x", None, None, "-", "—", None, "value", None, None]
    # source NA tokens are exact and case-sensitive: "na" and "-" survive
    assert [r[4] for r in rows] == [None, "  ", " x　", None, "na", "-", "—", None, "value", None, None]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=20))
def test_normalise_idempotent_and_matches_python(spark, headers):
    df = spark.createDataFrame([(h,) for h in headers], "h string")
    rows = df.select(norm_header("h").alias("a"), norm_header(norm_header("h")).alias("b"),
                     norm_header_raw("h").alias("r")).collect()
    for h, r in zip(headers, rows):
        assert r.a == r.b
        if h.isascii():
            assert r.a == norm_header_py(h)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["$1,200", "12.5", " 3 - 4 ", "abc", "-", "1e2", "7W", "yes", "0", ""]), min_size=1, max_size=15))
def test_converters_never_fail(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert df.select(to_decimal("v"), to_int("v"), to_bool("v")).count() == len(vals)


def test_number_text_is_pythons(spark):
    from feedloom.functions.convert import number_text

    vals = [12345678.0, 0.5, -3.0, 1e15, 123456789012345680.0, 1e16, 1.5e-7, 1e22, 2.5e300, 0.1, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r[0] for r in df.select(number_text(df.v, "double")).collect()] == [str(v) for v in vals]


def _python_header(c):
    """B1 as its steps on one name."""
    import re

    s = re.sub(r"[^\w\s]", "", re.sub(r"\s+", " ", c.strip().lower())).replace(" ", "_")
    return re.sub("_+", "_", s).strip("_")


def _python_raw_header(c):
    import re

    s = re.sub(r"[^\w]", "", re.sub(r"\s+", "_", c.strip().lower()))
    return re.sub("_+", "_", s).strip("_") or "col"


def test_headers_of_every_character(spark):
    """Space and word characters as Python sees them, between and around letters;
    characters that only one side's Unicode version knows are left out."""
    import unicodedata

    points = [c for c in range(0x20000) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    rows = [(f"A{chr(c)}b {chr(c)}",) for c in points]
    rows += [("0\x1f0",), ("Cafe\u0301 Price",), ("\x1c a \u2028b\x85",), ("x" * 8 + "\u200b",)]
    df = spark.createDataFrame(rows, "h string").repartition(4)
    got = df.select("h", norm_header("h").alias("a"), norm_header_raw("h").alias("r")).collect()
    wrong = [r.h for r in got if r.a != _python_header(r.h) or r.r != _python_raw_header(r.h) or norm_header_py(r.h) != _python_header(r.h)]
    known = spark._jvm.java.lang.Character
    wrong = [h for h in wrong if known.isDefined(ord(h[1]))]
    assert [hex(ord(h[1])) for h in wrong] == []

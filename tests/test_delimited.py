"""Delimited files against Python's csv module, cut into parts of a few bytes."""
import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators.landing import detect_header, raw_landing
from feedloom.plans.ingest import ingest_delimited
from feedloom.sources import delimited as T


@pytest.fixture
def small_parts(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "23")
    spark.conf.set(keys[1], "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _read(text, sep=","):
    """Rows of (record number, fields) as Python's csv reads them, blank ones left out."""
    return [(i, r) for i, r in enumerate(csv.reader(io.StringIO(text, newline=""), delimiter=sep)) if r]


def _files(rng, folder, count, sep=","):
    pieces = ["a", "b c", "12\" blade", "", '"q"', '"x' + sep + 'y"', '"two\nlines"', '"say ""hi"""', '"a\n\n""b""' + sep + '\nc"', "é", '"tail"x', "1", "-2.5", "\"\""]
    texts = {}
    for k in range(count):
        rows = [sep.join(rng.choice(pieces) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 30))]
        text = "".join(r + rng.choice(["\n", "\n", "\r\n"]) for r in rows)
        text = text if rng.random() < 0.7 else text.rstrip("\r\n")
        name = f"f{k}.csv"
        with open(f"{folder}/{name}", "w", newline="") as fh:
            fh.write(text)
        texts[name] = text
    return texts


@pytest.mark.parametrize("sep", [",", "\t", "|"])
def test_cells_equal_python_csv(spark, tmp_path, small_parts, sep):
    texts = _files(random.Random(ord(sep)), tmp_path, 12, sep)
    cells = T.delimited_cells(spark, str(tmp_path), sep, typed=False).collect()
    for name, text in texts.items():
        got = {}
        for c in cells:
            if c.file_name == name:
                got.setdefault(c.row_idx, {})[c.col_idx] = c.text or ""
        want = {i: dict(enumerate(r)) for i, r in _read(text, sep)}
        assert got == want, text
    parts = T.numbered_lines(spark, str(tmp_path), T.Syntax(sep)).select("file_path", "block").distinct().count()
    assert parts > 3 * len(texts)


def test_kinds_bom_and_open_quote(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "MAX_RECORD_LINES", 5)
    (tmp_path / "a.csv").write_text("﻿name,n\nx,1.5\ny,\n\nz,1e5\n")
    (tmp_path / "bad.csv").write_text('name,n\nx,"never closed\n' + "l\n" * 9)
    got = {(r.file_name, r.row_idx, r.col_idx): (r.kind, r.text) for r in T.delimited_cells(spark, str(tmp_path)).collect()}
    assert got.pop(("bad.csv", None, None)) == ("fatal", "Fatal error: record 1 has more than 5 lines; a quote is not closed")
    assert got == {("a.csv", 0, 0): ("s", "name"), ("a.csv", 0, 1): ("s", "n"), ("a.csv", 1, 0): ("s", "x"), ("a.csv", 1, 1): ("n", "1.5"),
                   ("a.csv", 2, 0): ("s", "y"), ("a.csv", 2, 1): (None, None), ("a.csv", 4, 0): ("s", "z"), ("a.csv", 4, 1): ("s", "1e5")}
    with pytest.raises(ValueError):
        T.delimited_cells(spark, str(tmp_path), ",,")


def test_landing_and_mapped_ingest_of_csv(spark, tmp_path, small_parts):
    body = "".join(f'P{i},"Fan, {i}""\nwhite",{i}.50\n' for i in range(30))
    (tmp_path / "acme_1.csv").write_text("Price list 2026,,\n,,\nItem No,Description,Price\n" + body)
    (tmp_path / "acme_2.CSV").write_text('Item No,Description,Price\nQ1,"open\n')
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    os.makedirs(tmp_path / "sub")
    cells = T.delimited_cells(spark, f"{tmp_path}/acme_1.csv")
    assert [(r.header_row, r.width) for r in detect_header(cells).collect()] == [(2, 3)]
    landed = raw_landing(cells)["landing"].filter("stored_column_name = 'description'").orderBy("source_row_number").collect()
    assert [r.value for r in landed] == [f'Fan, {i}"\nwhite' for i in range(30)]
    cfg = {"vendor_code": "Acme", "file_match": ["acme"], "sheets": [{"sheet_name": "DATA", "header_row": 2}], "category": {"default": "lighting"},
           "column_map": {"core": {"inventory_partno": ["item_no"], "wholesale_price": ["price"]}}, "conversions": {"money": ["wholesale_price"]}}
    out = ingest_delimited(spark, str(tmp_path), [cfg])
    core = {r.inventory_partno: r.wholesale_price for r in out["core"].collect()}
    assert core == {f"P{i}": i + 0.5 for i in range(30)}
    status = {r.file: r.status for r in out["report"].collect()}
    assert status["acme_1.csv"] == "ok" and status["other.csv"] == "skipped"
    assert out["core"].filter(F.col("source_row_number") < 0).count() == 0


def test_very_long_field_and_line(spark, tmp_path):
    long = '"' + 'x""y\n' * 3000 + "z" * 300_000 + '"'
    (tmp_path / "a.csv").write_text("h,i\n" + long + ",1\n" + "p" * 400_000 + ",2\n")
    got = {(r.row_idx, r.col_idx): r.text for r in T.delimited_cells(spark, str(tmp_path)).collect()}
    assert got[1, 0] == 'x"y\n' * 3000 + "z" * 300_000 and got[1, 1] == "1" and got[2, 0] == "p" * 400_000 and len(got) == 6

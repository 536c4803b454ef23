"""Workbook source, workbook ingest end to end, drop-folder streams, sinks."""
import os

import pytest

from feedloom.config import sheet_rules_df
from feedloom.operators.validate import missing_key_sample
from feedloom.plans.ingest import ingest_workbooks
from feedloom.sources import sinks
from feedloom.sources.xlsx import iter_cells, mapped_rows, read_cells, workbook_bytes
from feedloom.streaming import drop_folder as D

CFG = {
    "vendor_code": "Acme", "file_match": ["acme_"], "sheets": [{"sheet_name": "DATA", "header_row": 1}, {"sheet_name": "Missing"}],
    "category": {"strategy": "layered", "default": "lighting",
                 "column_value": {"columns": ["type"], "mappings": {"fans": ["fan"], "accessories": ["remote"]}},
                 "feature_presence": {"rules": [{"category_type": "fans", "if_any_field_present": ["rotor"]}]}},
    "column_map": {"core": {"inventory_partno": ["item_no"], "wholesale_price": ["price"]}, "fans": {"style": ["style"]}},
    "conversions": {"money": ["wholesale_price"]},
}


def _book(rows, other=True):
    cells = []
    for r, vals in enumerate(rows):
        for c, v in enumerate(vals):
            if v is None:
                continue
            kind = "n" if isinstance(v, (int, float)) else "s"
            cells.append((r, c, kind, str(v)))
    return workbook_bytes({"DATA": cells} | ({"Other": [(0, 0, "s", "ignored")]} if other else {}))


def test_iter_cells_renders_like_the_sheet_parse():
    data = workbook_bytes({"S": [(0, 0, "s", "a"), (0, 1, "n", "12.0"), (1, 27, "n", "1.5"), (2, 0, "b", "True")]})
    assert list(iter_cells(data)) == [("S", 0, 0, 0, "s", "a"), ("S", 0, 0, 1, "n", "12"),
                                      ("S", 0, 1, 27, "n", "1.5"), ("S", 0, 2, 0, "b", "True")]


def test_workbook_ingest_end_to_end(spark, tmp_path):
    d = tmp_path / "in"
    (d / "sub").mkdir(parents=True)
    (d / "archive").mkdir()
    (d / "acme_1.xlsx").write_bytes(_book([["Price list"], ["Item No", "Type", "Price", "Style"],
                                           ["A1", "Fan", "$1,200.50", "modern"], [0, "remote", "5", None],
                                           [None, "fan", "1", None]]))
    (d / "sub" / "acme_2.XLSX").write_bytes(_book([["t"], ["Item No", "Type", "Price", "Rotor size"], ["A1", "fan", "7", None], ["K2", "x", "1", "9"]]))
    (d / "~$acme_3.xlsx").write_bytes(b"lock")
    (d / "archive" / "acme_old.xlsx").write_bytes(b"corrupt, but excluded")
    (d / "acme_bad.xlsx").write_bytes(b"not a workbook")
    (d / "acme_old.xls").write_bytes(b"\xd0\xcf\x11\xe0 binary")
    (d / "other.xlsx").write_bytes(b"corrupt, but matched by no mapping")
    out = ingest_workbooks(spark, str(d), [CFG], exclude_dirs=[str(d / "archive")])
    core = {r.inventory_partno: r for r in out["core"].collect()}
    assert set(core) == {"A1", "K2"}                 # numeric 0 key -> error, blank key -> skipped
    assert core["A1"].wholesale_price == 7.0         # sub/acme_2 sorts after acme_1: last write wins
    assert core["A1"].source_file_name == "acme_2.XLSX"
    assert core["K2"].category_type == "fans"        # a column that no alias names decides by its presence
    assert sorted(r.status for r in out["rows"].collect()) == ["error", "ok", "ok", "ok", "skipped"]
    files = {r.file: (r.status, r.rows_total, r.run_status) for r in out["report"].collect()}
    assert files == {"acme_1.xlsx": ("ok", 3, "partial"), "acme_2.XLSX": ("ok", 2, "partial"), "other.xlsx": ("skipped", None, "partial"),
                     "acme_bad.xlsx": ("failed", None, "partial"), "acme_old.xls": ("failed", None, "partial")}
    reasons = {r.file: r.reason for r in out["report"].collect()}
    assert reasons["acme_bad.xlsx"].startswith("Fatal error: BadZipFile")
    assert [r.error_type for r in out["errors"].collect()] == ["ValueError"]
    assert sorted(r.style or "" for r in out["fans"].collect()) == ["", ""]     # the later fan row has no style: full overwrite


def test_drop_folder_runs_incrementally(spark, tmp_path):
    root = f"file://{tmp_path}"
    drop, snaps, ckpt, arch = f"{tmp_path}/drop", f"{root}/snap", f"{root}/ckpt", f"{tmp_path}/arch"
    os.makedirs(drop)

    def put(name, data):
        with open(f"{drop}/{name}", "wb") as fh:
            fh.write(data)

    put("acme_1.xlsx", _book([["t"], ["Item No", "Type", "Price"], ["A", "fan", "1"], ["B", "lamp", "2"], [None, "x", "y"]]))
    put("acme_bad.xlsx", b"broken")
    D.start(spark, drop, [CFG], snaps, ckpt, archive_dir=arch, buckets=4).awaitTermination()
    first = {r.inventory_partno: r.product_id for r in D.latest_snapshot(spark, snaps, ckpt)["core"].collect()}
    put("acme_2.XLSX", _book([["t"], ["Item No", "Type", "Price"], ["C", "fan", "3"], ["A", "fan", "9"]]))
    D.start(spark, drop, [CFG], snaps, ckpt, archive_dir=arch, buckets=4).awaitTermination()
    core = {r.inventory_partno: r for r in D.latest_snapshot(spark, snaps, ckpt)["core"].collect()}
    assert first == {"A": 1, "B": 2}
    assert {k: r.product_id for k, r in core.items()} == {"A": 1, "B": 2, "C": 3}
    assert core["A"].wholesale_price == 9.0 and core["A"].source_file_name == "acme_2.XLSX"
    report = {r.file: (r.status, r.rows_total) for r in spark.read.json(f"{snaps}/logs/batch=0/report").collect()}
    assert report == {"acme_1.xlsx": ("ok", 3), "acme_bad.xlsx": ("failed", None)}
    audit = spark.read.parquet(f"{snaps}/logs/batch=0/conversions").collect()
    assert [(r.field, r.value) for r in audit] == [("wholesale_price", "y")]
    put("acme_3.xlsx", _book([["t"], ["Item No"], ["D"]]))
    os.rename(f"{tmp_path}/snap/manifest/v=1", f"{tmp_path}/snap/manifest/gone")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):       # never merged into an empty target
        D.start(spark, drop, [CFG], snaps, ckpt, archive_dir=arch, buckets=4).awaitTermination()


def test_csv_drop_folder(spark, tmp_path):
    drop, root = f"{tmp_path}/drop", f"{tmp_path}/snap"
    os.makedirs(drop)
    with open(f"{drop}/acme_1.csv", "w") as fh:
        fh.write("n,Item No,Type,Price\n0,A,fan,1\n1,B,lamp,x\n2,,lamp,3\n")
    with open(f"{drop}/zzz.csv", "w") as fh:
        fh.write("n,Item No,Type,Price\n0,Q,fan,1\n")
    D.start_feed(spark, drop, [CFG], root, f"{tmp_path}/ckpt", "n long, `Item No` string, Type string, Price string", "csv", {"row": "n"},
                 {"header": "true"}, buckets=4).awaitTermination()
    core = D.latest_snapshot(spark, root, f"{tmp_path}/ckpt")["core"].collect()
    assert {(r.vendor_code, r.inventory_partno, r.wholesale_price) for r in core} == {("Acme", "A", 1.0), ("Acme", "B", None)}
    report = {r.file: (r.status, r.rows_total, r.rows_upserted) for r in spark.read.json(f"{root}/logs/batch=0/report").collect()}
    assert report == {"acme_1.csv": ("ok", 3, 2), "zzz.csv": ("skipped", None, None)}


def test_read_cells_sheet_filter_and_lock_files(spark, tmp_path):
    (tmp_path / "a.XLSM").write_bytes(_book([["h"], ["v"]]))
    (tmp_path / "~$a.xlsx").write_bytes(b"not a zip")
    cells = read_cells(spark, str(tmp_path), sheets=["DATA"])
    assert sorted((r.sheet_name, r.row_idx, r.text) for r in cells.collect()) == [("DATA", 0, "h"), ("DATA", 1, "v")]


def test_jdbc_options():
    opts = sinks.jdbc_options("jdbc:somedb://host/catalog", "staging.core_rows", user="u", batchsize=500)
    assert opts == {"url": "jdbc:somedb://host/catalog", "dbtable": "staging.core_rows", "batchsize": "500",
                    "isolationLevel": "READ_COMMITTED", "user": "u"}


CELLS = "file_path string, file_name string, file_seq string, sheet_name string, row_idx int, col_idx int, kind string, text string"


def _wide(spark, cells, columns, sheets=("DATA",), cfg=None):
    rows = [("/in/f.xlsx", "f.xlsx", "f", s, r, c, "s" if isinstance(v, str) else "n", str(v)) for s, r, c, v in cells]
    rules = sheet_rules_df(spark, [{"vendor_code": "V", "sheets": [{"sheet_name": s, "header_row": 0} for s in sheets]}])
    return mapped_rows(spark.createDataFrame(rows, CELLS), rules, columns, cfg)


def test_mapped_rows_keep_blank_rows_and_parse_names(spark):
    wide = _wide(spark, [("DATA", 0, 0, "Item No"), ("DATA", 0, 1, "Width"), ("DATA", 0, 2, "Width"), ("DATA", 0, 4, "Item  No"),
                         ("DATA", 1, 0, "A"), ("DATA", 1, 1, 3), ("DATA", 1, 2, 4), ("DATA", 1, 3, "x"), ("DATA", 3, 0, "B"), ("DATA", 3, 4, "b2")],
                 ["item_no", "width", "width1", "unnamed_3"])
    rows = {r._src_row: r for r in wide.collect()}
    assert sorted(rows) == [0, 1, 2]                     # the blank row 1 is kept
    assert rows[1].item_no is None and rows[1].width is None
    assert (rows[0].width, rows[0].width1, rows[0].unnamed_3) == ("3", "4", "x")
    assert rows[0].item_no == "A" and rows[2].item_no == "B"   # "Item No"/"Item  No" both normalise to item_no
    assert rows[0]._src_kind_item_no == "s" and rows[0]._src_kind_width == "n"
    assert list(rows[0]._src_columns) == ["item_no", "width", "width1", "unnamed_3", "item_no"]


def test_na_tokens_go_before_columns_are_folded(spark):
    wide = _wide(spark, [("DATA", 0, 0, "Item No"), ("DATA", 0, 1, "Item  No"), ("DATA", 1, 0, "N/A"), ("DATA", 1, 1, "P1")], ["item_no"])
    assert [r.item_no for r in wide.collect()] == ["P1"]


def test_missing_key_sample_of_two_sheets(spark):
    from feedloom.plans.ingest import canonical_rows, normalize_feed, probe_columns

    cfg = dict(CFG, sheets=[{"sheet_name": "S1"}, {"sheet_name": "S2"}])
    wide = _wide(spark, [("S1", 0, 0, "Zeta"), ("S1", 0, 1, "Model"), ("S1", 1, 0, "z"), ("S1", 1, 1, "m1"),
                         ("S2", 0, 0, "Model"), ("S2", 0, 1, "Alpha"), ("S2", 1, 0, "m2"), ("S2", 1, 1, "a")], ["item_no", "model"], ("S1", "S2"))
    feed = normalize_feed(wide)
    rows = canonical_rows(feed, cfg, normalize=False, keep=probe_columns(feed))
    got = [(r.sheet, r.row_idx, r.sample_rank, list(r.cols_first40), r.probe_model) for r in missing_key_sample(rows, []).orderBy("sample_rank").collect()]
    assert got == [("S1", 0, 1, ["zeta", "model"], "m1"), ("S2", 0, 2, ["model", "alpha"], "m2")]


def test_mapped_rows_by_tasks_of_so_many_cells(spark, monkeypatch):
    """Cells are not dealt by sheet name; the tasks that put rows together
    grow in number with the cells; positions in blocks are the same positions."""
    from feedloom.sources import xlsx

    cells = [("DATA", 0, 0, "Item No"), ("DATA", 0, 1, "Width")] + [("DATA", r, c, f"{r}-{c}") for r in range(2, 60, 3) for c in (0, 1)]

    def rows():
        wide = _wide(spark, cells, ["item_no", "width"])
        return sorted((r._src_row, r.item_no, r.width) for r in wide.collect()), wide._jdf.queryExecution().executedPlan().toString()
    few, _ = rows()
    monkeypatch.setattr(xlsx, "CELLS_PER_TASK", 20)
    monkeypatch.setattr(xlsx, "ROWS_PER_BLOCK", 7)
    many, plan = rows()
    assert many == few == [(r - 1, f"{r}-0" if r % 3 == 2 else None, f"{r}-1" if r % 3 == 2 else None) for r in range(1, 60)]
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(sheet_name" not in plan


def test_sheet_queries_make_no_large_task(spark, monkeypatch, tmp_path):
    """sheet_scan over several files, rows put together by many tasks."""
    from feedloom.plans import catalog
    from feedloom.sources import xlsx

    spark.range(1, 90).selectExpr("id AS p_partkey", "'Brand#12' AS p_brand", "concat('part ', id) AS p_name", "'TIN' AS p_type", "cast(id % 50 AS int) AS p_size").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(catalog, "SHEET_ROWS", 16)
    found = []
    for n in (1 << 18, 30):
        monkeypatch.setattr(xlsx, "CELLS_PER_TASK", n)
        monkeypatch.setattr(xlsx, "ROWS_PER_BLOCK", 5)
        found.append(sorted(map(str, catalog.REGISTRY["sheet_scan"](spark, str(tmp_path)).collect())))
    assert found[0] == found[1] and len(found[0]) == 89

"""Run report (I1-I3) over a small feed: counters, by-category map, JSON form."""
import json

from feedloom.operators import report as R
from feedloom.plans.ingest import as_feed, canonical_rows

CFG = {"vendor_code": "V", "sheets": [{"sheet_name": "S"}],
       "category": {"strategy": "layered", "column_value": {"columns": ["d"], "mappings": {"fans": ["fan"]}}},
       "column_map": {"core": {"inventory_partno": ["sku"]}}}


def test_report_rows_and_json(spark):
    feed = spark.createDataFrame(
        [("a.xlsx", 0, "A", "fan"), ("a.xlsx", 1, None, "fan"), ("a.xlsx", 2, "B", "lamp"), ("b.xlsx", 0, "C", "fan")],
        "file_name string, row_idx int, sku string, d string")
    rows = canonical_rows(as_feed(feed, row="row_idx", file="file_name"), CFG)
    files = spark.createDataFrame(
        [("z.xlsx", "z.xlsx", None, "skipped", "No vendor mapping matched file_name")]
        + [(n, n, "V", "matched", None) for n in ("a.xlsx", "b.xlsx", "c.xlsx", "empty.xlsx")],
        "path string, file_name string, vendor_code string, status string, reason string")
    fatal = spark.createDataFrame([("c.xlsx", "BadZipFile: x")], "path string, reason string")
    moved = spark.createDataFrame([("a.xlsx", "/arch/a.xlsx", None), ("c.xlsx", None, "PermissionError: x")], "path string, moved_to string, move_error string")
    report = R.run_report(rows, R.file_status(files, fatal), "/in", moved)
    got = {r.file: (r.rows_total, r.rows_upserted, r.rows_skipped_missing_key, r.status) for r in report.collect()}
    assert got == {"a.xlsx": (3, 2, 1, "ok"), "b.xlsx": (1, 1, 0, "ok"), "empty.xlsx": (0, 0, 0, "ok"),
                   "z.xlsx": (None, None, None, "skipped"), "c.xlsx": (None, None, None, "failed")}
    docs = [json.loads(r.json) for r in R.report_json(report).collect()]
    assert {d["run_status"] for d in docs} == {"partial"} and {d["input_dir"] for d in docs} == {"/in"}
    c = next(d for d in docs if d["file"] == "c.xlsx")
    assert c["reason"] == "Fatal error: BadZipFile: x" and c["move_error"] == "PermissionError: x" and c["skipped"]
    assert next(d for d in docs if d["file"] == "a.xlsx")["archived_to"] == "/arch/a.xlsx"
    a = next(d for d in docs if d["file"] == "a.xlsx")
    assert a["by_category"] == {"fans": 1, "lighting": 1}
    assert next(d for d in docs if d["file"] == "z.xlsx")["reason"] == "No vendor mapping matched file_name"


def test_totals_are_counted_by_the_write(spark, tmp_path):
    from feedloom.operators.classify import categories_of
    from feedloom.plans.ingest import stage_rows_counted

    cfg = dict(CFG, category={"strategy": "rules", "rules": [{"if_any_field_present": ["lamp"], "category_type": "lighting"}, {"default": None}]})
    feed = spark.createDataFrame([(f"f{i % 3}", i, f"K{i}" if i % 4 else None, "x" if i % 5 else None) for i in range(60)],
                                 "file_name string, row_idx int, sku string, lamp string").repartition(7)
    rows, totals = stage_rows_counted(canonical_rows(as_feed(feed, row="row_idx", file="file_name"), cfg), [cfg])
    files = R.file_counters(rows).collect()
    assert {c: totals[c] for c in R.COUNTS} == {c: sum(r[c] for r in files) for c in R.COUNTS}
    by = {}
    for r in R.category_counts(rows).collect():
        by[r.category_type or "null"] = by.get(r.category_type or "null", 0) + r.n_rows
    assert totals["by_category"] == by == {"lighting": 36, "null": 9} and sum(by.values()) == totals["rows_upserted"]
    summary = {r.path: r for r in R.file_summary(rows).collect()}
    assert {p: sum(r.by_category.values()) for p, r in summary.items()} == {r.path: r.rows_upserted for r in files}
    # With the totals the report reads the rows once; without them, twice or more.
    listed = spark.createDataFrame([(r.path, r.file, "V", "ok", None) for r in files], "path string, file_name string, vendor_code string, status string, reason string")
    with_totals, without = R.run_report(rows, listed, totals=totals), R.run_report(rows, listed)
    assert sorted(map(str, with_totals.collect())) == sorted(map(str, without.collect()))
    leaves = [df._jdf.queryExecution().optimizedPlan().collectLeaves().toString().count("Relation [") for df in (with_totals, without)]
    assert leaves[0] < leaves[1], leaves
    none, totals = stage_rows_counted(rows.limit(0).select(*rows.columns), [CFG])
    assert none.count() == 0 and totals == dict.fromkeys(R.COUNTS, 0) | {"by_category": {}}
    assert categories_of(CFG) == ["lighting", "fans"]


def test_log_sinks(spark, tmp_path):
    empty = spark.createDataFrame([], "file string, error_message string")
    assert R.write_csv(empty, str(tmp_path / "none"), only_if_any=True) is False
    assert not (tmp_path / "none").exists()
    df = spark.createDataFrame([("a.xlsx", "x")], "file string, error_message string")
    assert R.write_csv(df, str(tmp_path / "errs"), sort_columns=True, only_if_any=True) is True
    back = R.read_csv(spark, str(tmp_path / "errs"), "error_message string, file string").collect()
    assert [tuple(r) for r in back] == [("x", "a.xlsx")]
    R.write_report(df.withColumnRenamed("error_message", "reason"), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().file == "a.xlsx"


def test_same_names_in_two_folders(spark):
    from feedloom.operators.files import disposition, with_name_parts

    files = with_name_parts(spark.createDataFrame([("/in/a/x.xlsx", "ok"), ("/in/b/x.xlsx", "ok"), ("/in/c/x.xlsx", "failed"), ("/in/d/y.xlsx", "ok"), ("/in/e/x.xlsx", "ok"),
                                                   ("/in/f/x.xlsx", "skipped")], "path string, status string"))
    existing = spark.createDataFrame([("/in/archive", "y.xlsx")], "dir string, file_name string")
    got = {r.path: r.moved_to for r in disposition(files, existing, "S").collect()}
    assert got == {"/in/a/x.xlsx": "/in/archive/x.xlsx", "/in/b/x.xlsx": "/in/archive/x_S.xlsx", "/in/e/x.xlsx": "/in/archive/x_S_2.xlsx",
                   "/in/c/x.xlsx": "/in/error/x.xlsx", "/in/d/y.xlsx": "/in/archive/y_S.xlsx", "/in/f/x.xlsx": None}
    feed = spark.createDataFrame([("/a/x.xlsx", "x.xlsx", 0, "A"), ("/b/x.xlsx", "x.xlsx", 0, "B")], "p string, f string, r int, sku string")
    rows = canonical_rows(as_feed(feed, row="r", path="p", file="f"), CFG)
    assert {r.path: r.rows_total for r in R.file_counters(rows).collect()} == {"/a/x.xlsx": 1, "/b/x.xlsx": 1}

"""Moves with a journal, and whole runs over a folder."""
import os

import pytest

from feedloom.operators import moves as V
from feedloom.operators import snapshots as S
from feedloom.plans.ingest import ingest_delimited, run_folder

CFG = {"vendor_code": "Acme", "file_match": ["acme"], "sheets": [{"sheet_name": "DATA", "header_row": 0}], "category": {"default": "lighting"},
       "column_map": {"core": {"inventory_partno": ["item_no"], "wholesale_price": ["price"]}}, "conversions": {"money": ["wholesale_price"]}}


def _put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def _outcome(df):
    return {os.path.basename(r.path): (r.moved_to and os.path.basename(r.moved_to), (r.move_error or "").split(":")[0]) for r in df.collect()}


def _plan(spark, tmp_path, names):
    return spark.createDataFrame([(f"{tmp_path}/in/{a}", b and f"{tmp_path}/arch/{b}") for a, b in names], "path string, moved_to string")


def test_moves_report_what_cannot_be_moved(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 2)
    for n in ("a", "b", "c", "stays"):
        _put(f"{tmp_path}/in/{n}", n)
    _put(f"{tmp_path}/arch/b", "older")
    done = V.move_files(spark, _plan(spark, tmp_path, [("a", "a"), ("b", "b"), ("c", "c_1"), ("gone", "gone"), ("stays", None)]), f"{tmp_path}/journal", "r1")
    assert _outcome(done) == {"a": ("a", ""), "b": (None, "FileExistsError"), "c": ("c_1", ""), "gone": (None, "FileNotFoundError")}
    assert sorted(os.listdir(f"{tmp_path}/in")) == ["b", "stays"] and sorted(f for f in os.listdir(f"{tmp_path}/arch") if not f.startswith(".")) == ["a", "b", "c_1"]
    with open(f"{tmp_path}/arch/b") as fh:
        assert fh.read() == "older"
    assert V.finish_moves(spark, f"{tmp_path}/journal") == []


def test_restart_finishes_the_moves(spark, tmp_path, monkeypatch):
    for n in "abcd":
        _put(f"{tmp_path}/in/{n}", n)
    plan, journal, real, seen = _plan(spark, tmp_path, [(n, n) for n in "abcd"]), f"{tmp_path}/journal", V._move, []

    def lost(spark, path, target):
        if len(seen) == 2:
            raise KeyboardInterrupt
        seen.append(path)
        return real(spark, path, target)
    monkeypatch.setattr(V, "_move", lost)
    monkeypatch.setattr(V, "THREADS", 1)
    with pytest.raises(KeyboardInterrupt):
        V.move_files(spark, plan, journal, "r1")
    assert len(os.listdir(f"{tmp_path}/in")) == 2
    monkeypatch.setattr(V, "_move", real)
    assert V.finish_moves(spark, journal) == ["r1"] and V.finish_moves(spark, journal) == []
    assert os.listdir(f"{tmp_path}/in") == [] and sorted(f for f in os.listdir(f"{tmp_path}/arch") if not f.startswith(".")) == list("abcd")
    assert _outcome(spark.read.parquet(f"{journal}/run=r1/done")) == {n: (n, "") for n in "abcd"}


def test_whole_runs_over_a_folder(spark, tmp_path, monkeypatch):
    from feedloom.sources import delimited

    monkeypatch.setattr(delimited, "MAX_RECORD_LINES", 4)
    drop, root, arch, bad = (f"{tmp_path}/{d}" for d in ("in", "snap", "arch", "err"))
    _put(f"{drop}/acme_1.csv", "Item No,Price\nA,1\nB,x\n,3\n")
    _put(f"{drop}/acme_2.csv", 'Item No,Price\nC,"never\n' + "l\n" * 8)
    _put(f"{drop}/other.csv", "a\n1\n")
    _put(f"{arch}/acme_1.csv", "an older one")

    def run(stamp):
        return {r.file: r for r in run_folder(spark, drop, [CFG], root, arch, bad, stamp, source=ingest_delimited).collect()}
    report = run("s1")
    assert {f: (r.status, r.rows_total, os.path.basename(r.archived_to or "")) for f, r in report.items()} == {
        "acme_1.csv": ("ok", 3, "acme_1_s1.csv"), "acme_2.csv": ("failed", None, "acme_2.csv"), "other.csv": ("skipped", None, "")}
    assert os.listdir(drop) == ["other.csv"] and [f for f in os.listdir(bad) if f.startswith("acme")] == ["acme_2.csv"]
    _put(f"{drop}/acme_3.csv", "Item No,Price\nA,5\nD,4\n")
    assert run("s2")["acme_3.csv"].rows_upserted == 2
    core = {r.inventory_partno: (r.product_id, r.wholesale_price) for r in S.read_snapshot(spark, root)["core"].collect()}
    assert core == {"A": (1, 5.0), "B": (2, None), "D": (3, 4.0)}
    assert [r["field"] for r in spark.read.option("header", True).csv(f"{root}/logs/run=s1/conversions").collect()] == ["wholesale_price"]
    assert set(run("s3")) == {"other.csv"} and S.versions(spark, root)[-1] == 2


def test_run_over_files_by_many_tasks(spark, tmp_path, monkeypatch):
    """A whole run whose rows are put together by tasks of a few cells."""
    from feedloom.sources import xlsx

    monkeypatch.setattr(xlsx, "CELLS_PER_TASK", 25)
    monkeypatch.setattr(xlsx, "ROWS_PER_BLOCK", 4)
    for k in range(3):
        _put(f"{tmp_path}/in/acme_{k}.csv", "Item No,Price\n" + "".join(f"P{k}-{i},{i}\n" if i % 5 else ",\n" for i in range(20)))
    report = run_folder(spark, f"{tmp_path}/in", [CFG], f"{tmp_path}/root", f"{tmp_path}/archive", f"{tmp_path}/error", "s1", source=ingest_delimited).collect()
    assert [(r.status, r.rows_total, r.rows_upserted) for r in report] == [("ok", 20, 16)] * 3
    core = S.read_snapshot(spark, f"{tmp_path}/root")["core"].collect()
    assert sorted((r.inventory_partno, r.wholesale_price) for r in core) == sorted((f"P{k}-{i}", float(i)) for k in range(3) for i in range(20) if i % 5)

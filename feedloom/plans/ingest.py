"""Mapped ingest as one lazy plan (the mapped-ingest lifecycle).

``feed -> A8 -> B1 -> F (classify) -> E (map) -> D (convert) -> G (status)
-> H3 fold -> H1..H7 merge -> I report``. Narrow projections until the key
fold; shuffles only at the fold, the merge joins and the report aggregates.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import match_rules_df, sheet_rules_df
from ..functions.headers import norm_header_py
from ..functions.text import source_na
from ..operators.classify import categories_of, classify, feed_columns
from ..operators.files import MAPPED_SUFFIXES, disposition, file_inventory, vendor_match
from ..operators.mapping import alias_list, conversion_audit, project_records, union_vendors
from ..operators.merge import exclude_failed_files, merge_run
from ..operators.moves import finish_moves, move_files, names_in
from ..operators.report import file_status, observe_totals, run_report, totals_of, write_csv, write_report
from ..operators.snapshots import merge_batch
from ..operators.validate import PROBE_COLUMNS, error_rows, split_status, with_status
from ..schema import FILE, FILE_SEQ, KIND, PATH, RESERVED, ROW, SHEET, VENDOR
from ..session import scratch_scope, stage_table
from ..sources.delimited import DELIMITED_SUFFIXES, delimited_cells
from ..sources.xlsx import mapped_rows, read_cells, workbook_files


def as_feed(df: DataFrame, row: str, file: str | None = None, path: str | None = None, sheet: str | None = None,
            vendor: str | None = None, kinds: dict[str, str] | None = None, file_seq: str | None = None) -> DataFrame:
    """A table as a wide feed: the named columns become reserved ones, every
    other column is a feed column, whatever its name. ``kinds`` maps a feed
    column to the column with its cells' kinds; ``file_seq`` orders the files
    (else their paths do)."""
    reserved = {row: ROW, file: FILE, path: PATH, sheet: SHEET, vendor: VENDOR, file_seq: FILE_SEQ}
    reserved |= {k: KIND + norm_header_py(c) for c, k in (kinds or {}).items()}
    reserved.pop(None, None)
    return df.select(*[F.col(f"`{c}`").alias(reserved.get(c, c)) for c in df.columns])


def normalize_feed(feed: DataFrame, na_tokens: bool = True) -> DataFrame:
    """A8 + B1 on a wide, all-text feed.

    Header normalisation is resolved at plan time from the schema. NA tokens
    become NULL first; then columns that normalise to the same name are folded,
    first non-null by position. Columns without a name after B1 are dropped (no
    mapping can name them); reserved columns stay as they are.
    """
    groups: OrderedDict[str, list[str]] = OrderedDict()
    keep = []
    for c in feed.columns:
        if c.startswith(RESERVED):
            keep.append(F.col(f"`{c}`"))
        elif norm := norm_header_py(c):
            groups.setdefault(norm, []).append(c)
    cols = []
    for norm, srcs in groups.items():
        vals = [F.col(f"`{s}`").cast("string") for s in srcs]
        if na_tokens:
            vals = [source_na(v) for v in vals]
        cols.append((vals[0] if len(vals) == 1 else F.coalesce(*vals)).alias(norm))
    return feed.select(*keep, *cols)


def canonical_rows(feed: DataFrame, cfg: dict, run_id: int | None = None, na_tokens: bool = True,
                   normalize: bool = True, keep: Iterable[str] = ()) -> DataFrame:
    """Normalised, classified, mapped, converted and validated rows (one per feed row)."""
    df = normalize_feed(feed, na_tokens) if normalize else feed
    df = classify(df, cfg)
    return with_status(project_records(df, cfg, run_id=run_id, keep=keep))


def stage_rows_counted(rows: DataFrame, mappings: list[dict]) -> tuple[DataFrame, dict]:
    """The canonical batch as a table, and the run's totals, which are counted by
    the write itself."""
    counted, seen = observe_totals(rows, [c for cfg in mappings for c in categories_of(cfg)])
    return stage_table(counted, "canonical-batch"), totals_of(seen)


def probe_columns(feed: DataFrame) -> list[str]:
    """The columns shown for rows without a key, as far as the feed has them."""
    cols = feed_columns(feed.columns)
    return [p for p in PROBE_COLUMNS if p in cols]


def ingest(feed: DataFrame, cfg: dict, targets: dict | None = None, run_id: int | None = None,
           stage_rows: bool = True) -> dict:
    """Full mapped ingest of one feed into new snapshots of every table.

    The canonical batch is read by the merge, the counters, the error log and
    the audit; ``stage_rows`` writes it once to the shared folder so the
    classification and conversions run once. ``totals`` are counted by that write
    (None without it).
    """
    rows, totals = canonical_rows(feed, cfg, run_id=run_id), None
    if stage_rows:
        rows, totals = stage_rows_counted(rows, [cfg])
    ok, _, _ = split_status(rows)
    return merge_run(targets or {}, ok) | {"rows": rows, "totals": totals}


def mapping_columns(cfg: dict) -> list[str]:
    """The normalised sheet columns that a mapping reads."""
    cat = cfg.get("category") or {}
    wanted = [a for section in (cfg.get("column_map") or {}).values() for c in (section or {}).values() for a in alias_list(c)]
    for part in ("column_value", "regex_scan"):
        wanted += (cat.get(part) or {}).get("columns") or []
    return list(dict.fromkeys([*wanted, *PROBE_COLUMNS]))


def ingest_cells(cells: DataFrame, files: DataFrame, mappings: list[dict], targets: dict | None = None,
                 run_id: int | None = None, input_dir: str | None = None, stage_rows: bool = True, merge: bool = True) -> dict:
    """Mapped ingest of long cells of many files.

    ``cells(file_path, sheet_name, row_idx, col_idx, kind, text)``, where a row
    of kind ``fatal`` says why the file could not be read; ``files``: the matched
    inventory of :func:`match_files`. A fatal file fails alone: it brings no rows
    and is reported with its reason; the others are merged.

    Returns the new snapshots, ``rows`` (status-tagged canonical rows), ``ok``
    (those to merge), ``files`` (with status ok / skipped / failed), ``errors``,
    ``audit``, ``report`` and ``totals`` (of the run, counted by the write of
    ``rows``; None without it). With ``merge=False`` there are no snapshots: the
    caller merges ``ok``.
    """
    fatal = cells.filter(F.col("kind") == "fatal").select(F.col("file_path").alias("path"), F.col("text").alias("reason")).distinct()
    files = stage_table(file_status(files, fatal), "files")
    good = files.filter(F.col("status") == "ok").select(
        F.col("path").alias("file_path"), "file_name", F.col("file_seq"), F.col("mapping_seq"))
    readable = (cells.filter(F.col("kind").isNull() | (F.col("kind") != "fatal"))
                .select("file_path", "sheet_name", "row_idx", "col_idx", "kind", "text").join(good, "file_path"))
    frames, audits = [], []
    for seq, cfg in enumerate(mappings):
        own = readable.filter(F.col("mapping_seq") == seq)
        wide = mapped_rows(own, sheet_rules_df(cells.sparkSession, [cfg]), mapping_columns(cfg), cfg)
        feed = normalize_feed(wide)
        frames.append(canonical_rows(feed, cfg, run_id=run_id, normalize=False, keep=probe_columns(feed)))
        audits.append(conversion_audit(classify(feed, cfg), cfg))
    rows, totals = union_vendors(frames), None
    if stage_rows:
        rows, totals = stage_rows_counted(rows, mappings)
    ok = exclude_failed_files(rows.filter(F.col("status") == "ok"), files.filter(F.col("status") == "failed"))
    out = merge_run(targets or {}, ok) if merge else {}
    out |= {"rows": rows, "ok": ok, "files": files, "errors": error_rows(rows), "audit": union_vendors(audits),
            "report": run_report(rows, files, input_dir, totals=totals), "totals": totals}
    return out


def match_files(listing: DataFrame, mappings: list[dict], exclude_dirs=(), suffixes=MAPPED_SUFFIXES) -> DataFrame:
    """A1 + A2 on a listing with a ``path`` column."""
    inv = file_inventory(listing.select("path"), suffixes=suffixes, exclude_dirs=exclude_dirs, number=False)
    return vendor_match(inv, match_rules_df(listing.sparkSession, mappings))


def ingest_workbooks(spark, path: str, mappings: list[dict], targets: dict | None = None,
                     run_id: int | None = None, exclude_dirs=(), stage_rows: bool = True, merge: bool = True) -> dict:
    """End-to-end mapped ingest of a folder of workbooks.

    A1 inventory (listing only) -> A2 vendor match -> only matched files are
    read, configured sheets only -> per-vendor canonical rows -> H merge. A file
    that cannot be read is reported as failed and the run goes on.
    """
    books = workbook_files(spark, path)
    files = match_files(books, mappings, exclude_dirs)
    matched = files.filter(F.col("status") == "matched").select("path")
    sheets = sorted({s["sheet_name"] for m in mappings for s in m.get("sheets") or []})
    # Parse every matched workbook once; each vendor's pivot reads the staged cells.
    cells = stage_table(read_cells(spark, path, sheets=sheets, only=matched), "cells")
    return ingest_cells(cells, files, mappings, targets, run_id, path, stage_rows, merge)


def ingest_delimited(spark, path: str, mappings: list[dict], targets: dict | None = None, run_id: int | None = None,
                     exclude_dirs=(), stage_rows: bool = True, merge: bool = True, sheet_name: str = "DATA", **syntax) -> dict:
    """End-to-end mapped ingest of a folder of delimited files, each as a workbook
    of one sheet ``sheet_name``: listing, vendor match, and a scan of the matched
    files only. A file with a quote that is never closed fails alone."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path"))
    files = match_files(listing, mappings, exclude_dirs, DELIMITED_SUFFIXES)
    # Names of the files to open, as a file scan lists them on the driver.
    matched = [r["path"] for r in files.filter(F.col("status") == "matched").select("path").collect()]
    if matched:
        cells = stage_table(delimited_cells(spark, matched, sheet_name=sheet_name, **syntax), "cells")
    else:
        cells = spark.createDataFrame([], "file_path string, file_name string, sheet_name string, row_idx long, col_idx int, kind string, text string")
    return ingest_cells(cells, files, mappings, targets, run_id, path, stage_rows, merge)


def run_folder(spark, path: str, mappings: list[dict], root: str, archive_dir: str, error_dir: str, run_stamp: str,
               run_id: int | None = None, source=ingest_workbooks, **options) -> DataFrame:
    """One whole run over a folder: read, commit, move, report.

    The files' rows are merged into the tables under ``root`` by one commit
    (``operators.snapshots``); then files that were read go to ``archive_dir`` and
    unreadable ones to ``error_dir``, through a journal; then the logs are
    written. Returns the run report, with ``archived_to`` and ``move_error``.

    A run lost before its commit has changed nothing. One lost after it leaves
    files in the folder: the next run first finishes the moves written down, and
    merges the rest again, which changes no row. ``source``: :func:`ingest_workbooks`
    or :func:`ingest_delimited`."""
    journal, logs = f"{root}/moves", f"{root}/logs/run={run_stamp}"
    finish_moves(spark, journal)
    with scratch_scope(spark):
        out = source(spark, path, mappings, run_id=run_id, exclude_dirs=(archive_dir, error_dir, root), merge=False, **options)
        merge_batch(spark, root, out["ok"])
        plan = disposition(out["files"], names_in(spark, [archive_dir, error_dir]), run_stamp, archive_dir, error_dir)
        moved = move_files(spark, plan, journal, run_stamp)
        report = run_report(out["rows"], out["files"], path, moved, out["totals"])
        write_report(report, f"{logs}/report")
        write_csv(out["errors"], f"{logs}/errors", only_if_any=True)
        write_csv(out["audit"], f"{logs}/conversions", sort_columns=True, only_if_any=True)
    return spark.read.schema(report.schema).json(f"{logs}/report")


__all__ = ["as_feed", "normalize_feed", "canonical_rows", "ingest", "ingest_cells", "ingest_delimited", "ingest_workbooks", "match_files", "run_folder",
           "mapping_columns", "probe_columns", "feed_columns"]

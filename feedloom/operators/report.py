"""Run reporting (I1-I5): counters, category counts, the run report and log sinks.

Counters of files are plain hash aggregates over the status-tagged rows (partial
aggregation before the shuffle). The totals of a run are observed on the write of
those rows (:func:`observe_totals`), so they take no pass of their own, and the
report reads the rows once, for all counters of all files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


COUNTS = ("rows_total", "rows_upserted", "rows_skipped_missing_key", "rows_error")
#: The category of rows without one, as a JSON key.
NO_CATEGORY = "null"


def _counts() -> list[Column]:
    s = F.col("status")
    return [c.alias(n) for n, c in zip(COUNTS, (F.count(F.lit(1)), F.count_if(s == "ok"), F.count_if(s == "skipped"), F.count_if(s == "error")))]


def file_counters(rows: DataFrame) -> DataFrame:
    """Rows processed per file (not distinct keys). A file is its path."""
    return rows.groupBy(F.col("source_path").alias("path"), F.col("source_file_name").alias("file"), "vendor_code").agg(*_counts())


def observe_totals(rows: DataFrame, categories: Iterable[str | None]) -> tuple[DataFrame, Observation]:
    """I1 + I2 of a whole run, counted while ``rows`` is written: the rows to
    write, and what :func:`totals_of` reads after the write. ``categories``: all
    that the mappings can give (``classify.categories_of``).

    The counts belong to the tasks of the write. A task that runs again after the
    loss of an executor is counted once, as the write's other outcome is dropped."""
    seen, ok = Observation(), F.col("status") == "ok"
    named = [F.count_if(ok & F.col("category_type").eqNullSafe(F.lit(c))).alias(f"category:{NO_CATEGORY if c is None else c}")
             for c in dict.fromkeys(categories)]
    return rows.observe(seen, *_counts(), *named), seen


def totals_of(seen: Observation) -> dict:
    """The four counts and ``by_category`` (upserted rows, categories that occur)."""
    got = seen.get
    names = [n for n in got if n.startswith("category:")]
    return {n: got[n] for n in COUNTS} | {"by_category": {n.removeprefix("category:"): got[n] for n in names if got[n]}}


def category_counts(rows: DataFrame) -> DataFrame:
    """I2 (long form): upserted rows per file and category."""
    return (rows.filter(F.col("status") == "ok")
            .groupBy(F.col("source_path").alias("path"), F.col("source_file_name").alias("file"), "category_type")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def category_totals(rows: DataFrame) -> DataFrame:
    """I2 with totals: per (file, category), per file and overall (``rollup``),
    ``level`` is ``grouping_id()``: 0 = detail, 1 = file total, 3 = grand total."""
    ok = rows.filter(F.col("status") == "ok")
    return ok.rollup(F.struct(F.col("source_path").alias("path"), F.col("source_file_name").alias("file")).alias("f"), "category_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.grouping_id().alias("level")).select("f.path", "f.file", "category_type", "n_rows", "level")


def file_summary(rows: DataFrame) -> DataFrame:
    """I1 + I2 of every file in one pass: the counts, and the upserted rows of
    each category as a map (NULL for a file without any)."""
    per = rows.groupBy(F.col("source_path").alias("path"), F.coalesce("category_type", F.lit(NO_CATEGORY)).alias("category_type")).agg(*_counts())
    entries = F.array_sort(F.collect_list(F.when(F.col("rows_upserted") > 0, F.struct("category_type", F.col("rows_upserted").alias("n_rows")))))
    return per.groupBy("path").agg(*[F.sum(c).alias(c) for c in COUNTS], F.when(F.size(entries) > 0, F.map_from_entries(entries)).alias("by_category"))


def file_status(files: DataFrame, fatal: DataFrame) -> DataFrame:
    """Matched files become ``ok``, or ``failed`` with the reason in ``fatal(path,
    reason)``; unmatched files stay ``skipped``. Row errors do not fail a file."""
    why = fatal.groupBy("path").agg(F.min("reason").alias("__why"))
    failed = (F.col("status") == "matched") & F.col("__why").isNotNull()
    return files.join(why, "path", "left").withColumns({
        "reason": F.when(failed, F.concat(F.lit("Fatal error: "), F.col("__why"))).otherwise(F.col("reason")),
        "status": F.when(failed, F.lit("failed")).when(F.col("status") == "matched", F.lit("ok")).otherwise(F.col("status")),
    }).drop("__why")


def run_report(rows: DataFrame, files: DataFrame, input_dir: str | None = None, moved: DataFrame | None = None,
               totals: dict | None = None) -> DataFrame:
    """One report row per file of the inventory: its counters and categories
    when it was read (zeros for a file without rows), else the reason why it was
    skipped or failed. ``moved(path, moved_to, move_error)``: what became of the
    file. ``totals``: :func:`totals_of` the run, whose errors are else counted in
    another pass. ``run_status`` is ``failed`` if no matched file was read,
    ``partial`` if some were not or a file that was read had row errors, else ``ok``."""
    read = F.col("status") == "ok"
    df = files.select("path", F.col("file_name").alias("file"), "vendor_code", "status", "reason").join(file_summary(rows), "path", "left")
    df = df.withColumns({c: F.when(read, F.coalesce(c, F.lit(0))) for c in COUNTS} | {"skipped": ~read})
    if moved is None:
        df = df.withColumns({"archived_to": F.lit(None).cast("string"), "move_error": F.lit(None).cast("string")})
    else:
        df = df.join(moved.select("path", F.col("moved_to").alias("archived_to"), "move_error"), "path", "left")
    whole, errors = (df, F.coalesce(F.sum("rows_error"), F.lit(0))) if totals is None else (files, F.lit(totals["rows_error"]))
    run = whole.agg(F.count_if(read).alias("n_ok"), F.count_if(F.col("status") == "failed").alias("n_failed"), errors.alias("n_errors")).select(
        F.when((F.col("n_failed") > 0) & (F.col("n_ok") == 0), F.lit("failed"))
        .when((F.col("n_failed") > 0) | (F.col("n_errors") > 0), F.lit("partial")).otherwise(F.lit("ok")).alias("run_status"))
    # One row: the status of the whole run.
    return df.join(F.broadcast(run)).select(
        F.lit(input_dir).cast("string").alias("input_dir"), "path", "file", "vendor_code", *COUNTS, "by_category", "skipped", "status", "reason",
        "archived_to", "move_error", "run_status")


def report_json(report: DataFrame) -> DataFrame:
    """I3 sink form: one JSON document per file (``to_json`` of the row)."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("json"))


def write_csv(df: DataFrame, path: str, sort_columns: bool = False, only_if_any: bool = False) -> bool:
    """CSV log with a header; I5 uses the sorted column union.

    ``only_if_any`` writes nothing for an empty log (``isEmpty`` reads at
    most one row). Returns whether a log was written.
    """
    if only_if_any and df.isEmpty():
        return False
    cols = sorted(df.columns) if sort_columns else df.columns
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)
    return True


def write_report(report: DataFrame, path: str) -> None:
    """I3 sink: the run report as JSON lines, one document per file."""
    report_json(report).write.mode("overwrite").text(path)


def read_csv(spark, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)

"""Validation and quarantine.

Rows are never dropped silently: every canonical row gets a ``status``
(``ok`` / ``skipped`` / ``error``) and the three sets are split by
predicate, so ``rows_total = upserted + skipped + errors`` always holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_text
from ..session import scratch_scope, stage_table
from .ids import global_index

# The hard-validation error raised for a falsy key.
ERROR_TYPE = "ValueError"
ERROR_MESSAGE = "Missing vendor_code or inventory_partno (required)."
TYPE_ERROR = "DataError"
MAX_ERROR_MESSAGE = 3500
MISSING_KEY_SAMPLE = 10
SAMPLE_COLUMNS = 40
# Columns printed for a missing-key row when present.
PROBE_COLUMNS = ("product_number", "config_sku", "base_model", "sku", "item", "model", "part_number", "catalog_no")


def falsy_key(value: Column, kind: Column) -> Column:
    """A key that is present but falsy: empty text, numeric zero, boolean false."""
    num_zero = (kind == F.lit("n")) & (F.coalesce(value.try_cast("double"), F.lit(1.0)) == F.lit(0.0))
    bool_false = (kind == F.lit("b")) & (F.lower(value) == F.lit("false"))
    return F.coalesce(value.isNull() | (value == F.lit("")) | num_zero | bool_false, F.lit(True))


def with_status(records: DataFrame) -> DataFrame:
    """G1 + G3: ``skipped`` (no key text), ``error`` (falsy vendor/key, or text
    that a typed field cannot hold), else ``ok``."""
    partno = F.col("inventory_partno")
    kind = F.coalesce(F.col("inventory_partno_kind"), F.lit("s"))
    vendor = F.col("vendor_code")
    status = (
        F.when(~has_text(partno), F.lit("skipped"))
        .when(vendor.isNull() | (vendor == F.lit("")) | falsy_key(partno, kind) | F.col("rejected_field").isNotNull(), F.lit("error"))
        .otherwise(F.lit("ok"))
    )
    return records.withColumn("status", status)


def split_status(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ok, skipped, error) views of one status-tagged frame."""
    s = F.col("status")
    return records.filter(s == "ok"), records.filter(s == "skipped"), records.filter(s == "error")


def error_rows(records: DataFrame, with_timestamp: bool = True) -> DataFrame:
    """Quarantine rows in the error-log layout (message cut to 3500 chars)."""
    cols = []
    if with_timestamp:
        cols.append(F.current_timestamp().alias("timestamp"))
    cols += [
        F.col("source_file_name").alias("file"),
        F.col("source_sheet_name").alias("sheet"),
        F.col("source_row_number").alias("row_index"),
        F.col("vendor_code"),
        F.coalesce(F.col("inventory_partno"), F.lit("")).alias("inventory_partno"),
        F.col("category_type"),
        F.when(F.col("rejected_field").isNotNull(), F.lit(TYPE_ERROR)).otherwise(F.lit(ERROR_TYPE)).alias("error_type"),
        F.substring(F.when(F.col("rejected_field").isNotNull(), F.concat(F.lit("The column type cannot hold the value of "), F.col("rejected_field")))
                    .otherwise(F.lit(ERROR_MESSAGE)), 1, MAX_ERROR_MESSAGE).alias("error_message"),
    ]
    return records.filter(F.col("status") == "error").select(*cols)


def missing_key_sample(records: DataFrame, columns: list[str], k: int = MISSING_KEY_SAMPLE) -> DataFrame:
    """The first ``k`` skipped rows per file with column names and probe values.

    ``records`` carry the probe columns (``canonical_rows(..., keep=...)``), so
    nothing is joined back. ``columns``: the feed's columns in order, unless the
    rows bring their sheet's own (``sheet_columns``). ``row_number() <= k`` lets
    Spark limit each group before the shuffle, so a file with millions of skipped
    rows ships only ``k`` per map task.
    """
    probes = [c for c in records.columns if c.startswith("probe_")]
    own = "sheet_columns" in records.columns
    names = F.slice("sheet_columns", 1, SAMPLE_COLUMNS) if own else F.array(*[F.lit(c) for c in columns[:SAMPLE_COLUMNS]])
    w = Window.partitionBy("source_path").orderBy("file_seq", "sheet_seq", "row_idx")
    return (records.filter(F.col("status") == "skipped")
            .select("source_path", "file_seq", "sheet_seq", F.col("source_file_name").alias("file"), F.col("source_sheet_name").alias("sheet"),
                    "row_idx", names.alias("cols_first40"), *probes)
            .withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= k)
            .select("source_path", "file", "sheet", "row_idx", "sample_rank", "cols_first40", *probes))


def locate_bad_rows(rows: DataFrame, checks: dict[str, Column], group: list[str], order: str,
                    tiebreak: list[str] | None = None) -> DataFrame:
    """Per group, the first row (by ``order``) that breaks a constraint.

    Re-aim of "retry row by row to find the failing row": every constraint is
    a Column predicate evaluated before the write, one aggregate per group.
    """
    fails = None
    for name, ok in checks.items():
        v = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
        fails = v if fails is None else F.coalesce(fails, v)
    bad = rows.withColumn("failed_check", fails).filter(F.col("failed_check").isNotNull())
    return bad.groupBy(*group).agg(
        F.min(order).alias("first_bad_row"),
        F.min_by("failed_check", F.struct(order, *(tiebreak or []))).alias("failed_check"),
        F.count(F.lit(1)).alias("bad_rows"),
    )


def write_locating(rows: DataFrame, order: list[str], write: Callable[[DataFrame], None]) -> dict | None:
    """G5 on the real write: ``write`` the rows; if that fails, find the first row
    (by ``order``, unique) that makes it fail. Returns None, or ``position`` (from
    0), ``row`` (as a dict), ``error`` and ``writes`` (how many were made).

    The rows are numbered once (:func:`~feedloom.operators.ids.global_index`) and
    written again in ranges of that number, the earlier half first, so about
    log2(n) writes find the row, the last of them of this row alone. ``write`` is
    called with rows that it may have got before, so it must replace or merge
    (a staging table), not append. A write that fails for another reason (the sink
    is gone) fails for no row at all: then its error is raised.
    """
    def attempt(df: DataFrame) -> str | None:
        try:
            write(df)
        except Exception as e:  # whatever the sink raises is what is asked for
            return f"{type(e).__name__}: {e}"
        return None

    error = attempt(rows)
    if error is None:
        return None
    with scratch_scope(rows.sparkSession):
        numbered = stage_table(global_index(rows, order, "__at"), "located")
        low, high, writes = 0, numbered.count(), 1

        def part(a: int, b: int) -> DataFrame:
            return numbered.filter((F.col("__at") >= a) & (F.col("__at") < b)).drop("__at")
        if not high:
            raise RuntimeError(f"the write fails without rows: {error}")
        while high - low > 1:
            middle = (low + high) // 2
            writes += 1
            found = attempt(part(low, middle))
            if found is None:
                low = middle
            else:
                high, error = middle, found
        one = part(low, high)
        writes += 1
        found = attempt(one)
        if found is None:
            raise RuntimeError(f"no single row makes the write fail; it failed with {error}")
        return {"position": low, "row": one.first().asDict(), "error": found, "writes": writes}

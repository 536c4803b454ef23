"""Raw landing of unmapped sheets, on the long ``cells`` form.

Input: ``cells(file_name, sheet_name, row_idx, col_idx, kind, text)`` with
``kind`` in ``s`` (text), ``n`` (number), ``b`` (bool), ``d`` (date) or NULL
(empty cell). Every step is an aggregate or join keyed by sheet, row or
column; none collects a sheet into one task: header scoring only looks at
the first 30 rows, column-level tables are as small as the sheet's header,
and row numbering uses the bucketed :func:`positional_index`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.headers import norm_header_raw, safe_table_name, shorten_identifier, with_counter_suffix
from ..functions.text import SOURCE_NA_TOKENS, clean_text, has_text
from ..session import scratch_path, scratch_scope, stage_table
from .ids import positional_index

SHEET = ["file_name", "sheet_name"]
# Rows scanned for the header, and the per-row score weights
# (3 per non-blank text cell, 1 per non-empty cell, -0.5 per number cell,
# where empty cells count as numbers, as NaN is a float).
MAX_HEADER_SCAN_ROWS = 30
TEXT_WEIGHT, NON_NULL_WEIGHT, NUMBER_WEIGHT = 3.0, 1.0, 0.5


def with_source_na(cells: DataFrame) -> DataFrame:
    """A8 on cells: NA tokens in text cells become empty cells."""
    na = (F.col("kind") == F.lit("s")) & F.col("text").isin(*SOURCE_NA_TOKENS)
    return cells.withColumns({
        "kind": F.when(na, F.lit(None).cast("string")).otherwise(F.col("kind")),
        "text": F.when(na, F.lit(None).cast("string")).otherwise(F.col("text")),
    })


def sheet_width(cells: DataFrame) -> DataFrame:
    return cells.groupBy(*SHEET).agg((F.max("col_idx") + 1).alias("width"))


def header_scores(cells: DataFrame, max_scan: int = MAX_HEADER_SCAN_ROWS) -> DataFrame:
    """Per scanned row: text, non-null and number counts, the sheet's width and
    the score. One aggregate over all cells: those below the scanned rows only
    count for the width."""
    kind, scanned = F.col("kind"), F.col("row_idx") < max_scan
    per_row = cells.groupBy(*SHEET, F.when(scanned, F.col("row_idx")).alias("row_idx")).agg(
        F.count_if(scanned & (kind == "s") & has_text(F.col("text"))).alias("n_text"),
        F.count_if(scanned & kind.isNotNull()).alias("n_non_null"),
        F.count_if(scanned & kind.isin("n", "b")).alias("n_typed_number"),
        (F.max("col_idx") + 1).alias("__w"),
    )
    # At most max_scan + 1 rows for each sheet from here on.
    rows = per_row.withColumn("width", F.max("__w").over(Window.partitionBy(*SHEET))).drop("__w")
    n_num = F.col("n_typed_number") + (F.col("width") - F.col("n_non_null"))
    score = (F.lit(TEXT_WEIGHT) * F.col("n_text") + F.lit(NON_NULL_WEIGHT) * F.col("n_non_null")
             - F.lit(NUMBER_WEIGHT) * n_num)
    return rows.withColumn("score", F.when(F.col("row_idx").isNotNull(), score.cast("double")))


def detect_header(cells: DataFrame, max_scan: int = MAX_HEADER_SCAN_ROWS) -> DataFrame:
    """``(file_name, sheet_name, header_row, score)``; ties go to the earliest row.

    A row with no cell at all scores as all-empty (-0.5 * width); it can only
    win when no scanned row does better, and then row 0 wins the tie. Every sheet
    gets a header row, also one whose first rows are all empty.
    """
    best = header_scores(cells, max_scan).groupBy(*SHEET).agg(
        F.max_by(F.col("row_idx"), F.when(F.col("score").isNotNull(), F.struct(F.col("score"), -F.col("row_idx")))).alias("best_row"),
        F.max("score").alias("best_score"), F.max("width").alias("width"),
    )
    empty = F.lit(-NUMBER_WEIGHT) * F.col("width")
    return best.select(
        *SHEET,
        F.when(F.col("best_score") > empty, F.col("best_row")).otherwise(F.lit(0)).cast("int").alias("header_row"),
        F.coalesce(F.greatest(F.col("best_score"), empty), empty).alias("score"),
        "width",
    )


def header_names(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Column names as the sheet parse gives them: blank -> ``Unnamed: i``, repeats -> ``x.1``."""
    if "width" not in headers.columns:
        headers = headers.join(sheet_width(cells), SHEET)
    slots = headers.select(
        *SHEET, "header_row", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("col_idx"))
    hcells = cells.join(headers.select(*SHEET, "header_row"), SHEET).filter(
        F.col("row_idx") == F.col("header_row")).select(*SHEET, "col_idx", "kind", "text")
    named = slots.join(hcells, [*SHEET, "col_idx"], "left").withColumn(
        "raw_name",
        F.when(F.col("kind").isNull() | F.col("text").isNull(), F.concat(F.lit("Unnamed: "), F.col("col_idx").cast("string")))
        .otherwise(F.col("text")),
    )
    named = _rank(named, [*SHEET, "raw_name"], "__k", base=0)
    return named.select(
        *SHEET, "header_row", "col_idx",
        F.when(F.col("__k") > 0, F.concat(F.col("raw_name"), F.lit("."), F.col("__k").cast("string")))
        .otherwise(F.col("raw_name")).alias("original_header"),
    )


def data_cells(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """Cells below the detected header row."""
    return cells.join(headers.select(*SHEET, "header_row"), SHEET).filter(F.col("row_idx") > F.col("header_row"))


def live_rows(data: DataFrame) -> DataFrame:
    """Data rows with at least one non-empty cell."""
    return data.filter(F.col("kind").isNotNull()).select(*SHEET, "header_row", "row_idx").distinct()


def live_columns(data: DataFrame) -> DataFrame:
    """C2 (after C1): columns with at least one non-empty cell. Rows with a
    non-empty cell are live by definition, so no join with ``rows`` is needed."""
    return data.filter(F.col("kind").isNotNull()).select(*SHEET, "col_idx").distinct()


def renumber_rows(rows: DataFrame) -> DataFrame:
    """``source_row_number`` = 0-based position among the kept rows."""
    return positional_index(rows, SHEET, ["row_idx"], "source_row_number")


MAX_SHEET_COLUMNS = 16_384


def _rank(df: DataFrame, group: list[str], out: str, base: int, wide: bool = False) -> DataFrame:
    """Position by ``col_idx`` within ``group``.

    A worksheet has at most 16,384 columns, so a plain window is bounded; a
    larger column index fails the query instead of growing the window. Header
    lists that are not worksheets (``wide``) use the bucketed index.
    """
    if wide:
        return positional_index(df, group, ["col_idx"], out, base=base)
    checked = F.when(F.col("col_idx") < MAX_SHEET_COLUMNS, F.col("col_idx")).otherwise(
        F.raise_error(F.lit(f"a worksheet has at most {MAX_SHEET_COLUMNS} columns; pass wide=True for other header lists")).cast("long"))
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(checked)) - 1 + base)


def column_names(names: DataFrame, cols: DataFrame, wide: bool = False) -> DataFrame:
    """Normalised, shortened (>120 chars) and de-duplicated stored names.

    The first pass gives the k-th repeat of a name ``_k``; a second pass
    repeats that on the results, so stored names are always unique.
    ``wide=True`` for header lists not limited by a worksheet's width.
    """
    kept = names.join(cols, [*SHEET, "col_idx"], "left_semi")
    kept = kept.withColumn("normalized_header", norm_header_raw(F.col("original_header")))
    kept = kept.withColumn("__base", shorten_identifier(F.col("normalized_header")))
    kept = _rank(kept, [*SHEET, "__base"], "__k1", base=1, wide=wide)
    kept = kept.withColumn("__s1", with_counter_suffix(F.col("__base"), F.col("__k1")))
    kept = _rank(kept, [*SHEET, "__s1"], "__k2", base=1, wide=wide)
    kept = kept.withColumn("stored_column_name", with_counter_suffix(F.col("__s1"), F.col("__k2")))
    return kept.drop("__base", "__s1", "__k1", "__k2")


def column_map(columns: DataFrame, loaded_at=None) -> DataFrame:
    """Lineage rows original -> normalised -> stored header."""
    cols = []
    if loaded_at is not None:
        cols.append(F.lit(loaded_at).cast("timestamp").alias("loaded_at"))
    return columns.select(
        *cols,
        F.col("file_name").alias("source_file"), F.col("sheet_name").alias("source_sheet"), "col_idx",
        "original_header", "normalized_header", "stored_column_name",
    )


def raw_landing(cells: DataFrame, prefix: str = "RAW", loaded_at=None, na_tokens: bool = True,
                stage: bool = True) -> dict[str, DataFrame]:
    """H9 + H10 on every sheet: landing rows (long), the column map, and the
    per-sheet table names. Values are C3-cleaned text. Sheets without a non-empty
    cell below the header are skipped (A7): they have no table."""
    if na_tokens:
        cells = with_source_na(cells)
    # The cells are read by every step below (header scan, names, data); they
    # are staged once as a Parquet table, so a workbook is parsed once and
    # the header scan reads only the first rows' column chunks.
    if stage:
        cells = stage_table(cells, "cells")
    headers = detect_header(cells)
    data = data_cells(cells, headers)
    rows = renumber_rows(live_rows(data))
    cols = live_columns(data)
    names = column_names(header_names(cells, headers), cols)
    values = data.join(rows.select(*SHEET, "row_idx", "source_row_number"), [*SHEET, "row_idx"]).join(
        names.select(*SHEET, "col_idx", "stored_column_name"), [*SHEET, "col_idx"])
    ts = [F.lit(loaded_at).cast("timestamp").alias("loaded_at")] if loaded_at is not None else []
    landing = values.select(
        F.col("file_name").alias("source_file"), F.col("sheet_name").alias("source_sheet"),
        F.col("header_row").cast("bigint").alias("header_row"),
        F.col("source_row_number").cast("bigint").alias("source_row_number"), *ts,
        "col_idx", "stored_column_name", clean_text(F.col("text")).alias("value"),
    )
    stem = F.regexp_replace(F.col("file_name"), r"\.[^.]*$", "")
    full = headers.join(rows.select(*SHEET).distinct(), SHEET, "left_semi")
    tables = full.select(*SHEET, "header_row", safe_table_name(prefix, stem, F.col("sheet_name")).alias("table_name"))
    return {"headers": headers, "rows": rows, "columns": names, "landing": landing,
            "column_map": column_map(names, loaded_at), "tables": tables}


def landing_wide(landing: DataFrame, stored_names: list[str], loaded_at=None) -> DataFrame:
    """H9 + H10: landing tables in wide form, all text, with ``raw_id`` (1-based
    place in the sheet's table) and one ``loaded_at`` for the load. The columns
    come from the sheets' column map."""
    keys = ["source_file", "source_sheet", "header_row", "source_row_number"]
    wide = landing.groupBy(*keys).pivot("stored_column_name", stored_names).agg(F.first("value"))
    at = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return wide.select((F.col("source_row_number") + 1).alias("raw_id"), *keys, at.alias("loaded_at"), *[F.col(f"`{n}`") for n in stored_names])


def write_raw_tables(landed: dict[str, DataFrame], save, loaded_at=None) -> list[str]:
    """One wide table for each sheet that has rows, replaced on reload.

    ``save(df, table_name)`` writes a table (see ``sinks.replace_table``). Sheets
    of one table name: the last in file order stays, as a reload replaces a table.
    All rows are written once, by table (``sources.raw_store``), and each table is
    made from its own files; the list of tables is metadata.
    """
    from ..sources.raw_store import raw_table_names, read_raw_table, write_raw_rows

    spark = landed["landing"].sparkSession
    with scratch_scope(spark):
        root = scratch_path(spark, "raw")
        write_raw_rows(landed, root, loaded_at)
        names = raw_table_names(spark, root)
        for name in names:
            save(read_raw_table(spark, root, name), name)
    return names

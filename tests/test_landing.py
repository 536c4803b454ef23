"""Raw landing: header detection, naming, cleaning."""
from feedloom.operators import landing as L

CELLS = "file_name string, sheet_name string, row_idx int, col_idx int, kind string, text string"


def test_header_detection_golden(spark):
    grid = [
        ["Title", None, None, None],
        [None, None, None, None],
        ["a", "b", "c", "d"],
        ["x", "y", 1, 2],
    ]
    rows = []
    for r, vals in enumerate(grid):
        for c, v in enumerate(vals):
            kind = None if v is None else ("n" if isinstance(v, int) else "s")
            rows.append(("w.xlsx", "S", r, c, kind, None if v is None else str(v)))
    cells = spark.createDataFrame(rows, CELLS)
    scores = {r.row_idx: r.score for r in L.header_scores(cells).collect()}
    assert scores == {0: 2.5, 1: -2.0, 2: 16.0, 3: 9.0}
    assert L.detect_header(cells).first().header_row == 2


def _names(spark, headers):
    rows = [("w.xlsx", "S", i, h) for i, h in enumerate(headers)]
    names = spark.createDataFrame(rows, "file_name string, sheet_name string, col_idx int, original_header string")
    cols = names.select("file_name", "sheet_name", "col_idx")
    return [r.stored_column_name for r in L.column_names(names, cols).orderBy("col_idx").collect()]


def test_dedupe_and_shorten(spark):
    assert _names(spark, ["Name", "name", "NAME"]) == ["name", "name_2", "name_3"]
    out = _names(spark, ["a", "a", "a_2"])
    assert len(set(out)) == 3 and out[:2] == ["a", "a_2"]
    long = _names(spark, ["x" * 130, "x" * 130])
    assert len(long[0]) == 120 and len(long[1]) == 120 and long[0] != long[1]


def test_landing_drops_empty_and_renumbers(spark):
    rows = [
        ("w.xlsx", "S", 0, 0, "s", "Head A"), ("w.xlsx", "S", 0, 1, "s", "Head B"), ("w.xlsx", "S", 0, 2, None, None),
        ("w.xlsx", "S", 1, 0, None, None), ("w.xlsx", "S", 1, 1, None, None), ("w.xlsx", "S", 1, 2, None, None),
        ("w.xlsx", "S", 2, 0, "s", " v "), ("w.xlsx", "S", 2, 1, "s", "N/A"), ("w.xlsx", "S", 2, 2, None, None),
        ("w.xlsx", "S", 3, 0, "s", "null"), ("w.xlsx", "S", 3, 1, "n", "5"), ("w.xlsx", "S", 3, 2, None, None),
    ]
    out = L.raw_landing(spark.createDataFrame(rows, CELLS))
    land = sorted(((r.source_row_number, r.stored_column_name, r.value) for r in out["landing"].collect()),
                  key=lambda t: (t[0], t[1]))
    # sheet rows 2 and 3 become 0 and 1; "N/A" and "null" are NA at the source
    assert land == [(0, "head_a", "v"), (0, "head_b", None), (1, "head_a", None), (1, "head_b", "5")]
    cmap = sorted((r.original_header, r.stored_column_name) for r in out["column_map"].collect())
    assert cmap == [("Head A", "head_a"), ("Head B", "head_b")]
    assert out["tables"].first().table_name == "RAW_w_S"


def test_sheet_with_empty_top_rows_uses_row_zero(spark):
    rows = [("w.xlsx", "S", 40, 0, "s", "late"), ("w.xlsx", "S", 41, 0, "s", "data")]
    h = L.detect_header(spark.createDataFrame(rows, CELLS)).collect()
    assert [(r.header_row, r.score) for r in h] == [(0, -0.5)]


def test_landing_wide_table(spark):
    rows = [
        ("w.xlsx", "S", 0, 0, "s", "Name"), ("w.xlsx", "S", 0, 1, "s", "Name"), ("w.xlsx", "S", 0, 2, "s", "Qty"),
        ("w.xlsx", "S", 1, 0, "s", "a"), ("w.xlsx", "S", 1, 1, "s", "b"), ("w.xlsx", "S", 1, 2, "n", "3"),
        ("w.xlsx", "S", 2, 0, "s", "c"), ("w.xlsx", "S", 2, 2, "n", "4"),
    ]
    out = L.raw_landing(spark.createDataFrame(rows, CELLS))
    names = [r.stored_column_name for r in out["column_map"].orderBy("col_idx").collect()]
    assert names == ["name", "name1", "qty"]         # "Name.1" from the sheet parse; "." is dropped
    wide = L.landing_wide(out["landing"], names).orderBy("source_row_number").collect()
    assert [(r.raw_id, r.source_row_number, r.name, r.name1, r.qty) for r in wide] == [(1, 0, "a", "b", "3"), (2, 1, "c", None, "4")]
    assert len({r.loaded_at for r in wide}) == 1


def test_empty_sheets_have_no_table_and_tables_are_replaced(spark):
    rows = [("w.xlsx", "Full", 0, 0, "s", "Name"), ("w.xlsx", "Full", 1, 0, "s", "a"), ("w.xlsx", "Head only", 0, 0, "s", "Name"),
            ("w.xlsx", "Blank below", 0, 0, "s", "Name"), ("w.xlsx", "Blank below", 1, 0, None, None), ("w.xlsx", "NA below", 0, 0, "s", "Name"),
            ("w.xlsx", "NA below", 1, 0, "s", "N/A")]
    out = L.raw_landing(spark.createDataFrame(rows, CELLS))
    assert [r.table_name for r in out["tables"].collect()] == ["RAW_w_Full"]
    store = {}
    for _ in range(2):
        assert L.write_raw_tables(out, lambda df, name: store.__setitem__(name, df.collect()), "2026-01-01 00:00:00") == ["RAW_w_Full"]
    assert [(r.raw_id, r["name"]) for r in store["RAW_w_Full"]] == [(1, "a")]


def test_too_wide_a_worksheet_fails(spark):
    import pytest

    names = spark.createDataFrame([("w.xlsx", "S", 20_000, "h")], "file_name string, sheet_name string, col_idx int, original_header string")
    cols = names.select("file_name", "sheet_name", "col_idx")
    with pytest.raises(Exception, match="16384 columns"):
        L.column_names(names, cols).collect()
    assert L.column_names(names, cols, wide=True).count() == 1


def test_many_sheets_with_columns_of_their_own(spark, tmp_path):
    """1,000 sheets of different columns: one write, each table with its own
    columns; a reload replaces the tables it holds and no others."""
    from pyspark.sql import functions as F

    from feedloom.sources import raw_store as W

    root, sheets = str(tmp_path / "raw"), 1000
    cells = (spark.range(sheets).select(F.format_string("S%04d", "id").alias("sheet_name"), F.col("id"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("row_idx"))
             .select("sheet_name", "id", "row_idx", F.explode(F.sequence(F.lit(0), (F.col("id") % 3).cast("int"))).alias("col_idx"))
             .select(F.lit("w.xlsx").alias("file_name"), "sheet_name", F.col("row_idx").cast("int"), "col_idx", F.lit("s").alias("kind"),
                     F.when(F.col("row_idx") == 0, F.format_string("Col %d of %d", "col_idx", "id")).otherwise(F.format_string("v%d-%d-%d", "id", "row_idx", "col_idx")).alias("text")))
    landed = L.raw_landing(cells)
    W.write_raw_rows(landed, root, "2026-01-01 00:00:00")
    names = W.raw_table_names(spark, root)
    assert len(names) == sheets and W.read_raw_rows(spark, root).count() == 2 * sheets
    wide = W.read_raw_table(spark, root, "RAW_w_S0005")
    assert wide.columns == [*W.LINEAGE, "col_0_of_5", "col_1_of_5", "col_2_of_5"]
    assert sorted((r.raw_id, r.col_0_of_5, r.col_2_of_5) for r in wide.collect()) == [(1, "v5-1-0", "v5-1-2"), (2, "v5-2-0", "v5-2-2")]
    again = L.raw_landing(cells.filter("sheet_name = 'S0005' and row_idx < 2 and col_idx < 2"))
    W.write_raw_rows(again, root, "2026-01-02 00:00:00")
    assert W.read_raw_table(spark, root, "RAW_w_S0005").columns == [*W.LINEAGE, "col_0_of_5", "col_1_of_5"]
    assert W.read_raw_rows(spark, root).count() == 2 * sheets - 1
    W.register_views(spark, root, ["RAW_w_S0005", "RAW_w_S0004"])
    assert spark.sql("SELECT a.col_0_of_5, b.col_0_of_4 FROM RAW_w_S0005 a JOIN RAW_w_S0004 b USING (raw_id)").collect() == [("v5-1-0", "v4-1-0")]


def test_sheets_of_one_table_name(spark, tmp_path):
    from feedloom.sources import raw_store as W

    rows = [("a.xlsx", "S 1", 0, 0, "s", "Old"), ("a.xlsx", "S 1", 1, 0, "s", "x"), ("a.xlsx", "S_1", 0, 0, "s", "New"), ("a.xlsx", "S_1", 1, 0, "s", "y"), ("a.xlsx", "S_1", 2, 0, "s", "z")]
    landed = L.raw_landing(spark.createDataFrame(rows, CELLS))
    W.write_raw_rows(landed, str(tmp_path))
    assert sorted(r.new for r in W.read_raw_table(spark, str(tmp_path), "RAW_a_S_1").collect()) == ["y", "z"]

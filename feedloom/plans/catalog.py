"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the feed adapters) as a whole
and runs the library operators on them; none caps, samples or filters rows
to keep a check cheap. Column names equal those of the DuckDB oracle in
:mod:`feedloom.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import bundled, load_mappings, match_rules_df, sheet_rules_df, MAPPINGS_DIR
from ..functions.convert import to_bool, to_decimal, to_int, to_money
from ..functions.headers import norm_header, norm_header_raw, safe_table_name
from ..functions.text import clean_text, has_text, is_blank, source_na
from ..operators import files as FL
from ..operators import landing as L
from ..operators import merge as M
from ..operators import report as R
from ..operators import validate as V
from ..operators.classify import classify, classify_layer, column_value_substring_table, feed_columns
from ..operators.mapping import conversion_audit, first_non_null, union_vendors
from ..operators.moves import names_in
from ..operators.snapshots import read_snapshot
from ..plans.ingest import as_feed, canonical_rows, ingest_cells, ingest_delimited, normalize_feed, probe_columns, run_folder
from ..schema import ROW
from ..session import scratch_path, stage_table
from ..sources import adapters as A
from ..sources.delimited import delimited_cells
from ..sources.raw_store import read_raw_rows, write_raw_rows

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Fixed parameters of the checks (not data filters).
RUN_ID = 20260202101010
RUN_STAMP = "20260202_101010"
FEED_TEXT = ["sku", "short_description", "product_name", "dnprice", "lamps_supplied", "glass",
             "shade_material", "blade_span", "canopy_height_inches", "currency_code"]
STAGING_CELL_CHARS = 8
FAILED_FILE = "feed_3.xlsx"
LOADED_AT = "2026-02-02 10:10:10"


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ helpers
def _layered() -> dict:
    return bundled("parts_layered")


def _rules() -> dict:
    return bundled("parts_rules")


def _parts(spark, sf) -> DataFrame:
    return A.feed_parts(spark, sf)


def _feed(spark, sf) -> DataFrame:
    """feed_parts as a normalised wide feed with its reserved columns."""
    return normalize_feed(as_feed(_parts(spark, sf), row="row_idx", file="file_name", vendor="vendor_code", kinds={"sku": "sku_kind"}))


def _rows(spark, sf, cfg=None, run_id=None, keep=()) -> DataFrame:
    return canonical_rows(_feed(spark, sf), cfg or _layered(), run_id=run_id, normalize=False, keep=keep)


def _grid_cells(spark, sf) -> DataFrame:
    """The grid's cells, written once: its row numbers are worked out once
    however many steps read them."""
    return stage_table(A.feed_grid(spark, sf).withColumn("file_name", F.lit(A.GRID_FILE)), "grid")


def _landing(spark, sf) -> dict:
    return L.raw_landing(_grid_cells(spark, sf), stage=False)


def _vendors() -> list[dict]:
    return load_mappings(MAPPINGS_DIR / "vendors.yaml")


def _inventory(spark, sf) -> DataFrame:
    return FL.file_inventory(A.feed_files(spark, sf), exclude_dirs=["/in/archive", "/in/error", "/in/log"], number=False)


def _matched(spark, sf) -> DataFrame:
    return FL.vendor_match(_inventory(spark, sf), match_rules_df(spark, _vendors()))


def _target_and_batch(spark, sf, cfg=None):
    """Existing snapshots (even rows merged into empty tables) and the whole batch."""
    # The canonical batch feeds both folds; it is staged once.
    rows = stage_table(_rows(spark, sf, cfg), "canonical-batch")
    ok = rows.filter(F.col("status") == "ok")
    # The existing snapshots come from merging the even rows into empty tables.
    target = M.merge_run({}, ok.filter(F.col("row_idx") % 2 == 0))
    return target, ok


def _merged(spark, sf, cfg=None) -> dict:
    target, ok = _target_and_batch(spark, sf, cfg)
    return M.merge_run(target, ok)


# ------------------------------------------------------------ A: sources
@query("file_inventory")
def q_file_inventory(spark, sf):
    inv = FL.file_inventory(A.feed_files(spark, sf), exclude_dirs=["/in/archive", "/in/error", "/in/log"])
    return inv.select("file_id", "path", "file_name", "ext", "file_seq")


@query("vendor_match")
def q_vendor_match(spark, sf):
    return _matched(spark, sf).select("file_id", "file_name", "vendor_code", "status")


#: Files named after orders; mappings of one supplier each (its number where the
#: customer's stands) and, after them, of one part each (the end of the order key).
MANY_FILES_SQL = "SELECT concat('/in/Feed#', lpad(CAST(o_custkey AS STRING), 9, '0'), '_', CAST(o_orderkey AS STRING), '.xlsx') AS path FROM {orders}"
MANY_PATTERNS_SQL = """
SELECT CAST(s_suppkey AS INT) AS mapping_seq, 0 AS pattern_seq, s_name AS vendor_code, concat('#', lpad(CAST(s_suppkey AS STRING), 9, '0')) AS pattern FROM {supplier}
UNION ALL
SELECT CAST(2000000000 - p_partkey AS INT), 1, p_brand, concat(CAST(p_partkey AS STRING), '.xlsx') FROM {part}
UNION ALL
SELECT 2000000000, CAST(p_partkey AS INT), p_type, right(CAST(p_partkey AS STRING), 2) FROM {part}
"""


@query("vendor_match_many")
def q_vendor_match_many(spark, sf):
    """A2 with as many patterns as suppliers and parts, long and short ones."""
    files = spark.sql(MANY_FILES_SQL, orders=A.table(spark, sf, "orders"))
    rules = spark.sql(MANY_PATTERNS_SQL, supplier=A.table(spark, sf, "supplier"), part=A.table(spark, sf, "part"))
    found = FL.vendor_match(FL.with_name_parts(files), rules, inline=0)
    return found.select("file_name", "vendor_code", "mapping_seq", "status")


@query("sheet_select")
def q_sheet_select(spark, sf):
    cells = _grid_cells(spark, sf)
    sheets = cells.groupBy("sheet_name").agg(F.count_distinct("row_idx").alias("n_rows"))
    rules = sheet_rules_df(spark, [m for m in _vendors() if m["vendor_code"] == "Brands"])
    return sheets.join(rules, "sheet_name").select(
        "sheet_name", "header_row", "sheet_seq", "n_rows")


@query("empty_sheet_skip")
def q_empty_sheet_skip(spark, sf):
    cells = L.with_source_na(_grid_cells(spark, sf))
    headers = L.detect_header(cells)
    data = L.data_cells(cells, headers)
    per = data.groupBy("sheet_name").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count("text").alias("n_values"))
    return per.withColumn("status", F.when(F.col("n_values") == 0, F.lit("skipped_empty")).otherwise(F.lit("ok")))


@query("na_tokens")
def q_na_tokens(spark, sf):
    p = _parts(spark, sf)
    return p.select("row_idx", *[source_na(F.col(c)).alias(c) for c in FEED_TEXT])


# ------------------------------------------------------------ B: headers
@query("norm_header")
def q_norm_header(spark, sf):
    h = A.feed_headers(spark, sf)
    return h.select("sheet_name", "col_idx", "original_header", norm_header(F.col("original_header")).alias("normalized_header"))


@query("norm_header_raw")
def q_norm_header_raw(spark, sf):
    h = A.feed_headers(spark, sf)
    return h.select("sheet_name", "col_idx", "original_header", norm_header_raw(F.col("original_header")).alias("normalized_header"))


@query("safe_table_name")
def q_safe_table_name(spark, sf):
    f = FL.with_name_parts(A.feed_files(spark, sf))
    return f.select("file_id", safe_table_name("RAW", F.col("stem"), F.lit("DATA (main)")).alias("table_name"))


#: part as delimited lines: a file for each size, a title and a header
#: record, then records with line feeds, quotes and separators inside fields.
CSV_LINES_SQL = """
SELECT CAST(p_size AS INT) AS block, p_partkey AS place,
       concat(CAST(p_partkey AS STRING), ',"', p_name, ', ""', p_type, '""', CASE WHEN p_size % 3 = 0 THEN '\\n' ELSE '' END, p_brand, '",',
              CASE WHEN p_size % 7 = 0 THEN '' ELSE CAST(p_size AS STRING) END, ',', CAST(p_size AS STRING), '" wide') AS line
FROM {part}
UNION ALL
SELECT DISTINCT CAST(p_size AS INT), -2, 'Price list,,,' FROM {part}
UNION ALL
SELECT DISTINCT CAST(p_size AS INT), -1, 'Key,"Name",Size,"Note ""n"" x"' FROM {part}
"""


def _part_files(spark, sf) -> str:
    """part written as delimited files; their folder."""
    path = scratch_path(spark, "csv")
    lines = spark.sql(CSV_LINES_SQL, part=A.table(spark, sf, "part"))
    (lines.repartition("block").sortWithinPartitions("block", "place").select("line", "block")
     .write.partitionBy("block").text(path))
    return path


@query("run_folder_csv")
def q_run_folder_csv(spark, sf):
    """A whole run over a folder of delimited files, moved when read,
    and a second run over what is left (nothing). Per file: its counters, and how
    many files lie in the archive and in the folder after both runs."""
    path, root = _part_files(spark, sf), scratch_path(spark, "run")
    cfg = {"vendor_code": "Sizes", "file_match": [".txt"], "sheets": [{"sheet_name": "DATA", "header_row": 1}], "category": {"default": "fans"},
           "column_map": {"core": {"inventory_partno": ["key"], "marketing_description": ["name"], "bulb_quantity": ["size"]}}, "conversions": {"int": ["bulb_quantity"]}}
    reports = [run_folder(spark, path, [cfg], f"{root}/tables", f"{root}/archive", f"{root}/error", f"{RUN_STAMP}_{k}", source=ingest_delimited) for k in (1, 2)]
    core = read_snapshot(spark, f"{root}/tables")["core"].groupBy().agg(F.count("*").alias("n_products"), F.sum("bulb_quantity").alias("sum_quantity"))
    archived = len(names_in(spark, [f"{root}/archive"]).filter(F.col("file_name").endswith(".txt")).collect())
    block = F.regexp_extract("path", "block=([0-9]+)", 1).cast("int")
    first, second = reports
    return (first.select(block.alias("block"), "status", "rows_total", "rows_upserted", F.col("archived_to").isNotNull().alias("archived"), F.col("move_error").alias("move_error"))
            .join(core).withColumns({"files_archived": F.lit(archived).cast("long"), "files_left": F.lit(second.count()).cast("long")}))


@query("csv_cells")
def q_csv_cells(spark, sf):
    """A4 on delimited files: part written as such files, read back as cells."""
    path = _part_files(spark, sf)
    block = F.regexp_extract("file_path", "block=([0-9]+)", 1).cast("int")
    return delimited_cells(spark, path).select(block.alias("block"), "row_idx", "col_idx", "kind", "text")


@query("detect_header")
def q_detect_header(spark, sf):
    h = L.detect_header(L.with_source_na(_grid_cells(spark, sf)))
    return h.select("sheet_name", "header_row", "score")


@query("dedupe_headers")
def q_dedupe_headers(spark, sf):
    h = A.feed_headers(spark, sf).withColumn("file_name", F.lit("headers.xlsx"))
    names = L.column_names(h, h.select("file_name", "sheet_name", "col_idx"), wide=True)
    return names.select("sheet_name", "col_idx", "normalized_header", "stored_column_name")


@query("column_map")
def q_column_map(spark, sf):
    return _landing(spark, sf)["column_map"]


# ------------------------------------------------------------ C: cleaning
@query("drop_empty_rows")
def q_drop_empty_rows(spark, sf):
    cells = L.with_source_na(_grid_cells(spark, sf))
    data = L.data_cells(cells, L.detect_header(cells))
    return L.live_rows(data).select("sheet_name", "header_row", "row_idx")


@query("drop_empty_cols")
def q_drop_empty_cols(spark, sf):
    cells = L.with_source_na(_grid_cells(spark, sf))
    data = L.data_cells(cells, L.detect_header(cells))
    return L.live_columns(data).select("sheet_name", "col_idx")


@query("clean_text")
def q_clean_text(spark, sf):
    p = _parts(spark, sf)
    return p.select("row_idx", *[clean_text(F.col(c)).alias(c) for c in FEED_TEXT])


@query("is_blank")
def q_is_blank(spark, sf):
    p = _parts(spark, sf)
    return p.select("row_idx", *[is_blank(F.col(c)).alias(f"{c}_blank") for c in FEED_TEXT])


@query("renumber_rows")
def q_renumber_rows(spark, sf):
    cells = L.with_source_na(_grid_cells(spark, sf))
    data = L.data_cells(cells, L.detect_header(cells))
    return L.renumber_rows(L.live_rows(data)).select("sheet_name", "row_idx", "source_row_number")


# ------------------------------------------------------------ D: conversions
CONVERT_INPUTS = ["dnprice", "lamps_supplied", "canopy_height_inches", "blade_span", "sku", "short_description"]


def _convert_query(fn):
    def q(spark, sf):
        p = _parts(spark, sf)
        return p.select("row_idx", *[fn(F.col(c)).alias(c) for c in CONVERT_INPUTS])
    return q


REGISTRY["to_decimal"] = _convert_query(to_decimal)
REGISTRY["to_money"] = _convert_query(to_money)
REGISTRY["to_int"] = _convert_query(to_int)
REGISTRY["to_bool"] = _convert_query(to_bool)


@query("apply_conversions")
def q_apply_conversions(spark, sf):
    r = _rows(spark, sf)
    return r.select(
        "row_idx", "wholesale_price",
        F.col("lighting.bulb_included").alias("bulb_included"),
        F.col("lighting.canopy_height_in").alias("canopy_height_in"),
        F.col("fans.blade_span_in").alias("blade_span_in"),
    )


@query("conversion_audit")
def q_conversion_audit(spark, sf):
    cfg = _layered()
    return conversion_audit(classify(_feed(spark, sf), cfg), cfg)


def _two_kinds() -> dict:
    """A mapping with fields under two conversions."""
    cfg = _layered()
    cfg["column_map"]["core"]["bulb_quantity"] = ["canopy_height_inches", "dnprice"]
    cfg["column_map"]["core"]["is_imap"] = ["lamps_supplied"]
    cfg["conversions"] = {"money": ["wholesale_price", "bulb_quantity"], "int": ["bulb_quantity"], "bool": ["is_imap", "bulb_included"],
                          "decimals": ["canopy_height_in", "blade_span_in", "diameter_in"]}
    return cfg


@query("conversions_in_turn")
def q_conversions_in_turn(spark, sf):
    """D5 on a field listed under two kinds: the second reads the first's result."""
    return _rows(spark, sf, _two_kinds()).select("row_idx", "wholesale_price", "bulb_quantity", "is_imap")


# ------------------------------------------------------------ E: mapping
E1_FIELDS = {"shade": ["glass", "shade_material"], "inventory_partno": ["sku"],
             "description": ["short_description", "product_name"], "missing_then_glass": ["no_such_column", "glass"]}


@query("first_non_null_wide")
def q_first_non_null_wide(spark, sf):
    p = _feed(spark, sf)
    wide = p.select(F.col(ROW).alias("row_idx"), *[first_non_null(p.columns, c).alias(f) for f, c in E1_FIELDS.items()])
    stack = ", ".join(f"'{f}', `{f}`" for f in E1_FIELDS)
    return wide.selectExpr("row_idx", f"stack({len(E1_FIELDS)}, {stack}) AS (field, value)").filter(
        F.col("value").isNotNull())


@query("first_non_null_long")
def q_first_non_null_long(spark, sf):
    """E1 on the long form: melt, join with the alias table, and pick the first alias with text per (row, field). Serves many vendors in
    one plan without one expression per alias."""
    p = _feed(spark, sf)
    feed_cols = [c for c in FEED_TEXT if c in p.columns]
    stack = ", ".join(f"'{c}', `{c}`" for c in feed_cols)
    long = p.selectExpr(f"{ROW} AS row_idx", f"stack({len(feed_cols)}, {stack}) AS (source_col, value)")
    aliases = spark.createDataFrame(
        [(f, a, i) for f, cs in E1_FIELDS.items() for i, a in enumerate(cs)],
        "field string, source_col string, priority int")
    picked = long.join(aliases, "source_col").filter(has_text(F.col("value")))
    return picked.groupBy("row_idx", "field").agg(F.min_by("value", "priority").alias("value"))


@query("core_projection")
def q_core_projection(spark, sf):
    r = _rows(spark, sf)
    return r.drop("file_seq", "sheet_seq", "source_path", "lighting", "fans", "light_bulbs", "inventory_partno_kind", "rejected_field", "status")


@query("category_projection")
def q_category_projection(spark, sf):
    r = _rows(spark, sf)
    return r.filter(F.col("lighting").isNotNull()).select("row_idx", "category_type", "lighting.*")


@query("category_projection_fans")
def q_category_projection_fans(spark, sf):
    r = _rows(spark, sf)
    return r.filter(F.col("fans").isNotNull()).select("row_idx", "category_type", "fans.*")


@query("default_currency")
def q_default_currency(spark, sf):
    return _rows(spark, sf, _rules()).select("row_idx", "currency_code")


@query("lineage")
def q_lineage(spark, sf):
    r = _rows(spark, sf, run_id=RUN_ID)
    return r.select("row_idx", "source_file_name", "source_sheet_name", "source_row_number", "run_id")


@query("vendor_union")
def q_vendor_union(spark, sf):
    a = _rows(spark, sf, _layered()).withColumn("mapping", F.lit("parts_layered"))
    b = _rows(spark, sf, _rules()).withColumn("mapping", F.lit("parts_rules"))
    return union_vendors([a, b]).select("mapping", "row_idx", "vendor_code", "inventory_partno", "category_type", "status")


# ------------------------------------------------------------ F: classification
def _classified(spark, sf, cfg, layer_col=None):
    return classify(_feed(spark, sf), cfg, layer_col=layer_col).withColumnRenamed(ROW, "row_idx")


@query("classify_default")
def q_classify_default(spark, sf):
    cfg = dict(_layered(), category={"strategy": "default"})
    return _classified(spark, sf, cfg).select("row_idx", "category_type")


@query("classify_rules")
def q_classify_rules(spark, sf):
    return _classified(spark, sf, _rules()).select("row_idx", "category_type")


def _layer_query(layer):
    def q(spark, sf):
        df = classify_layer(_feed(spark, sf), _layered(), layer)
        return df.select(F.col(ROW).alias("row_idx"), "category_type")
    return q


@query("classify_substring_table")
def q_classify_substring_table(spark, sf):
    """F4 through the rule array (the many-values form)."""
    df = column_value_substring_table(_feed(spark, sf), _layered())
    return df.select(F.col(ROW).alias("row_idx"), "category_type")


@query("classify_substring_join")
def q_classify_substring_join(spark, sf):
    """F4 through the trigram join (the form without a limit of values)."""
    df = column_value_substring_table(_feed(spark, sf), _layered(), inline=0)
    return df.select(F.col(ROW).alias("row_idx"), "category_type")


REGISTRY["classify_exact"] = _layer_query("column_value_exact")
REGISTRY["classify_substring"] = _layer_query("column_value_substring")
REGISTRY["classify_regex"] = _layer_query("regex_scan")
REGISTRY["classify_features"] = _layer_query("feature_presence")


@query("classify_layered")
def q_classify_layered(spark, sf):
    return _classified(spark, sf, _layered(), layer_col="category_layer").select("row_idx", "category_type", "category_layer")


@query("classify_documents")
def q_classify_documents(spark, sf):
    """F5 over all documents: the regex layer on full texts."""
    docs = A.table(spark, sf, "documents").select("doc_id", "text")
    cfg = {"category": {"regex_scan": dict(_layered()["category"]["regex_scan"], columns=["text"])}}
    return classify_layer(docs, cfg, "regex_scan").select("doc_id", "category_type")


# Patterns that Python accepts in forms Java writes otherwise: an ASCII flag, a
# verbose one, one group name in two patterns, a back-reference by name.
ODD_PATTERNS = [
    {"category_type": "ascii", "any_regex": [r"(?a)\bchair\b"]},
    {"category_type": "verbose", "any_regex": ["(?x) wall \\s art  # two words"]},
    {"category_type": "named", "any_regex": [r"(?P<w>remote) for", r"(?P<w>PENDANT)$"]},
    {"category_type": "twice", "any_regex": [r"(?P<x>[a-z])(?P=x)"]},
    {"category_type": "broken", "any_regex": ["(unclosed"]},
]


@query("classify_regex_forms")
def q_classify_regex_forms(spark, sf):
    cfg = {"category": {"regex_scan": {"columns": ["short_description"], "rules": ODD_PATTERNS}}}
    return classify_layer(_feed(spark, sf), cfg, "regex_scan").select(F.col(ROW).alias("row_idx"), "category_type")


# ------------------------------------------------------------ G: validation
@query("missing_key_filter")
def q_missing_key_filter(spark, sf):
    r = _rows(spark, sf)
    return r.filter(F.col("status") == "skipped").select("row_idx", F.col("source_file_name").alias("file"))


@query("missing_key_sample")
def q_missing_key_sample(spark, sf):
    p = _feed(spark, sf)
    r = _rows(spark, sf, keep=probe_columns(p))
    return V.missing_key_sample(r, feed_columns(p.columns)).select(
        "file", "sheet", "row_idx", "sample_rank", F.array_join("cols_first40", ",").alias("cols_first40"), "probe_sku")


@query("quarantine")
def q_quarantine(spark, sf):
    return _rows(spark, sf).select("row_idx", "vendor_code", "inventory_partno", "inventory_partno_kind", "status")


@query("error_rows")
def q_error_rows(spark, sf):
    return V.error_rows(_rows(spark, sf), with_timestamp=False)


@query("bad_row_locate")
def q_bad_row_locate(spark, sf):
    land = _landing(spark, sf)["landing"]
    checks = {
        "source_file_len": F.length("source_file") <= 260,
        "source_sheet_len": F.length("source_sheet") <= 200,
        "cell_len": F.coalesce(F.length("value"), F.lit(0)) <= STAGING_CELL_CHARS,
    }
    return V.locate_bad_rows(land, checks, ["source_file", "source_sheet"], "source_row_number", ["col_idx"])


# ------------------------------------------------------------ H: merge
@query("last_write_wins")
def q_last_write_wins(spark, sf):
    ok = _rows(spark, sf).filter(F.col("status") == "ok")
    lww = M.last_write_wins(ok)
    return lww.select(*M.KEY, *M.CORE_ATTRS, "n_rows")


@query("merge_core")
def q_merge_core(spark, sf):
    return _merged(spark, sf)["core"]


@query("merge_currency")
def q_merge_currency(spark, sf):
    return _merged(spark, sf)["core"].select(*M.KEY, "currency_code")


@query("surrogate_ids")
def q_surrogate_ids(spark, sf):
    return _merged(spark, sf)["core"].select("product_id", *M.KEY)


@query("merge_lighting")
def q_merge_lighting(spark, sf):
    return _merged(spark, sf)["lighting"]


@query("merge_fans")
def q_merge_fans(spark, sf):
    return _merged(spark, sf)["fans"]


@query("merge_bulbs")
def q_merge_bulbs(spark, sf):
    return _merged(spark, sf, _rules())["light_bulbs"]


@query("insert_if_absent")
def q_insert_if_absent(spark, sf):
    m = _merged(spark, sf)
    return m["accessories"].withColumn("table", F.lit("accessories")).unionByName(
        m["home_decor"].withColumn("table", F.lit("home_decor")))


@query("route_categories")
def q_route_categories(spark, sf):
    ok = _rows(spark, sf).filter(F.col("status") == "ok")
    return ok.select("row_idx", *M.KEY, M.route_column().alias("route"))


@query("atomic_files")
def q_atomic_files(spark, sf):
    """H8: a file that cannot be read contributes nothing; files with row errors do."""
    rows = _rows(spark, sf)
    failed = rows.select(F.col("source_path").alias("path")).distinct().filter(F.col("path") == FAILED_FILE)
    ok = M.exclude_failed_files(rows.filter(F.col("status") == "ok"), failed)
    return M.merge_run({}, ok)["core"]


@query("raw_landing")
def q_raw_landing(spark, sf):
    return _landing(spark, sf)["landing"]


@query("raw_tables")
def q_raw_tables(spark, sf):
    return _landing(spark, sf)["tables"].select("sheet_name", "header_row", "table_name")


@query("raw_tables_wide")
def q_raw_tables_wide(spark, sf):
    """H9 + H10: the wide landing tables of all sheets, one below the other (the
    grid's sheets have the same columns)."""
    land = _landing(spark, sf)
    names = [f"head_{i}" for i in range(4)]
    tables = land["tables"].select(F.col("file_name").alias("source_file"), F.col("sheet_name").alias("source_sheet"), "table_name")
    wide = L.landing_wide(land["landing"], names, LOADED_AT).join(tables, ["source_file", "source_sheet"])
    return wide.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query("raw_tables_apart")
def q_raw_tables_apart(spark, sf):
    """H9 + H10: sheets whose columns differ (each header has its sheet's name in
    it), written by one job, loaded a second time, and read back: every value by
    table, row and column."""
    cells = _grid_cells(spark, sf)
    own = F.when(F.col("text").startswith("Head "), F.concat("text", F.lit(" "), "sheet_name")).otherwise(F.col("text"))
    land = L.raw_landing(cells.withColumn("text", own), stage=False)
    root = scratch_path(spark, "raw")
    for _ in range(2):
        write_raw_rows(land, root, LOADED_AT)
    rows = read_raw_rows(spark, root)
    return rows.select("table_name", "raw_id", "source_sheet", "header_row", F.explode("values").alias("stored_column_name", "value"))


# ------------------------------------------------------------ I: reports
@query("file_counters")
def q_file_counters(spark, sf):
    return R.file_counters(_rows(spark, sf))


@query("category_counts")
def q_category_counts(spark, sf):
    return R.category_counts(_rows(spark, sf))


@query("category_totals")
def q_category_totals(spark, sf):
    return R.category_totals(_rows(spark, sf)).drop("path").withColumn("level", F.col("level").cast("bigint"))


@query("run_report")
def q_run_report(spark, sf):
    """One report over the files of the inventory and of feed_parts, of which one
    could not be read."""
    rows = _rows(spark, sf).filter(F.col("source_path") != FAILED_FILE)
    fed = _rows(spark, sf).select(F.col("source_path").alias("path"), F.col("source_file_name").alias("file_name")).distinct()
    fed = fed.withColumns({"vendor_code": F.lit("Parts Feed"), "status": F.lit("matched"), "reason": F.lit(None).cast("string")})
    files = _matched(spark, sf).filter(F.col("status") == "skipped").select("path", "file_name", "vendor_code", "status", "reason").unionByName(fed)
    fatal = fed.filter(F.col("path") == FAILED_FILE).select("path", F.lit("BadZipFile: File is not a zip file").alias("reason"))
    report = R.run_report(rows, R.file_status(files, fatal), "/in")
    categories = F.array_join(F.transform(F.map_entries("by_category"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return report.withColumn("by_category", categories).drop("archived_to", "move_error")


@query("disposition")
def q_disposition(spark, sf):
    """The inventory's files, each of them also under another folder with the
    same name, and every fifth of them unreadable."""
    matched = _matched(spark, sf)
    twin = matched.withColumn("path", F.concat(F.lit("/in/twin/"), F.col("file_name")))
    both = matched.unionByName(twin).withColumn("status", F.when((F.col("status") == "matched") & (F.col("file_id") % 5 == 0), F.lit("failed")).otherwise(F.col("status")))
    existing = FL.with_name_parts(A.feed_files(spark, sf)).filter(F.col("path").startswith("/in/archive/")).select(
        F.lit("/in/archive").alias("dir"), "file_name")
    d = FL.disposition(both, existing, RUN_STAMP)
    return d.select("file_id", "path", "file_name", "disposition", "moved_to")


# ------------------------------------------------------------ A3/A4: sheets as cells
# Display headers the supplier sheet carries for each feed_parts column.
PART_HEADERS = {"sku": "SKU", "short_description": "Short Description", "product_name": "Product  Name", "dnprice": "DNPrice",
                "lamps_supplied": "Lamps Supplied", "glass": "Glass", "shade_material": "Shade  Material ", "blade_span": "Blade Span",
                "canopy_height_inches": "Canopy Height (Inches)", "currency_code": "Currency Code"}
# Columns of the sheet that have the names of pipeline columns, and of a feature.
OWN_HEADERS = {"vendor_code": "Vendor Code", "file_name": "File Name", "bulb_kind": "Bulb Kind"}
SHEET_ROWS = 1 << 16


def _parts_as_cells(spark, sf, headers: dict) -> DataFrame:
    """feed_parts as cells of many supplier files: a file holds the rows of one
    range of keys (as many files as the data needs), header row 0 in every file
    and one row per part below it."""
    p = _parts(spark, sf).withColumns({"bulb_kind": F.col("glass"), "block": F.expr(f"row_idx div {SHEET_ROWS}"), "at": F.col("row_idx") % SHEET_ROWS + 1})
    p = p.withColumns({"file_path": F.concat(F.lit("/in/feed_block_"), F.lpad(F.col("block").cast("string"), 12, "0"), F.lit(".xlsx")), "sheet_name": F.lit("DATA")})
    cols = list(headers)
    kind = {"sku": F.col("sku_kind")}
    body = p.select("file_path", "sheet_name", F.col("at").alias("row_idx"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("col_idx"), kind.get(c, F.lit("s")).alias("kind"), F.col(c).cast("string").alias("text")) for i, c in enumerate(cols)])).alias("c"))
    head = p.select("file_path", "sheet_name").distinct().select("file_path", "sheet_name", F.lit(0).cast("bigint").alias("row_idx"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("col_idx"), F.lit("s").alias("kind"), F.lit(headers[c]).alias("text")) for i, c in enumerate(cols)])).alias("c"))
    cells = head.unionByName(body).select("file_path", "sheet_name", "row_idx", "c.col_idx", "c.kind", "c.text")
    return cells.filter(F.col("text").isNotNull())


def _sheet_ingest(spark, sf, headers: dict, cfg: dict) -> dict:
    cells = stage_table(_parts_as_cells(spark, sf, headers), "cells")
    files = FL.vendor_match(FL.with_name_parts(cells.select(F.col("file_path").alias("path")).distinct()).withColumn("file_seq", F.split("path", "/")),
                            match_rules_df(spark, [cfg]))
    return ingest_cells(cells, files, [cfg], input_dir="/in")


@query("sheet_scan")
def q_sheet_scan(spark, sf):
    """A3: feed_parts as cells of many sheets, read by configured sheet and header
    row, then the whole mapped pipeline. Row r of block b is part b * 65536 + r."""
    rows = _sheet_ingest(spark, sf, PART_HEADERS, _layered())["rows"]
    block = F.regexp_extract("source_path", r"(\d+)\.xlsx$", 1).cast("bigint")
    part = block * SHEET_ROWS + F.col("row_idx")
    last = A.table(spark, sf, "part").select(F.col("p_partkey").alias("part_key"))
    # Positions without a part are empty rows of the sheet, kept and skipped.
    return rows.withColumn("part_key", part).join(last, "part_key").select(
        "part_key", "vendor_code", "inventory_partno", "category_type", "wholesale_price", "status")


@query("sheet_own_columns")
def q_sheet_own_columns(spark, sf):
    """Sheets with columns named like the pipeline's own: the vendor stays the
    mapping's, and rules see the sheet's column."""
    cfg = _layered()
    cfg["category"] = {"strategy": "rules", "rules": [{"if_any_field_present": ["bulb_kind"], "category_type": "light_bulbs"}, {"default": "lighting"}]}
    cfg["column_map"]["core"]["location"] = ["vendor_code"]
    cfg["column_map"]["core"]["collection"] = ["file_name"]
    rows = _sheet_ingest(spark, sf, PART_HEADERS | OWN_HEADERS, cfg)["rows"]
    part = F.regexp_extract("source_path", r"(\d+)\.xlsx$", 1).cast("bigint") * SHEET_ROWS + F.col("row_idx")
    return rows.withColumn("part_key", part).join(A.table(spark, sf, "part").select(F.col("p_partkey").alias("part_key")), "part_key").select(
        "part_key", "vendor_code", "location", "collection", "category_type")


@query("typed_cells")
def q_typed_cells(spark, sf):
    """A4: the raw typed-cell scan with source NA tokens out, on the long form."""
    cells = L.with_source_na(_grid_cells(spark, sf))
    return cells.filter(F.col("kind").isNotNull()).select("sheet_name", "row_idx", "col_idx", "kind", "text")


# ------------------------------------------------------------ J1: drop folder
FEED_SCHEMA = "row_idx long, vendor_code string, file_name string, file_seq string, sku string, sku_kind string, " + ", ".join(f"{c} string" for c in FEED_TEXT if c != "sku")


@query("drop_folder_stream")
def q_drop_folder_stream(spark, sf):
    """feed_parts dropped as Parquet files, as many as its size asks for,
    ingested by an ``availableNow`` stream into a bucketed, versioned snapshot;
    returns the final core."""
    from ..streaming import drop_folder as D

    root = scratch_path(spark, "drop")
    cols = [c.split()[0] for c in FEED_SCHEMA.split(", ")]
    _parts(spark, sf).withColumn("file_seq", F.col("file_name")).select(*cols).write.option("maxRecordsPerFile", 1 << 20).parquet(f"{root}/in")
    cfg = dict(_layered(), file_match=[".parquet"])
    D.start_feed(spark, f"{root}/in", [cfg], f"{root}/snapshot", f"{root}/checkpoint", FEED_SCHEMA, columns={
        "row": "row_idx", "file": "file_name", "file_seq": "file_seq", "vendor": "vendor_code", "kinds": {"sku": "sku_kind"}}, buckets=4).awaitTermination()
    core = D.latest_snapshot(spark, f"{root}/snapshot", f"{root}/checkpoint")["core"]
    return core.select("vendor_code", "inventory_partno", "category_type", "wholesale_price",
                       "currency_code", "source_file_name", "marketing_description")


@query("snapshot_two_jobs")
def q_snapshot_two_jobs(spark, sf):
    """Two stream jobs with checkpoints of their own over one root, one
    fed with all files but the last, one with all but the first; then the first
    job is started again and its batch replayed. Returns the final core with ids."""
    from ..operators import snapshots as S
    from ..streaming import drop_folder as D

    root = scratch_path(spark, "jobs")
    cols = [c.split()[0] for c in FEED_SCHEMA.split(", ")]
    feed = _parts(spark, sf).withColumn("file_seq", F.col("file_name")).select(*cols)
    ends = feed.agg(F.min("file_name"), F.max("file_name")).first()
    cfg = dict(_layered(), file_match=[".parquet"])

    def run(job):
        D.start_feed(spark, f"{root}/in-{job}", [cfg], f"{root}/snapshot", f"{root}/checkpoint-{job}", FEED_SCHEMA, columns={
            "row": "row_idx", "file": "file_name", "file_seq": "file_seq", "vendor": "vendor_code", "kinds": {"sku": "sku_kind"}}).awaitTermination()
    for job, left_out in (("a", ends[1]), ("b", ends[0])):
        feed.filter(F.col("file_name") != left_out).write.option("maxRecordsPerFile", 1 << 20).parquet(f"{root}/in-{job}")
        run(job)
    run("a")
    replayed = _rows(spark, sf).filter((F.col("status") == "ok") & (F.col("source_file_name") != ends[1]))
    S.merge_batch(spark, f"{root}/snapshot", replayed, D.stream_id(spark, f"{root}/checkpoint-a"), 0)
    return D.latest_snapshot(spark, f"{root}/snapshot")["core"].select(*M.CORE_OUT).drop("run_id")


# ------------------------------------------------------------ I4/I5: log files
@query("error_csv_roundtrip")
def q_error_csv_roundtrip(spark, sf):
    """I4: the error log written as CSV (with its timestamp) and read back."""
    path = scratch_path(spark, "ingest-errors")
    errors = V.error_rows(_rows(spark, sf), with_timestamp=True)
    R.write_csv(errors, path)
    schema = ("timestamp timestamp, file string, sheet string, row_index bigint, vendor_code string, "
              "inventory_partno string, category_type string, error_type string, error_message string")
    return R.read_csv(spark, path, schema).drop("timestamp")


@query("conversion_csv_roundtrip")
def q_conversion_csv_roundtrip(spark, sf):
    """The conversion audit written as CSV with sorted columns and read back."""
    path = scratch_path(spark, "conversion-errors")
    cfg = _layered()
    audit = conversion_audit(classify(_feed(spark, sf), cfg), cfg)
    R.write_csv(audit, path, sort_columns=True)
    schema = ", ".join(f"{c} {'bigint' if c == 'row_index' else 'string'}" for c in sorted(audit.columns))
    return R.read_csv(spark, path, schema)


__all__ = ["REGISTRY", "query"]

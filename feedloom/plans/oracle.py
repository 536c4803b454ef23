"""DuckDB oracle SQL for every registered query (same output column names).

Written directly in DuckDB SQL over the pre-registered table views, with
the shared feed adapters as CTEs. Mapping-driven parts (category rules,
alias lists, conversion lists) are spelled out from the same YAML values,
by small string builders, so the oracle states the semantics in SQL
terms: ordered CASE chains, window ranks, full outer joins.
"""

from __future__ import annotations

import copy

from ..config import MAPPINGS_DIR, bundled, load_mappings
from ..sources.adapters import duckdb_cte

# Fixed values, stated here a second time on purpose: the oracle takes none of
# them from the code that it checks.
TRUE_WORDS = ["y", "yes", "true", "1", "included", "include", "t"]
FALSE_WORDS = ["n", "no", "false", "0", "not included", "exclude", "f"]
BLANK_TOKENS = ["", "nan", "none", "null", "n/a", "na", "-", "—"]
RAW_NULL_TOKENS = ["nan", "none", "n/a", "na", "null"]
SOURCE_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                    "NULL", "NaN", "None", "n/a", "nan", "null"]


def _columns(text: str) -> list[tuple[str, str]]:
    return [tuple(x.split(":")) for x in text.split()]


# name:type, T text, F double, I bigint, B boolean
CORE_COLUMNS = _columns("""vendor_code:T inventory_partno:T category_type:T upc:T wholesale_price:F imap_price:F is_imap:B width_in:F height_in:F
length_in:F weight_lb:F shipping_weight_lb:F carton_height_in:F carton_length_in:F carton_width_in:F bulb_quantity:I marketing_description:T
finish:T subcategory:T shipping_type:T collection:T location:T currency_code:T source_file_name:T source_sheet_name:T source_row_number:I run_id:I""")
ATTRIBUTE_TABLES = {
    "lighting": _columns("""type1:T type2:T subtype1:T room_used:T certification_type:T ada:B energy_star:B material:T style:T shade:T voltage:T
bulb_socket:T bulb_included:B bulb_watts:F bulb_shape:T kelvin:I cri:I bulb_dimmable:B lumens:I canopy_height_in:F canopy_length_in:F
canopy_width_in:F canopy_depth_in:F minimum_height_in:F maximum_height_in:F"""),
    "fans": _columns("""type1:T type2:T subtype1:T room_used:T certification_type:T blade_span_in:F blade_count:I blade_color:T blade_pitch:F
cfm_average:I cfm_high:I cfm_average_watts:F cfm_high_watts:F max_angle:F low_rpm:I high_rpm:I motor_watts:F motor_type:T is_flush_mount:B
warranty:T downrod:T control_type:T light_kit_included:B light_kit_watts:F light_kit_kelvin:I light_kit_lumens:I diffuser_type:T style:T"""),
    "light_bulbs": _columns("diameter_in:F"),
}

DTYPE = {"T": "VARCHAR", "F": "DOUBLE", "I": "BIGINT", "B": "BOOLEAN"}
FEED_TEXT = ["sku", "short_description", "product_name", "dnprice", "lamps_supplied", "glass",
             "shade_material", "blade_span", "canopy_height_inches", "currency_code"]
RUN_ID = 20260202101010
RUN_STAMP = "20260202_101010"


def lit(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def inlist(vals) -> str:
    return "(" + ", ".join(lit(v) for v in vals) + ")"


# ---------------------------------------------------------------- scalars
def has_text(x: str) -> str:
    return f"coalesce(trim({x}) <> '', false)"


def blank(x: str) -> str:
    return f"coalesce(lower(trim({x})) IN {inlist(BLANK_TOKENS)}, true)"


def src_na(x: str) -> str:
    return f"CASE WHEN {x} IN {inlist(SOURCE_NA_TOKENS)} THEN NULL ELSE {x} END"


def clean(x: str) -> str:
    return f"CASE WHEN trim({x}) <> '' AND lower(trim({x})) NOT IN {inlist(RAW_NULL_TOKENS)} THEN trim({x}) END"


DEC_RE = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?(?i:inf|infinity)"


def to_decimal(x: str) -> str:
    s1 = f"replace(replace(trim({x}), '$', ''), ',', '')"
    s2 = (f"replace(trim(CASE WHEN regexp_matches({s1}, '\\d+\\s*-\\s*\\d+') "
          f"THEN split_part({s1}, '-', 1) ELSE {s1} END), '_', '')")
    return f"(CASE WHEN NOT {blank(x)} AND regexp_full_match({s2}, '{DEC_RE}') THEN TRY_CAST({s2} AS DOUBLE) END)"


def to_int(x: str) -> str:
    m = f"regexp_extract(trim({x}), '-?[0-9]+', 0)"
    return f"(CASE WHEN NOT {blank(x)} AND {m} <> '' THEN TRY_CAST({m} AS BIGINT) END)"


def to_bool(x: str) -> str:
    s = f"lower(trim({x}))"
    return f"(CASE WHEN {s} IN {inlist(TRUE_WORDS)} THEN true WHEN {s} IN {inlist(FALSE_WORDS)} THEN false END)"


CONV = {"money": to_decimal, "decimals": to_decimal, "int": to_int, "bool": to_bool}


def norm_header(x: str) -> str:
    s = f"lower(trim({x}))"
    s = f"regexp_replace({s}, '\\s+', ' ', 'g')"
    s = f"regexp_replace({s}, '[^\\w\\s]', '', 'g')"
    s = f"replace({s}, ' ', '_')"
    s = f"regexp_replace(regexp_replace({s}, '_+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"coalesce({s}, '')"


def norm_header_raw(x: str) -> str:
    s = f"lower(trim(coalesce({x}, '')))"
    s = f"regexp_replace({s}, '\\s+', '_', 'g')"
    s = f"regexp_replace({s}, '[^\\w]', '', 'g')"
    s = f"regexp_replace(regexp_replace({s}, '_+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"(CASE WHEN {s} = '' THEN 'col' ELSE {s} END)"


def shorten(x: str) -> str:
    return f"(CASE WHEN length({x}) > 120 THEN substring({x}, 1, 111) || '_' || substring(sha1({x}), 1, 8) ELSE {x} END)"


def suffixed(base: str, k: str) -> str:
    sfx = f"('_' || CAST({k} AS VARCHAR))"
    return f"(CASE WHEN {k} > 1 THEN substring({base}, 1, 120 - length({sfx})) || {sfx} ELSE {base} END)"


def safe_table(prefix: str, stem: str, sheet: str) -> str:
    t = f"concat_ws('_', {lit(prefix)}, {stem}, {sheet})"
    t = f"regexp_replace({t}, '[^\\w]', '_', 'g')"
    t = f"regexp_replace(regexp_replace({t}, '_+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"substring({t}, 1, 120)"


# ---------------------------------------------------------------- mapping
def first_non_null(cols, cands) -> str:
    cands = [cands] if isinstance(cands, str) else list(cands or [])
    arms = [f"WHEN {has_text(c)} THEN {c}" for c in cands if c and c in cols]
    return "CAST(NULL AS VARCHAR)" if not arms else "(CASE " + " ".join(arms) + " END)"


def _joined(cols, wanted, sep, lower):
    parts = []
    for c in wanted or []:
        if c in cols:
            v = f"lower(trim({c}))" if lower else f"trim({c})"
            parts.append(f"CASE WHEN trim({c}) <> '' THEN {v} END")
    return "''" if not parts else f"concat_ws({sep}, {', '.join(parts)})"


def feature_present(cols, tokens) -> str:
    toks = [str(t).strip().lower() for t in tokens or [] if str(t).strip()]
    hits = [c for c in cols if any(t in c.lower() for t in toks)]
    return "false" if not hits else "(" + " OR ".join(has_text(c) for c in hits) + ")"


def exact_sql(cols, cv) -> str:
    j = _joined(cols, cv.get("columns"), "' | '", True)
    arms = [f"WHEN {j} <> '' AND {j} IN {inlist([str(v).strip().lower() for v in vals])} THEN {lit(cat)}"
            for cat, vals in (cv.get("mappings") or {}).items() if vals]
    return "CAST(NULL AS VARCHAR)" if not arms else "(CASE " + " ".join(arms) + " END)"


def substring_sql(cols, cv) -> str:
    j = _joined(cols, cv.get("columns"), "' | '", True)
    arms = []
    for cat, vals in (cv.get("mappings") or {}).items():
        vv = [str(v).strip().lower() for v in vals or [] if str(v).strip()]
        if vv:
            arms.append(f"WHEN {j} <> '' AND (" + " OR ".join(f"contains({j}, {lit(v)})" for v in vv) + f") THEN {lit(cat)}")
    return "CAST(NULL AS VARCHAR)" if not arms else "(CASE " + " ".join(arms) + " END)"


def regex_sql(cols, rs) -> str:
    hay = _joined(cols, rs.get("columns"), "chr(10)", False)
    arms = []
    for rule in rs.get("rules") or []:
        pats = rule.get("any_regex") or []
        if not pats:
            continue
        cat = rule.get("category_type")
        val = lit(cat) if cat else "CAST(NULL AS VARCHAR)"
        arms.append(f"WHEN {hay} <> '' AND (" + " OR ".join(f"regexp_matches({hay}, {lit(p)})" for p in pats) + f") THEN {val}")
    return "CAST(NULL AS VARCHAR)" if not arms else "(CASE " + " ".join(arms) + " END)"


def features_sql(cols, fp, default="lighting", with_default=True) -> str:
    arms = [f"WHEN {feature_present(cols, r.get('if_any_field_present'))} THEN {lit(r.get('category_type', default))}"
            for r in fp.get("rules") or []]
    tail = f" ELSE {lit(default)}" if with_default else ""
    if not arms:
        return lit(default) if with_default else "CAST(NULL AS VARCHAR)"
    return "(CASE " + " ".join(arms) + tail + " END)"


def category_sql(cols, cfg) -> str:
    cat = cfg.get("category") or {}
    strat = str(cat.get("strategy") or "default").strip().lower()
    default = cat.get("default", "lighting")
    if strat == "rules":
        arms = []
        for r in cat.get("rules") or []:
            if "default" in r:
                arms.append(f"WHEN true THEN {lit(r['default'])}")
                break
            arms.append(f"WHEN {feature_present(cols, r.get('if_any_field_present'))} THEN {lit(r.get('category_type', default))}")
        return "(CASE " + " ".join(arms) + f" ELSE {lit(default)} END)"
    if strat == "layered":
        cv = cat.get("column_value") or {}
        return (f"coalesce(nullif({exact_sql(cols, cv)}, ''), nullif({substring_sql(cols, cv)}, ''), "
                f"nullif({regex_sql(cols, cat.get('regex_scan') or {})}, ''), "
                f"{features_sql(cols, cat.get('feature_presence') or {}, default)})")
    return lit(default)


def layer_sql(cols, cfg) -> str:
    cat = cfg.get("category") or {}
    cv = cat.get("column_value") or {}
    fp = cat.get("feature_presence") or {}
    any_fp = " OR ".join(feature_present(cols, r.get("if_any_field_present")) for r in fp.get("rules") or []) or "false"
    return (f"(CASE WHEN nullif({exact_sql(cols, cv)}, '') IS NOT NULL THEN 'column_value_exact' "
            f"WHEN nullif({substring_sql(cols, cv)}, '') IS NOT NULL THEN 'column_value_substring' "
            f"WHEN nullif({regex_sql(cols, cat.get('regex_scan') or {})}, '') IS NOT NULL THEN 'regex_scan' "
            f"WHEN {any_fp} THEN 'feature_presence' ELSE 'default' END)")


def converted(cfg, section_map: dict) -> dict[str, str]:
    """field -> SQL of the E1 pick after the configured conversions."""
    rec = {f: first_non_null(FEED_TEXT, c) for f, c in (section_map or {}).items()}
    conv = cfg.get("conversions") or {}
    for kind in ("money", "decimals", "int", "bool"):
        for f in conv.get(kind) or []:
            if f in rec:
                rec[f] = CONV[kind](f"CAST({rec[f]} AS VARCHAR)")
    return rec


def typed(expr: str | None, kind: str) -> str:
    t = DTYPE[kind]
    if expr is None:
        return f"CAST(NULL AS {t})"
    return f"TRY_CAST({expr} AS {t})" if t != "VARCHAR" else f"CAST({expr} AS VARCHAR)"


def rows_cte(cfg, run_id=None, suffix: str = "") -> str:
    """``rows<suffix>``: one canonical row per feed_parts row (as the Spark plan)."""
    cm = cfg.get("column_map") or {}
    core = converted(cfg, cm.get("core"))
    if "currency_code" not in core:
        core["currency_code"] = lit((cfg.get("defaults") or {}).get("currency_code", "USD"))
    fixed = {
        "vendor_code": "vendor_code", "category_type": "category_type",
        "source_file_name": "file_name", "source_sheet_name": lit(cfg["sheets"][0]["sheet_name"]),
        "source_row_number": "row_idx", "run_id": "NULL" if run_id is None else str(run_id),
    }
    sel = ["file_name AS file_seq", "0 AS sheet_seq", "row_idx"]
    for n, k in CORE_COLUMNS:
        sel.append(f"{typed(fixed[n] if n in fixed else core.get(n), k)} AS {n}")
    key = (cm.get("core") or {}).get("inventory_partno") or []
    kind_arms = [f"WHEN {has_text(a)} THEN {a + '_kind' if a == 'sku' else lit('s')}" for a in key if a in FEED_TEXT]
    sel.append("(CASE " + " ".join(kind_arms) + " END) AS inventory_partno_kind" if kind_arms
               else "CAST(NULL AS VARCHAR) AS inventory_partno_kind")
    for table, spec in ATTRIBUTE_TABLES.items():
        rec = converted(cfg, cm.get(table))
        fields = ", ".join(f"{n} := {typed(rec.get(n), k)}" for n, k in spec)
        sel.append(f"CASE WHEN category_type = {lit(table)} THEN struct_pack({fields}) END AS {table}")
    na_cols = ", ".join(f"{src_na(c)} AS {c}" for c in FEED_TEXT)
    status = (f"CASE WHEN NOT {has_text('inventory_partno')} THEN 'skipped' "
              f"WHEN vendor_code IS NULL OR vendor_code = '' "
              f"OR (coalesce(inventory_partno_kind, 's') = 'n' AND coalesce(TRY_CAST(inventory_partno AS DOUBLE), 1.0) = 0) "
              f"OR (coalesce(inventory_partno_kind, 's') = 'b' AND lower(inventory_partno) = 'false') "
              f"THEN 'error' ELSE 'ok' END")
    x = suffix
    return (
        f"src{x} AS (SELECT row_idx, vendor_code, file_name, sku_kind, {na_cols} FROM feed_parts),\n"
        f"cls{x} AS (SELECT *, {category_sql(FEED_TEXT, cfg)} AS category_type FROM src{x}),\n"
        f"rec{x} AS (SELECT {', '.join(sel)} FROM cls{x}),\n"
        f"rows{x} AS (SELECT *, {status} AS status FROM rec{x})"
    )


def with_rows(cfg, run_id=None) -> str:
    return duckdb_cte("feed_parts") + ",\n" + rows_cte(cfg, run_id)


CORE_ATTRS = [n for n, _ in CORE_COLUMNS if n not in ("vendor_code", "inventory_partno")]
KEY = "vendor_code, inventory_partno"
SEQ = "file_seq, sheet_seq, row_idx"


def lww_cte(name: str, src: str) -> str:
    """Last row per key + last non-null currency + first-seen position + per-table last records."""
    attrs = ", ".join(f"l.{c}" for c in CORE_ATTRS if c != "currency_code")
    recs = ", ".join(f"{t}.rec AS {t}_rec" for t in ATTRIBUTE_TABLES)
    rec_ctes = ",\n".join(
        f"{name}_{t} AS (SELECT {KEY}, {t} AS rec FROM {src} WHERE {t} IS NOT NULL "
        f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY file_seq DESC, sheet_seq DESC, row_idx DESC) = 1)"
        for t in ATTRIBUTE_TABLES)
    joins = " ".join(f"LEFT JOIN {name}_{t} {t} USING ({KEY})" for t in ATTRIBUTE_TABLES)
    return (
        f"{name}_last AS (SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY file_seq DESC, sheet_seq DESC, row_idx DESC) = 1),\n"
        f"{name}_first AS (SELECT {KEY}, file_seq AS first_file_seq, sheet_seq AS first_sheet_seq, row_idx AS first_row_idx FROM {src} "
        f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY {SEQ}) = 1),\n"
        f"{name}_cur AS (SELECT {KEY}, currency_code AS cur FROM {src} WHERE currency_code IS NOT NULL "
        f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY file_seq DESC, sheet_seq DESC, row_idx DESC) = 1),\n"
        f"{name}_n AS (SELECT {KEY}, count(*) AS n_rows, bool_or(category_type = 'accessories') AS in_accessories, "
        f"bool_or(category_type = 'home_decor') AS in_home_decor FROM {src} GROUP BY ALL),\n"
        f"{rec_ctes},\n"
        f"{name} AS (SELECT l.vendor_code, l.inventory_partno, {attrs}, c.cur AS currency_code, "
        f"f.first_file_seq, f.first_sheet_seq, f.first_row_idx, n.n_rows, {recs}, n.in_accessories, n.in_home_decor "
        f"FROM {name}_last l JOIN {name}_first f USING ({KEY}) JOIN {name}_n n USING ({KEY}) "
        f"LEFT JOIN {name}_cur c USING ({KEY}) {joins})"
    )


def merge_cte(name: str, target: str | None, folded: str) -> str:
    """Core upsert of ``folded`` into ``target`` (NULL target = empty table)."""
    recs = ", ".join([f"s.{t}_rec" for t in ATTRIBUTE_TABLES] + ["s.in_accessories", "s.in_home_decor"])
    if target is None:
        cols = ", ".join(f"s.{c}" if c != "currency_code" else "coalesce(s.currency_code, 'USD') AS currency_code"
                         for c in CORE_ATTRS)
        return (f"{name} AS (SELECT CAST(row_number() OVER (ORDER BY s.first_file_seq, s.first_sheet_seq, s.first_row_idx) AS BIGINT) "
                f"AS product_id, s.vendor_code, s.inventory_partno, {cols}, {recs} FROM {folded} s)")
    attrs = []
    for c in CORE_ATTRS:
        if c == "currency_code":
            attrs.append("CASE WHEN s.vendor_code IS NOT NULL AND t.vendor_code IS NOT NULL THEN coalesce(s.currency_code, t.currency_code) "
                         "WHEN s.vendor_code IS NOT NULL THEN coalesce(s.currency_code, 'USD') ELSE t.currency_code END AS currency_code")
        else:
            attrs.append(f"CASE WHEN s.vendor_code IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
    return (
        f"{name}_j AS (SELECT t.product_id AS old_id, coalesce(s.vendor_code, t.vendor_code) AS vendor_code, "
        f"coalesce(s.inventory_partno, t.inventory_partno) AS inventory_partno, {', '.join(attrs)}, "
        f"s.first_file_seq, s.first_sheet_seq, s.first_row_idx, {recs} "
        f"FROM {target} t FULL OUTER JOIN {folded} s ON t.vendor_code = s.vendor_code AND t.inventory_partno = s.inventory_partno),\n"
        f"{name} AS (SELECT CAST(coalesce(old_id, (SELECT coalesce(max(product_id), 0) FROM {target}) + "
        f"row_number() OVER (PARTITION BY old_id IS NULL ORDER BY first_file_seq, first_sheet_seq, first_row_idx)) AS BIGINT) AS product_id, "
        f"* EXCLUDE (old_id, first_file_seq, first_sheet_seq, first_row_idx) FROM {name}_j)"
    )


CORE_OUT = "product_id, " + ", ".join(n for n, _ in CORE_COLUMNS)


def attr_cte(name: str, target: str | None, merged: str, table: str) -> str:
    names = [n for n, _ in ATTRIBUTE_TABLES[table]]
    src = f"(SELECT product_id, {table}_rec AS rec FROM {merged} WHERE {table}_rec IS NOT NULL)"
    if target is None:
        return f"{name} AS (SELECT product_id, {', '.join(f'rec.{n} AS {n}' for n in names)} FROM {src})"
    cols = ", ".join(f"CASE WHEN s.product_id IS NOT NULL THEN s.rec.{n} ELSE t.{n} END AS {n}" for n in names)
    return (f"{name} AS (SELECT coalesce(s.product_id, t.product_id) AS product_id, {cols} "
            f"FROM {target} t FULL OUTER JOIN {src} s ON t.product_id = s.product_id)")


def presence_cte(name: str, target: str | None, merged: str, table: str) -> str:
    src = f"SELECT product_id FROM {merged} WHERE coalesce(in_{table}, false)"
    if target is None:
        return f"{name} AS ({src})"
    return f"{name} AS (SELECT product_id FROM {target} UNION ALL ({src} EXCEPT SELECT product_id FROM {target}))"


def merged_sql(cfg, final: str) -> str:
    """Target = even rows merged into empty tables; then the whole batch."""
    ctes = [
        "ok AS (SELECT * FROM rows WHERE status = 'ok')",
        "ok_even AS (SELECT * FROM ok WHERE row_idx % 2 = 0)",
        lww_cte("t_fold", "ok_even"),
        merge_cte("t_core", None, "t_fold"),
        lww_cte("s_fold", "ok"),
        merge_cte("m_core", "t_core", "s_fold"),
    ]
    for t in ATTRIBUTE_TABLES:
        ctes.append(attr_cte(f"t_{t}", None, "t_core", t))
        ctes.append(attr_cte(f"m_{t}", f"t_{t}", "m_core", t))
    for t in ("accessories", "home_decor"):
        ctes.append(presence_cte(f"t_{t}", None, "t_core", t))
        ctes.append(presence_cte(f"m_{t}", f"t_{t}", "m_core", t))
    return with_rows(cfg) + ",\n" + ",\n".join(ctes) + "\n" + final


# ---------------------------------------------------------------- raw path
GRID = "'grid.xlsx'"


def grid_ctes() -> str:
    na = f"(kind = 's' AND text IN {inlist(SOURCE_NA_TOKENS)})"
    return duckdb_cte("feed_grid") + ",\n" + (
        f"cells AS (SELECT {GRID} AS file_name, sheet_name, row_idx, col_idx, "
        f"CASE WHEN {na} THEN NULL ELSE kind END AS kind, CASE WHEN {na} THEN NULL ELSE text END AS text FROM feed_grid),\n"
        "width AS (SELECT file_name, sheet_name, max(col_idx) + 1 AS width FROM cells GROUP BY ALL),\n"
        "scores AS (SELECT c.file_name, c.sheet_name, c.row_idx, "
        f"CAST(3 * count(*) FILTER (WHERE kind = 's' AND {has_text('text')}) + count(kind) "
        "- 0.5 * (count(*) FILTER (WHERE kind IN ('n', 'b')) + (w.width - count(kind))) AS DOUBLE) AS score, w.width "
        "FROM cells c JOIN width w USING (file_name, sheet_name) WHERE c.row_idx < 30 GROUP BY c.file_name, c.sheet_name, c.row_idx, w.width),\n"
        "best AS (SELECT file_name, sheet_name, row_idx AS best_row, score AS best_score FROM scores "
        "QUALIFY row_number() OVER (PARTITION BY file_name, sheet_name ORDER BY score DESC, row_idx) = 1),\n"
        "headers AS (SELECT w.file_name, w.sheet_name, CAST(CASE WHEN b.best_score > -0.5 * w.width THEN b.best_row ELSE 0 END AS INTEGER) AS header_row, "
        "CAST(coalesce(greatest(b.best_score, -0.5 * w.width), -0.5 * w.width) AS DOUBLE) AS score "
        "FROM width w LEFT JOIN best b USING (file_name, sheet_name)),\n"
        "data AS (SELECT c.*, h.header_row FROM cells c JOIN headers h USING (file_name, sheet_name) WHERE c.row_idx > h.header_row),\n"
        "live_rows AS (SELECT DISTINCT file_name, sheet_name, header_row, row_idx FROM data WHERE kind IS NOT NULL),\n"
        "live_cols AS (SELECT DISTINCT file_name, sheet_name, col_idx FROM data WHERE kind IS NOT NULL),\n"
        "renum AS (SELECT *, row_number() OVER (PARTITION BY file_name, sheet_name ORDER BY row_idx) - 1 AS source_row_number FROM live_rows),\n"
        "slots AS (SELECT h.file_name, h.sheet_name, h.header_row, unnest(range(0, w.width)) AS col_idx FROM headers h JOIN width w USING (file_name, sheet_name)),\n"
        "hnames AS (SELECT s.file_name, s.sheet_name, s.header_row, s.col_idx, "
        "CASE WHEN c.kind IS NULL OR c.text IS NULL THEN 'Unnamed: ' || CAST(s.col_idx AS VARCHAR) ELSE c.text END AS raw_name "
        "FROM slots s LEFT JOIN cells c ON c.file_name = s.file_name AND c.sheet_name = s.sheet_name AND c.row_idx = s.header_row AND c.col_idx = s.col_idx),\n"
        "names AS (SELECT file_name, sheet_name, header_row, col_idx, "
        "CASE WHEN k > 0 THEN raw_name || '.' || CAST(k AS VARCHAR) ELSE raw_name END AS original_header FROM "
        "(SELECT *, row_number() OVER (PARTITION BY file_name, sheet_name, raw_name ORDER BY col_idx) - 1 AS k FROM hnames)),\n"
        f"kept AS (SELECT n.*, {norm_header_raw('n.original_header')} AS normalized_header FROM names n "
        "SEMI JOIN live_cols l ON l.file_name = n.file_name AND l.sheet_name = n.sheet_name AND l.col_idx = n.col_idx),\n"
        f"b1 AS (SELECT *, {shorten('normalized_header')} AS base FROM kept),\n"
        f"b2 AS (SELECT *, {suffixed('base', 'k1')} AS s1 FROM (SELECT *, row_number() OVER (PARTITION BY file_name, sheet_name, base ORDER BY col_idx) AS k1 FROM b1)),\n"
        f"colnames AS (SELECT file_name, sheet_name, header_row, col_idx, original_header, normalized_header, {suffixed('s1', 'k2')} AS stored_column_name "
        "FROM (SELECT *, row_number() OVER (PARTITION BY file_name, sheet_name, s1 ORDER BY col_idx) AS k2 FROM b2)),\n"
        "landing AS (SELECT d.file_name AS source_file, d.sheet_name AS source_sheet, CAST(d.header_row AS BIGINT) AS header_row, "
        "CAST(r.source_row_number AS BIGINT) AS source_row_number, d.col_idx, n.stored_column_name, "
        f"{clean('d.text')} AS value FROM data d JOIN renum r USING (file_name, sheet_name, row_idx) "
        "JOIN colnames n USING (file_name, sheet_name, col_idx))"
    )


# ---------------------------------------------------------------- queries
def _conv_sql(fn) -> str:
    cols = ["dnprice", "lamps_supplied", "canopy_height_inches", "blade_span", "sku", "short_description"]
    return duckdb_cte("feed_parts") + f"\nSELECT row_idx, {', '.join(f'{fn(c)} AS {c}' for c in cols)} FROM feed_parts"


E1_FIELDS = {"shade": ["glass", "shade_material"], "inventory_partno": ["sku"],
             "description": ["short_description", "product_name"], "missing_then_glass": ["no_such_column", "glass"]}


def _e1_long() -> str:
    na = ", ".join(f"{src_na(c)} AS {c}" for c in FEED_TEXT)
    arms = " UNION ALL ".join(
        f"SELECT row_idx, {lit(f)} AS field, {first_non_null(FEED_TEXT, cs)} AS value FROM p" for f, cs in E1_FIELDS.items())
    return (duckdb_cte("feed_parts") + f",\np AS (SELECT row_idx, {na} FROM feed_parts)\n"
            f"SELECT * FROM ({arms}) WHERE value IS NOT NULL")


def _layer_sql(layer: str) -> str:
    cfg = bundled("parts_layered")
    cat = cfg["category"]
    expr = {
        "exact": exact_sql(FEED_TEXT, cat["column_value"]),
        "substring": substring_sql(FEED_TEXT, cat["column_value"]),
        "regex": regex_sql(FEED_TEXT, cat["regex_scan"]),
        "features": features_sql(FEED_TEXT, cat["feature_presence"], with_default=False),
    }[layer]
    na = ", ".join(f"{src_na(c)} AS {c}" for c in FEED_TEXT)
    return duckdb_cte("feed_parts") + f",\np AS (SELECT row_idx, {na} FROM feed_parts)\nSELECT row_idx, {expr} AS category_type FROM p"


def _inventory() -> str:
    return duckdb_cte("feed_files") + (
        ",\nnamed AS (SELECT file_id, path, string_split(path, '/')[-1] AS file_name FROM feed_files),\n"
        "typed AS (SELECT *, lower(regexp_extract(file_name, '(\\.[^.]*)$', 1)) AS ext, "
        "regexp_replace(file_name, '\\.[^.]*$', '') AS stem FROM named),\n"
        "inv AS (SELECT *, CAST(row_number() OVER (ORDER BY string_split(path, '/')) AS BIGINT) AS file_seq FROM typed "
        "WHERE NOT starts_with(file_name, '~$') AND ext IN ('.xlsx', '.xlsm', '.xls') "
        "AND NOT starts_with(path, '/in/archive/') AND NOT starts_with(path, '/in/error/') AND NOT starts_with(path, '/in/log/'))")


def _vendor_rules() -> str:
    maps = load_mappings(MAPPINGS_DIR / "vendors.yaml")
    vals = [f"({i}, {j}, {lit(m['vendor_code'])}, {lit(str(p).lower())})"
            for i, m in enumerate(maps) for j, p in enumerate(m.get("file_match") or [])]
    return f"rules(mapping_seq, pattern_seq, vendor_code, pattern) AS (VALUES {', '.join(vals)})"


def _matched() -> str:
    return _inventory() + ",\n" + _vendor_rules() + (
        ",\nmatched AS (SELECT i.*, r.vendor_code, r.mapping_seq, "
        "CASE WHEN r.mapping_seq IS NULL THEN 'skipped' ELSE 'matched' END AS status, "
        "CASE WHEN r.mapping_seq IS NULL THEN 'No vendor mapping matched file_name' END AS reason "
        "FROM inv i LEFT JOIN rules r ON contains(lower(i.file_name), r.pattern) "
        "QUALIFY row_number() OVER (PARTITION BY i.file_id ORDER BY r.mapping_seq NULLS LAST, r.pattern_seq) = 1)")


def build() -> dict[str, str]:
    lay, rul = bundled("parts_layered"), bundled("parts_rules")
    q: dict[str, str] = {}
    parts = duckdb_cte("feed_parts")
    headers = duckdb_cte("feed_headers")

    # A
    q["file_inventory"] = _inventory() + "\nSELECT file_id, path, file_name, ext, file_seq FROM inv"
    q["vendor_match"] = _matched() + "\nSELECT file_id, file_name, vendor_code, status FROM matched"
    brands = [m for m in load_mappings(MAPPINGS_DIR / "vendors.yaml") if m["vendor_code"] == "Brands"][0]
    vals = ", ".join(f"({lit(s['sheet_name'])}, {int(s.get('header_row', 0))}, {k})" for k, s in enumerate(brands["sheets"]))
    many = ("SELECT CAST(s_suppkey AS INT) AS mapping_seq, 0 AS pattern_seq, s_name AS vendor_code, '#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS pattern "
            "FROM supplier UNION ALL SELECT CAST(2000000000 - p_partkey AS INT), 1, p_brand, CAST(p_partkey AS VARCHAR) || '.xlsx' FROM part "
            "UNION ALL SELECT 2000000000, CAST(p_partkey AS INT), p_type, right(CAST(p_partkey AS VARCHAR), 2) FROM part")
    q["vendor_match_many"] = (
        f"WITH p AS (SELECT pattern, min_by(struct_pack(v := vendor_code, m := mapping_seq), (mapping_seq, pattern_seq)) AS r, "
        f"min((mapping_seq, pattern_seq)) AS o FROM ({many}) GROUP BY pattern),\n"
        "f AS (SELECT row_number() OVER () AS id, 'Feed#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || '_' || CAST(o_orderkey AS VARCHAR) || '.xlsx' AS file_name FROM orders),\n"
        "h AS (SELECT id, min_by(r, o) AS r FROM f JOIN p ON contains(lower(file_name), pattern) GROUP BY id)\n"
        "SELECT file_name, r.v AS vendor_code, r.m AS mapping_seq, CASE WHEN h.id IS NULL THEN 'skipped' ELSE 'matched' END AS status "
        "FROM f LEFT JOIN h USING (id)")
    q["csv_cells"] = (
        "WITH r AS (SELECT CAST(p_size AS INTEGER) AS block, 1 + row_number() OVER (PARTITION BY p_size ORDER BY p_partkey) AS row_idx, "
        "[CAST(p_partkey AS VARCHAR), p_name || ', \"' || p_type || '\"' || CASE WHEN p_size % 3 = 0 THEN chr(10) ELSE '' END || p_brand, "
        "CASE WHEN p_size % 7 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END, CAST(p_size AS VARCHAR) || '\" wide'] AS f FROM part "
        "UNION ALL SELECT DISTINCT CAST(p_size AS INTEGER), 0, ['Price list', '', '', ''] FROM part "
        "UNION ALL SELECT DISTINCT CAST(p_size AS INTEGER), 1, ['Key', 'Name', 'Size', 'Note \"n\" x'] FROM part),\n"
        "c AS (SELECT block, row_idx, unnest(f) AS text, CAST(unnest(range(4)) AS INTEGER) AS col_idx FROM r)\n"
        "SELECT block, row_idx, col_idx, CASE WHEN text = '' THEN NULL WHEN regexp_full_match(text, '[+-]?[0-9]+([.][0-9]+)?') THEN 'n' ELSE 's' END AS kind, "
        "nullif(text, '') AS text FROM c")
    q["run_folder_csv"] = (
        "SELECT CAST(p_size AS INTEGER) AS block, 'ok' AS status, count(*) AS rows_total, count(*) FILTER (WHERE p_partkey <> 0) AS rows_upserted, true AS archived, CAST(NULL AS VARCHAR) AS move_error, "
        # A numeric zero is no part number.
        "(SELECT count(*) FROM part WHERE p_partkey <> 0) AS n_products, (SELECT CAST(sum(p_size) AS BIGINT) FROM part WHERE p_size % 7 <> 0 AND p_partkey <> 0) AS sum_quantity, "
        "(SELECT count(DISTINCT p_size) FROM part) AS files_archived, CAST(0 AS BIGINT) AS files_left FROM part GROUP BY p_size")
    q["sheet_select"] = duckdb_cte("feed_grid") + (
        f",\nrules(sheet_name, header_row, sheet_seq) AS (VALUES {vals})\n"
        "SELECT s.sheet_name, CAST(r.header_row AS INTEGER) AS header_row, CAST(r.sheet_seq AS INTEGER) AS sheet_seq, s.n_rows "
        "FROM (SELECT sheet_name, count(DISTINCT row_idx) AS n_rows FROM feed_grid GROUP BY ALL) s JOIN rules r USING (sheet_name)")
    q["empty_sheet_skip"] = grid_ctes() + (
        "\nSELECT sheet_name, count(*) AS n_cells, count(text) AS n_values, "
        "CASE WHEN count(text) = 0 THEN 'skipped_empty' ELSE 'ok' END AS status FROM data GROUP BY sheet_name")
    q["na_tokens"] = parts + f"\nSELECT row_idx, {', '.join(f'{src_na(c)} AS {c}' for c in FEED_TEXT)} FROM feed_parts"

    # B
    q["norm_header"] = headers + f"\nSELECT sheet_name, col_idx, original_header, {norm_header('original_header')} AS normalized_header FROM feed_headers"
    q["norm_header_raw"] = headers + f"\nSELECT sheet_name, col_idx, original_header, {norm_header_raw('original_header')} AS normalized_header FROM feed_headers"
    q["safe_table_name"] = duckdb_cte("feed_files") + (
        "\nSELECT file_id, " + safe_table("RAW", "regexp_replace(string_split(path, '/')[-1], '\\.[^.]*$', '')", "'DATA (main)'")
        + " AS table_name FROM feed_files")
    q["detect_header"] = grid_ctes() + "\nSELECT sheet_name, header_row, score FROM headers"
    q["dedupe_headers"] = headers + (
        f",\nb1 AS (SELECT sheet_name, col_idx, {norm_header_raw('original_header')} AS normalized_header FROM feed_headers),\n"
        f"b2 AS (SELECT *, {shorten('normalized_header')} AS base FROM b1),\n"
        f"b3 AS (SELECT *, {suffixed('base', 'k1')} AS s1 FROM (SELECT *, row_number() OVER (PARTITION BY sheet_name, base ORDER BY col_idx) AS k1 FROM b2))\n"
        f"SELECT sheet_name, col_idx, normalized_header, {suffixed('s1', 'k2')} AS stored_column_name "
        "FROM (SELECT *, row_number() OVER (PARTITION BY sheet_name, s1 ORDER BY col_idx) AS k2 FROM b3)")
    q["column_map"] = grid_ctes() + (
        "\nSELECT file_name AS source_file, sheet_name AS source_sheet, col_idx, original_header, normalized_header, stored_column_name FROM colnames")

    # C
    q["drop_empty_rows"] = grid_ctes() + "\nSELECT sheet_name, header_row, row_idx FROM live_rows"
    q["drop_empty_cols"] = grid_ctes() + "\nSELECT sheet_name, col_idx FROM live_cols"
    q["clean_text"] = parts + f"\nSELECT row_idx, {', '.join(f'{clean(c)} AS {c}' for c in FEED_TEXT)} FROM feed_parts"
    q["is_blank"] = parts + f"\nSELECT row_idx, {', '.join(f'{blank(c)} AS {c}_blank' for c in FEED_TEXT)} FROM feed_parts"
    q["renumber_rows"] = grid_ctes() + "\nSELECT sheet_name, row_idx, CAST(source_row_number AS BIGINT) AS source_row_number FROM renum"

    # D
    q["to_decimal"] = _conv_sql(to_decimal)
    q["to_money"] = _conv_sql(to_decimal)
    q["to_int"] = _conv_sql(to_int)
    q["to_bool"] = _conv_sql(to_bool)
    q["apply_conversions"] = with_rows(lay) + (
        "\nSELECT row_idx, wholesale_price, lighting.bulb_included AS bulb_included, "
        "lighting.canopy_height_in AS canopy_height_in, fans.blade_span_in AS blade_span_in FROM rows")
    q["conversion_audit"] = _audit_sql(lay)
    q["conversions_in_turn"] = with_rows(_two_kinds(lay)) + "\nSELECT row_idx, wholesale_price, bulb_quantity, is_imap FROM rows"

    # E
    q["first_non_null_wide"] = _e1_long()
    q["first_non_null_long"] = _e1_long()
    q["core_projection"] = with_rows(lay) + "\nSELECT * EXCLUDE (file_seq, sheet_seq, lighting, fans, light_bulbs, inventory_partno_kind, status) FROM rows"
    q["category_projection"] = with_rows(lay) + "\nSELECT row_idx, category_type, lighting.* FROM rows WHERE lighting IS NOT NULL"
    q["category_projection_fans"] = with_rows(lay) + "\nSELECT row_idx, category_type, fans.* FROM rows WHERE fans IS NOT NULL"
    q["default_currency"] = with_rows(rul) + "\nSELECT row_idx, currency_code FROM rows"
    q["lineage"] = with_rows(lay, RUN_ID) + "\nSELECT row_idx, source_file_name, source_sheet_name, source_row_number, run_id FROM rows"
    a = rows_cte(lay, suffix="_a")
    b = rows_cte(rul, suffix="_b")
    q["vendor_union"] = parts + ",\n" + a + ",\n" + b + (
        "\nSELECT 'parts_layered' AS mapping, row_idx, vendor_code, inventory_partno, category_type, status FROM rows_a "
        "UNION ALL SELECT 'parts_rules', row_idx, vendor_code, inventory_partno, category_type, status FROM rows_b")

    # F
    q["classify_default"] = parts + "\nSELECT row_idx, 'lighting' AS category_type FROM feed_parts"
    na = ", ".join(f"{src_na(c)} AS {c}" for c in FEED_TEXT)
    q["classify_rules"] = parts + f",\np AS (SELECT row_idx, {na} FROM feed_parts)\nSELECT row_idx, {category_sql(FEED_TEXT, rul)} AS category_type FROM p"
    q["classify_exact"] = _layer_sql("exact")
    q["classify_substring"] = _layer_sql("substring")
    q["classify_substring_table"] = _layer_sql("substring")
    q["classify_regex"] = _layer_sql("regex")
    q["classify_features"] = _layer_sql("features")
    q["classify_layered"] = parts + (f",\np AS (SELECT row_idx, {na} FROM feed_parts)\n"
                                     f"SELECT row_idx, {category_sql(FEED_TEXT, lay)} AS category_type, {layer_sql(FEED_TEXT, lay)} AS category_layer FROM p")
    rs = dict(lay["category"]["regex_scan"], columns=["text"])
    q["classify_substring_join"] = q["classify_substring_table"]
    q["classify_documents"] = f"SELECT doc_id, {regex_sql(['text'], _unicode(rs))} AS category_type FROM documents"
    q["classify_regex_forms"] = parts + (
        f",\np AS (SELECT row_idx, {na} FROM feed_parts)\nSELECT row_idx, CASE WHEN regexp_matches(short_description, '\\bchair\\b') THEN 'ascii' "
        "WHEN regexp_matches(short_description, 'wall\\sart') THEN 'verbose' "
        "WHEN contains(short_description, 'remote for') OR regexp_matches(trim(short_description), 'PENDANT$') THEN 'named' "
        "WHEN " + " OR ".join(f"contains(short_description, '{c}{c}')" for c in "abcdefghijklmnopqrstuvwxyz") + " THEN 'twice' END AS category_type FROM p")

    # G
    q["missing_key_filter"] = with_rows(lay) + "\nSELECT row_idx, source_file_name AS file FROM rows WHERE status = 'skipped'"
    cols40 = ",".join(FEED_TEXT)
    q["missing_key_sample"] = with_rows(lay) + (
        f",\ns AS (SELECT source_file_name AS file, source_sheet_name AS sheet, row_idx, "
        f"row_number() OVER (PARTITION BY source_file_name ORDER BY {SEQ}) AS sample_rank FROM rows WHERE status = 'skipped')\n"
        f"SELECT s.file, s.sheet, s.row_idx, s.sample_rank, {lit(cols40)} AS cols_first40, src.sku AS probe_sku "
        "FROM s JOIN src ON src.row_idx = s.row_idx AND src.file_name = s.file WHERE s.sample_rank <= 10")
    q["quarantine"] = with_rows(lay) + "\nSELECT row_idx, vendor_code, inventory_partno, inventory_partno_kind, status FROM rows"
    q["error_rows"] = with_rows(lay) + (
        "\nSELECT source_file_name AS file, source_sheet_name AS sheet, source_row_number AS row_index, vendor_code, "
        "coalesce(inventory_partno, '') AS inventory_partno, category_type, 'ValueError' AS error_type, "
        "'Missing vendor_code or inventory_partno (required).' AS error_message FROM rows WHERE status = 'error'")
    q["bad_row_locate"] = grid_ctes() + (
        ",\nbad AS (SELECT *, CASE WHEN NOT (length(source_file) <= 260) THEN 'source_file_len' "
        "WHEN NOT (length(source_sheet) <= 200) THEN 'source_sheet_len' "
        "WHEN NOT (coalesce(length(value), 0) <= 8) THEN 'cell_len' END AS failed_check FROM landing)\n"
        "SELECT source_file, source_sheet, min(source_row_number) AS first_bad_row, "
        "arg_min(failed_check, (source_row_number, col_idx)) AS failed_check, count(*) AS bad_rows "
        "FROM bad WHERE failed_check IS NOT NULL GROUP BY ALL")

    # H
    attrs = ", ".join(CORE_ATTRS)
    q["last_write_wins"] = with_rows(lay) + ",\nok AS (SELECT * FROM rows WHERE status = 'ok'),\n" + lww_cte("fold", "ok") + (
        f"\nSELECT vendor_code, inventory_partno, {attrs}, n_rows FROM fold")
    q["merge_core"] = merged_sql(lay, f"SELECT {CORE_OUT} FROM m_core")
    q["merge_currency"] = merged_sql(lay, "SELECT vendor_code, inventory_partno, currency_code FROM m_core")
    q["surrogate_ids"] = merged_sql(lay, "SELECT product_id, vendor_code, inventory_partno FROM m_core")
    q["merge_lighting"] = merged_sql(lay, "SELECT * FROM m_lighting")
    q["merge_fans"] = merged_sql(lay, "SELECT * FROM m_fans")
    q["merge_bulbs"] = merged_sql(rul, "SELECT * FROM m_light_bulbs")
    q["insert_if_absent"] = merged_sql(lay, "SELECT product_id, 'accessories' AS \"table\" FROM m_accessories "
                                            "UNION ALL SELECT product_id, 'home_decor' FROM m_home_decor")
    known = inlist(["lighting", "fans", "light_bulbs", "accessories", "home_decor"])
    q["route_categories"] = with_rows(lay) + (
        f"\nSELECT row_idx, vendor_code, inventory_partno, CASE WHEN category_type IN {known} THEN category_type ELSE 'core_only' END AS route "
        "FROM rows WHERE status = 'ok'")
    q["atomic_files"] = with_rows(lay) + (
        ",\nok AS (SELECT * FROM rows WHERE status = 'ok' AND source_file_name <> 'feed_3.xlsx'),\n"
        + lww_cte("fold", "ok") + ",\n" + merge_cte("core", None, "fold") + f"\nSELECT {CORE_OUT} FROM core")
    q["raw_landing"] = grid_ctes() + "\nSELECT * FROM landing"
    q["raw_tables"] = grid_ctes() + (
        "\nSELECT sheet_name, header_row, " + safe_table("RAW", "regexp_replace(file_name, '\\.[^.]*$', '')", "sheet_name")
        + " AS table_name FROM headers SEMI JOIN live_rows USING (file_name, sheet_name)")
    heads = ["head_0", "head_1", "head_2", "head_3"]
    wide = ", ".join(f"max(value) FILTER (WHERE stored_column_name = '{h}') AS {h}" for h in heads)
    q["raw_tables_wide"] = grid_ctes() + (
        f"\nSELECT source_row_number + 1 AS raw_id, source_file, source_sheet, header_row, source_row_number, "
        f"'2026-02-02 10:10:10' AS loaded_at, {wide}, any_value("
        + safe_table("RAW", "regexp_replace(source_file, '\\.[^.]*$', '')", "source_sheet") + ") AS table_name "
        "FROM landing GROUP BY source_file, source_sheet, header_row, source_row_number")

    q["raw_tables_apart"] = grid_ctes() + (
        "\nSELECT " + safe_table("RAW", "regexp_replace(source_file, '\\.[^.]*$', '')", "source_sheet") + " AS table_name, source_row_number + 1 AS raw_id, "
        "source_sheet, header_row, stored_column_name || '_' || lower(replace(source_sheet, '#', '')) AS stored_column_name, value "
        "FROM landing WHERE value IS NOT NULL")

    # I
    counters = ("SELECT source_file_name AS path, source_file_name AS file, vendor_code, count(*) AS rows_total, count(*) FILTER (WHERE status = 'ok') AS rows_upserted, "
                "count(*) FILTER (WHERE status = 'skipped') AS rows_skipped_missing_key, count(*) FILTER (WHERE status = 'error') AS rows_error "
                "FROM rows GROUP BY ALL")
    q["file_counters"] = with_rows(lay) + "\n" + counters
    q["category_counts"] = with_rows(lay) + (
        "\nSELECT source_file_name AS path, source_file_name AS file, category_type, count(*) AS n_rows FROM rows WHERE status = 'ok' GROUP BY ALL")
    q["category_totals"] = with_rows(lay) + (
        "\nSELECT source_file_name AS file, category_type, count(*) AS n_rows, "
        "CAST(grouping(source_file_name, category_type) AS BIGINT) AS level "
        "FROM rows WHERE status = 'ok' GROUP BY ROLLUP (source_file_name, category_type)")
    q["run_report"] = with_rows(lay) + ",\n" + _matched().removeprefix("WITH ") + (
        ",\ncats AS (SELECT source_file_name AS path, string_agg(category_type || '=' || CAST(n AS VARCHAR), ',' ORDER BY category_type) AS by_category "
        "FROM (SELECT source_file_name, category_type, count(*) AS n FROM rows WHERE status = 'ok' GROUP BY ALL) GROUP BY ALL),\n"
        "counts AS (SELECT source_file_name AS path, count(*) AS rows_total, count(*) FILTER (WHERE status = 'ok') AS rows_upserted, "
        "count(*) FILTER (WHERE status = 'skipped') AS rows_skipped_missing_key, count(*) FILTER (WHERE status = 'error') AS rows_error FROM rows GROUP BY ALL),\n"
        "report AS (SELECT c.path, c.path AS file, 'Parts Feed' AS vendor_code, c.path = 'feed_3.xlsx' AS failed, false AS unmatched, "
        "rows_total, rows_upserted, rows_skipped_missing_key, rows_error, by_category FROM counts c LEFT JOIN cats USING (path) "
        "UNION ALL SELECT path, file_name, NULL, false, true, NULL, NULL, NULL, NULL, NULL FROM matched WHERE status = 'skipped')\n"
        "SELECT '/in' AS input_dir, path, file, vendor_code, " + ", ".join(
            f"CASE WHEN NOT failed THEN {c} END AS {c}" for c in ("rows_total", "rows_upserted", "rows_skipped_missing_key", "rows_error", "by_category"))
        + ", failed OR unmatched AS skipped, CASE WHEN failed THEN 'failed' WHEN unmatched THEN 'skipped' ELSE 'ok' END AS status, "
        "CASE WHEN failed THEN 'Fatal error: BadZipFile: File is not a zip file' WHEN unmatched THEN 'No vendor mapping matched file_name' END AS reason, "
        "'partial' AS run_status FROM report")
    q["disposition"] = _matched() + (
        ",\nexisting AS (SELECT DISTINCT string_split(path, '/')[-1] AS file_name, 1 AS taken FROM feed_files WHERE starts_with(path, '/in/archive/')),\n"
        "both_ AS (SELECT file_id, path, file_name, stem, status FROM matched UNION ALL SELECT file_id, '/in/twin/' || file_name, file_name, stem, status FROM matched),\n"
        "d AS (SELECT file_id, path, file_name, stem, CASE WHEN status <> 'matched' THEN 'skipped' WHEN file_id % 5 = 0 THEN 'error' ELSE 'archived' END AS disposition FROM both_),\n"
        "p AS (SELECT d.*, row_number() OVER (PARTITION BY disposition, d.file_name ORDER BY path) - 1 + "
        "CASE WHEN disposition = 'archived' THEN coalesce(taken, 0) ELSE 0 END AS place FROM d LEFT JOIN existing USING (file_name))\n"
        "SELECT file_id, path, file_name, disposition, CASE WHEN disposition <> 'skipped' THEN '/in/' || CASE disposition WHEN 'archived' THEN 'archive' ELSE 'error' END || '/' || "
        f"CASE WHEN place = 0 THEN file_name ELSE stem || '_{RUN_STAMP}' || CASE WHEN place > 1 THEN '_' || CAST(place AS VARCHAR) ELSE '' END || "
        "regexp_extract(file_name, '(\\.[^.]*)$', 1) END END AS moved_to FROM p")
    q["typed_cells"] = grid_ctes() + "\nSELECT sheet_name, row_idx, col_idx, kind, text FROM cells WHERE kind IS NOT NULL"
    q["sheet_scan"] = with_rows(lay) + (
        "\nSELECT CAST(row_idx AS BIGINT) AS part_key, 'Parts Feed' AS vendor_code, inventory_partno, category_type, wholesale_price, status FROM rows")
    q["sheet_own_columns"] = parts + (
        f"\nSELECT CAST(row_idx AS BIGINT) AS part_key, 'Parts Feed' AS vendor_code, vendor_code AS location, file_name AS collection, "
        f"CASE WHEN {has_text(src_na('glass'))} THEN 'light_bulbs' ELSE 'lighting' END AS category_type FROM feed_parts")
    q["drop_folder_stream"] = with_rows(lay) + (
        ",\nok AS (SELECT * FROM rows WHERE status = 'ok'),\n" + lww_cte("fold", "ok") + ",\n" + merge_cte("core", None, "fold")
        + "\nSELECT vendor_code, inventory_partno, category_type, wholesale_price, currency_code, "
          "source_file_name, marketing_description FROM core")
    q["snapshot_two_jobs"] = with_rows(lay) + (
        ",\nok_a AS (SELECT * FROM rows WHERE status = 'ok' AND source_file_name <> (SELECT max(file_name) FROM feed_parts)),\n"
        "ok_b AS (SELECT * FROM rows WHERE status = 'ok' AND source_file_name <> (SELECT min(file_name) FROM feed_parts)),\n"
        + lww_cte("fold_a", "ok_a") + ",\n" + merge_cte("core_a", None, "fold_a") + ",\n"
        + lww_cte("fold_b", "ok_b") + ",\n" + merge_cte("core_b", "core_a", "fold_b")
        + "\nSELECT " + CORE_OUT.replace(", run_id", "") + " FROM core_b")
    q["error_csv_roundtrip"] = q["error_rows"]
    q["conversion_csv_roundtrip"] = q["conversion_audit"]
    return q


def _two_kinds(cfg: dict) -> dict:
    """The mapping with fields under two conversions (as the query's)."""
    cfg = copy.deepcopy(cfg)
    cfg["column_map"]["core"] |= {"bulb_quantity": ["canopy_height_inches", "dnprice"], "is_imap": ["lamps_supplied"]}
    cfg["conversions"] = {"money": ["wholesale_price", "bulb_quantity"], "int": ["bulb_quantity"], "bool": ["is_imap", "bulb_included"],
                          "decimals": ["canopy_height_in", "blade_span_in", "diameter_in"]}
    return cfg


def _unicode(rs: dict) -> dict:
    """Word boundaries and white space as Python sees them, for an engine whose
    own are ASCII only."""
    edge_l, edge_r = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"

    def one(p: str) -> str:
        body = p.removeprefix("(?i)")
        left, right = body.startswith(r"\b"), body.endswith(r"\b")
        body = body.removeprefix(r"\b").removesuffix(r"\b").replace(r"\s", r"[\s\p{Z}]")
        return "(?i)" + (edge_l if left else "") + "(?:" + body + ")" + (edge_r if right else "")

    return dict(rs, rules=[dict(r, any_regex=[one(p) for p in r["any_regex"]]) for r in rs["rules"]])


def _audit_sql(cfg) -> str:
    cm = cfg.get("column_map") or {}
    conv = cfg.get("conversions") or {}
    arms = []
    for section, only in [("core", None)] + [(t, t) for t in ATTRIBUTE_TABLES]:
        for kind in ("money", "decimals", "int", "bool"):
            for f in conv.get(kind) or []:
                if f not in (cm.get(section) or {}):
                    continue
                raw = first_non_null(FEED_TEXT, cm[section][f])
                cond = f"NOT {blank(raw)} AND {CONV[kind](raw)} IS NULL"
                if only:
                    cond += f" AND category_type = {lit(only)}"
                arms.append(f"SELECT 'conversion' AS type, {lit(f)} AS field, {raw} AS value, "
                            f"{lit('ValueError: not a valid ' + kind + ' value')} AS error, vendor_code AS vendor, file_name AS file, "
                            f"{lit(cfg['sheets'][0]['sheet_name'])} AS sheet, row_idx AS row_index FROM cls WHERE {cond}")
    base = with_rows(cfg)
    return base + "\n" + " UNION ALL ".join(arms)


ORACLE = build()

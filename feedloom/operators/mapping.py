"""Alias mapping, canonical projection and conversions.

A mapping is compiled once per (vendor, feed schema) into plain Column
expressions, so one feed becomes one narrow projection with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.convert import CONVERTED_TYPES, CONVERTERS, number_text
from ..functions.text import has_text, is_blank
from ..schema import (
    ATTRIBUTE_TABLES, CORE_COLUMNS, DEFAULT_CURRENCY, FILE, FILE_SEQ, KIND, PATH, ROW, SHEET, SHEET_COLUMNS, SHEET_SEQ, SQL_TYPES, VENDOR,
)

CONVERSION_ORDER = ("money", "decimals", "int", "bool")


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def alias_list(candidates) -> list[str]:
    """The aliases of one field: a name, or a list of names; anything else is none."""
    match candidates:
        case str():
            names = [candidates]
        case list() | tuple():
            names = list(candidates)
        case _:
            names = []
    return [n for n in names if n]


def first_non_null(columns: Iterable[str], candidates) -> Column:
    """The first existing alias whose value is not null/whitespace-only.

    The value is returned unstripped; ``-`` or ``n/a`` count as values.
    """
    cols = set(columns)
    picks = [F.when(has_text(_col(a)), _col(a)) for a in alias_list(candidates) if a in cols]
    if not picks:
        return F.lit(None).cast("string")
    return picks[0] if len(picks) == 1 else F.coalesce(*picks)


def first_non_null_kind(columns: Iterable[str], candidates) -> Column:
    """Cell kind of the alias chosen by :func:`first_non_null` ('s' if unknown)."""
    cols = set(columns)
    picks = [
        F.when(has_text(_col(a)), _col(KIND + a) if KIND + a in cols else F.lit("s"))
        for a in alias_list(candidates) if a in cols
    ]
    if not picks:
        return F.lit(None).cast("string")
    return F.coalesce(*picks)


def raw_record(columns: Iterable[str], section_map: dict | None) -> dict[str, Column]:
    """Canonical field -> E1 value for one ``column_map`` section (config order)."""
    cols = list(columns)
    return {canon: first_non_null(cols, cands) for canon, cands in (section_map or {}).items()}


def convert_steps(value: Column, kinds: list[str]) -> list[Column]:
    """The value after each conversion. A later kind reads the earlier result as
    text, written as Python writes the number or boolean."""
    steps, text = [], value.cast("string")
    for kind in kinds:
        steps.append(CONVERTERS[kind](text))
        text = number_text(steps[-1], CONVERTED_TYPES[kind])
    return steps


def field_kinds(cfg: dict, field: str) -> list[str]:
    """The conversions of a field, in the order they are applied."""
    conv = cfg.get("conversions") or {}
    return [k for k in CONVERSION_ORDER for f in conv.get(k) or [] if f == field]


def convert_record(rec: dict[str, Column], cfg: dict) -> dict[str, Column]:
    """Apply ``conversions`` (money, decimals, int, bool) to fields present."""
    return {f: convert_steps(v, kinds)[-1] if (kinds := field_kinds(cfg, f)) else v for f, v in rec.items()}


def _typed(value: Column | None, kind: str) -> Column:
    t = SQL_TYPES[kind]
    if value is None:
        return F.lit(None).cast(t)
    return value.try_cast(t) if t != "string" else value.cast("string")


def _raw_name(section: str, field: str) -> str:
    return f"__raw__{section}__{field}"


def core_record(columns: Iterable[str], cfg: dict, staged: bool = False) -> dict[str, Column]:
    """E2 + E4 + D5: mapped, converted core fields (without key constants).

    With ``staged=True`` the raw alias values are read from columns made by
    :func:`stage_raw_values` instead of being recomputed inline.
    """
    cm = cfg.get("column_map") or {}
    core_map = cm.get("core") or {}
    if staged:
        rec = {f: F.col(_raw_name("core", f)) for f in core_map}
    else:
        rec = raw_record(columns, core_map)
    if "currency_code" not in rec:
        rec["currency_code"] = F.lit((cfg.get("defaults") or {}).get("currency_code", DEFAULT_CURRENCY))
    return convert_record(rec, cfg)


def category_struct(columns: Iterable[str], cfg: dict, category: str, staged: bool = False) -> Column:
    """The attribute record of one category table, typed, as a struct."""
    cm = cfg.get("column_map") or {}
    section = cm.get(category) or {}
    if staged:
        raw = {f: F.col(_raw_name(category, f)) for f in section}
    else:
        raw = raw_record(columns, section)
    rec = convert_record(raw, cfg)
    fields = [_typed(rec.get(n), k).alias(n) for n, k in ATTRIBUTE_TABLES[category]]
    return F.struct(*fields)


def stage_raw_values(df: DataFrame, cfg: dict) -> DataFrame:
    """One projection holding every E1 alias pick as its own column.

    The converters read their input several times; giving them a column
    instead of the whole alias chain keeps generated code small (one
    whole-stage-codegen method) and evaluates each pick once.
    """
    cm = cfg.get("column_map") or {}
    cols = df.columns
    picks = {}
    for section in ["core", *ATTRIBUTE_TABLES]:
        for f, cands in (cm.get(section) or {}).items():
            picks[_raw_name(section, f)] = first_non_null(cols, cands)
    key_aliases = (cm.get("core") or {}).get("inventory_partno")
    picks["inventory_partno_kind"] = first_non_null_kind(cols, key_aliases)
    return df.withColumns(picks) if picks else df


def source_columns(columns: Iterable[str], cfg: dict) -> dict[str, Column]:
    """File, path, sheet, row and order of a feed row, from the reserved columns.
    A feed without a path is told by its file name."""
    cols = set(columns)

    def pick(name: str, other: Column) -> Column:
        return _col(name) if name in cols else other

    sheet = next((s.get("sheet_name") for s in cfg.get("sheets") or []), None)
    file = pick(FILE, F.lit(None).cast("string"))
    path = pick(PATH, file)
    return {
        "file": file, "path": path, "sheet": pick(SHEET, F.lit(sheet)), "row": _col(ROW).cast("bigint"),
        # Feed order is file order: a file sequence when the scan made one,
        # else the path (paths sort like the listing).
        "file_seq": pick(FILE_SEQ, path if FILE in cols or PATH in cols else F.lit("")),
        "sheet_seq": pick(SHEET_SEQ, F.lit(0)).cast("bigint"),
        "vendor": pick(VENDOR, F.lit(cfg.get("vendor_code"))).cast("string"),
    }


def _rejected(value: Column | None, kind: str, name: str) -> Column:
    """The field's name if its value has text that its type cannot hold."""
    if value is None or kind == "T":
        return F.lit(None).cast("string")
    text = value.cast("string")
    return F.when(text.isNotNull() & value.try_cast(SQL_TYPES[kind]).isNull(), F.lit(name))


def project_records(df: DataFrame, cfg: dict, run_id: int | None = None, category_col: str = "category_type",
                    keep: Iterable[str] = ()) -> DataFrame:
    """One canonical row per feed row.

    Output: ordering columns (``file_seq, sheet_seq, row_idx``) and
    ``source_path``, the 27 core columns, ``inventory_partno_kind``, one
    attribute struct per category table (non-null only for rows of that
    category), and ``rejected_field``: a typed field without conversion whose
    text the type cannot hold. ``keep`` passes feed columns on as
    ``probe_<name>``, and the sheet's column names if the feed brings them.

    The vendor is the mapping's; only a feed table that names the vendor in the
    reserved column overrides it, never a sheet's own column.
    """
    cols = df.columns
    src = source_columns(cols, cfg)
    staged = stage_raw_values(df, cfg)
    core = core_record(cols, cfg, staged=True)
    fixed = {
        "vendor_code": src["vendor"], "category_type": _col(category_col),
        "source_file_name": src["file"], "source_sheet_name": src["sheet"],
        "source_row_number": src["row"], "run_id": F.lit(run_id).cast("bigint"),
    }
    out = [src["file_seq"].alias("file_seq"), src["sheet_seq"].alias("sheet_seq"), src["row"].alias("row_idx"),
           src["path"].alias("source_path")]
    rejected = []
    for name, kind in CORE_COLUMNS:
        v = fixed[name] if name in fixed else core.get(name)
        out.append(_typed(v, kind).alias(name))
        if name not in fixed and name in core and not field_kinds(cfg, name):
            rejected.append(_rejected(v, kind, name))
    out.append(F.col("inventory_partno_kind"))
    cat = _col(category_col)
    cm = cfg.get("column_map") or {}
    for table, fields in ATTRIBUTE_TABLES.items():
        out.append(F.when(cat == F.lit(table), category_struct(cols, cfg, table, staged=True)).alias(table))
        rejected += [F.when(cat == F.lit(table), _rejected(F.col(_raw_name(table, n)), k, n)) for n, k in fields
                     if k != "T" and n in (cm.get(table) or {}) and not field_kinds(cfg, n)]
    out.append((F.coalesce(*rejected) if rejected else F.lit(None).cast("string")).alias("rejected_field"))
    out += [_col(k).alias(f"probe_{k}") for k in keep]
    if keep and SHEET_COLUMNS in cols:
        out.append(_col(SHEET_COLUMNS).alias("sheet_columns"))
    return staged.select(*out)


def conversion_audit(df: DataFrame, cfg: dict, category_col: str = "category_type") -> DataFrame:
    """One row per conversion that turned a non-blank value into NULL, for
    the core record and the attribute record of the row's own category, in the
    order the conversions are applied; a later conversion of a field is judged
    on the earlier one's result. (Conversions that raise in the mapped ingest
    are none for text: its converters catch their own errors.)
    """
    cols = df.columns
    cm = cfg.get("column_map") or {}
    items = []
    for section in ["core", *ATTRIBUTE_TABLES]:
        own = F.lit(True) if section == "core" else F.col(category_col) == F.lit(section)
        per_kind: dict[str, list[Column]] = {k: [] for k in CONVERSION_ORDER}
        for f, value in raw_record(cols, cm.get(section)).items():
            kinds, before = field_kinds(cfg, f), value
            for kind, after in zip(kinds, convert_steps(value, kinds)):
                per_kind[kind].append(F.when(~is_blank(before.cast("string")) & after.isNull() & own, F.struct(
                    F.lit(f).alias("field"), before.cast("string").alias("value"),
                    F.lit(f"ValueError: not a valid {kind} value").alias("error"))))
                before = after
        items += [c for k in CONVERSION_ORDER for c in per_kind[k]]
    schema = "type string, field string, value string, error string, vendor string, file string, sheet string, row_index bigint"
    if not items:
        return df.sparkSession.createDataFrame([], schema)
    src = source_columns(cols, cfg)
    exploded = df.select(
        src["vendor"].alias("vendor"), src["file"].alias("file"), src["sheet"].alias("sheet"), src["row"].alias("row_index"),
        F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("e"),
    )
    return exploded.select(
        F.lit("conversion").alias("type"), "e.field", "e.value", "e.error",
        "vendor", "file", "sheet", "row_index",
    )


def union_vendors(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of per-vendor canonical frames (columns aligned by name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

"""OOXML workbook source (A3, A4) and a small workbook writer for fixtures.

Reading: ``spark.read.format("binaryFile")`` lists and loads workbooks on any
Hadoop file system (globs, recursive lookup, length/mtime pushdown); a
Python UDTF parses each workbook on an executor with a streaming XML parser
and emits the long ``cells`` rows. Python runs once per *file*, not per
cell, and a workbook is never parsed on the driver.

Cell rendering follows the spreadsheet parse the mapped ingest relies on:
integral numbers without ``.0``, booleans as ``True``/``False``, dates as
``YYYY-MM-DD HH:MM:SS``.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions.headers import norm_header
from ..functions.text import SOURCE_NA_TOKENS, has_text
from ..operators.classify import config_tokens
from ..schema import FILE, FILE_SEQ, HAS, KIND, PATH, ROW, SHEET, SHEET_COLUMNS, SHEET_SEQ
from ..session import ship_package, stage_table

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RNS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"
CELLS_SCHEMA = "sheet_name string, sheet_seq int, row_idx int, col_idx int, kind string, text string"
# Built-in number formats that show dates/times.
DATE_FORMAT_IDS = frozenset(list(range(14, 23)) + [45, 46, 47])
#: Cells that one task puts together into rows, and row positions dealt at once.
CELLS_PER_TASK = 1 << 18
ROWS_PER_BLOCK = 1 << 12
EXCEL_EPOCH = _dt.datetime(1899, 12, 30)


def col_index(ref: str) -> int:
    """``"AB12"`` -> 27 (0-based column)."""
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code.lower())
    return bool(re.search(r"[ymdhs]", code)) and "general" not in code


def _render_number(v: str) -> str:
    f = float(v)
    if f.is_integer() and abs(f) < 2**63:
        return str(int(f))
    return repr(f)


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    with z.open("xl/sharedStrings.xml") as fh:
        for _, el in ET.iterparse(fh):
            if el.tag == NS + "si":
                out.append("".join(t.text or "" for t in el.iter(NS + "t")))
                el.clear()
    return out


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(n.get("numFmtId")): n.get("formatCode", "") for n in root.iter(NS + "numFmt")}
    xfs = root.find(NS + "cellXfs")
    dates = set()
    for i, xf in enumerate(xfs if xfs is not None else []):
        fid = int(xf.get("numFmtId", "0"))
        if fid in DATE_FORMAT_IDS or (fid in custom and _is_date_format(custom[fid])):
            dates.add(i)
    return dates


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.iter(PKG + "Relationship")}
    out = []
    for s in wb.iter(NS + "sheet"):
        t = target.get(s.get(RNS + "id"), "")
        t = t.lstrip("/")
        out.append((s.get("name"), t if t.startswith("xl/") else "xl/" + t))
    return out


def iter_cells(data: bytes, sheets: set[str] | None = None):
    """Yield ``(sheet_name, sheet_seq, row_idx, col_idx, kind, text)`` for
    every non-empty cell of a workbook (streaming over each sheet)."""
    z = zipfile.ZipFile(io.BytesIO(data))
    strings = _shared_strings(z)
    dates = _date_styles(z)
    for seq, (name, part) in enumerate(_sheets(z)):
        if sheets is not None and name not in sheets:
            continue
        with z.open(part) as fh:
            row_no = -1
            for _, el in ET.iterparse(fh):
                if el.tag == NS + "row":
                    el.clear()
                    continue
                if el.tag != NS + "c":
                    continue
                ref = el.get("r") or ""
                t = el.get("t", "n")
                v = el.find(NS + "v")
                text, kind = None, None
                if t == "s" and v is not None:
                    text, kind = strings[int(v.text)], "s"
                elif t == "inlineStr":
                    text, kind = "".join(x.text or "" for x in el.iter(NS + "t")), "s"
                elif t == "str" and v is not None:
                    text, kind = v.text or "", "s"
                elif t == "b" and v is not None:
                    text, kind = ("True" if v.text == "1" else "False"), "b"
                elif t == "e" and v is not None:
                    text, kind = v.text, "s"
                elif v is not None and v.text is not None:
                    if int(el.get("s", "0")) in dates:
                        d = EXCEL_EPOCH + _dt.timedelta(days=float(v.text))
                        text, kind = d.replace(microsecond=0).isoformat(sep=" "), "d"
                    else:
                        try:
                            text, kind = _render_number(v.text), "n"
                        except ValueError:
                            text, kind = v.text, "s"
                r = re.sub(r"^[A-Za-z]+", "", ref)
                row_no = int(r) - 1 if r else row_no
                el.clear()
                if kind is not None:
                    yield name, seq, row_no, col_index(ref), kind, text


@udtf(returnType=CELLS_SCHEMA, useArrow=True)
class WorkbookCells:
    """UDTF: one workbook (bytes) -> its non-empty cells. A workbook that cannot
    be read gives one row of kind ``fatal`` with the reason."""

    def eval(self, content: bytes, sheets: str | None = None):
        wanted = None if sheets is None else set(sheets.split("\x1f"))
        try:
            yield from iter_cells(bytes(content), wanted)
        except Exception as e:  # whatever a broken file brings: it fails alone
            yield None, None, None, None, "fatal", f"{type(e).__name__}: {e}"


# Any case of the suffix; ".xls" is listed and matched, and fails as unreadable.
WORKBOOK_GLOB = "*.[xX][lL][sS]{,[xX],[mM]}"


def workbook_files(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """The workbooks under ``path`` (listing only: ``content`` is not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", WORKBOOK_GLOB)
            .option("recursiveFileLookup", str(recursive).lower()).load(path))


def cells_of(books: DataFrame, sheets: list[str] | None = None) -> DataFrame:
    """A4: every sheet of every workbook in ``books(path, content)`` as long cells
    ``(file_path, file_name, sheet_name, sheet_seq, row_idx, col_idx, kind, text)``."""
    spark = books.sparkSession
    ship_package(spark)
    spark.udtf.register("feedloom_workbook_cells", WorkbookCells)
    wanted = F.lit(None).cast("string") if sheets is None else F.lit("\x1f".join(sheets))
    files = books.select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"), "content", wanted.alias("__sheets"))
    return spark.sql("SELECT f.file_path, f.file_name, c.* FROM {files} f, LATERAL feedloom_workbook_cells(f.content, f.__sheets) c", files=files)


def read_cells(spark: SparkSession, path: str, recursive: bool = True, sheets: list[str] | None = None,
               only: DataFrame | None = None) -> DataFrame:
    """A4 on the workbooks under ``path``; lock files (``~$*``) are skipped.
    ``only(path)`` names the files to read (the matched ones); the bytes of
    others are not parsed."""
    books = workbook_files(spark, path, recursive).filter(~F.element_at(F.split("path", "/"), -1).startswith("~$"))
    if only is not None:
        books = books.join(only.select("path").distinct(), "path", "left_semi")
    return cells_of(books, sheets)


def mapped_rows(cells: DataFrame, sheet_rules: DataFrame, columns: list[str], cfg: dict | None = None) -> DataFrame:
    """A3 + A5 + B1: configured sheets as wide all-text rows.

    ``cells(file_path, file_name, file_seq, sheet_name, row_idx, col_idx, kind,
    text)``; ``sheet_rules(vendor_code, sheet_name, header_row, sheet_seq)``
    selects sheets by exact name (missing sheets are simply absent) and gives each
    its header row. Column names follow the sheet parse: a blank header cell is
    ``Unnamed: <i>``, the k-th exact repeat of a name gets ``.k``; then B1
    normalises them. NA tokens become empty first; then names that normalise
    alike keep the first non-empty cell by position.

    The row has the columns that the mapping reads (``columns``), with their
    cells' kinds, so its width is fixed by the configuration and no header is
    collected. What rules ask of all columns of a sheet is worked out on the
    cells: one flag for each feature token of ``cfg``. ``_src_columns`` lists the
    sheet's first 40 column names in sheet order.

    Row index = position below the header. The empty rows between the header and
    a sheet's last non-empty row are kept (all NULL), as the parse keeps them;
    they are counted and skipped later.
    """
    from pyspark.sql import Window

    # A configuration's sheets, few rows: a join by name would send every cell of one
    # sheet name to one task.
    rules = F.broadcast(sheet_rules.select("sheet_name", "header_row", F.col("sheet_seq").alias("cfg_sheet_seq")))
    sheet = ["file_path", "sheet_name"]
    na = (F.col("kind") == "s") & F.col("text").isin(*SOURCE_NA_TOKENS)
    sel = cells.join(rules, "sheet_name").filter(F.col("row_idx") >= F.col("header_row")).withColumns({
        "text": F.when(~F.coalesce(na, F.lit(False)), F.col("text")), "kind": F.when(~F.coalesce(na, F.lit(False)), F.col("kind"))})
    # Column slots: every column with a header or a value (at most 16,384 per sheet).
    # Numbers are folded by hash before the shuffle; texts, which need a sort, only
    # where few: in header cells and one row a column. Written, as tables of their
    # real size, so that joins with them are planned by it.
    found = ["header_row", "cfg_sheet_seq", "file_name", "file_seq"]
    slots = sel.groupBy(*sheet, *found, "col_idx").agg(F.max("row_idx").alias("last"), F.count("*").alias("n"))
    titles = sel.filter(F.col("row_idx") == F.col("header_row")).groupBy(*sheet, "col_idx").agg(F.max("text").alias("h"))
    slots = stage_table(slots.unionByName(titles, allowMissingColumns=True), "slots")
    head = slots.groupBy(*sheet, "col_idx").agg(F.max("h").alias("h"))
    head = head.withColumn("raw", F.coalesce("h", F.concat(F.lit("Unnamed: "), F.col("col_idx").cast("string"))))
    k = F.row_number().over(Window.partitionBy(*sheet, "raw").orderBy("col_idx")) - 1
    head = stage_table(head.withColumn("__k", k).select(
        *sheet, "col_idx",
        norm_header(F.when(F.col("__k") > 0, F.concat(F.col("raw"), F.lit("."), F.col("__k").cast("string")))
                    .otherwise(F.col("raw"))).alias("col_name")), "head")
    shown = head.groupBy(*sheet).agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("col_idx", "col_name"))), lambda c: c["col_name"]), 1, 40).alias("names"))
    sheets = stage_table(slots.filter("n is not null").groupBy(*sheet, "header_row", "cfg_sheet_seq").agg(
        F.max("last").alias("last"), F.first("file_name").alias("file_name"), F.first("file_seq").alias("file_seq"), F.sum("n").alias("n"))
        .join(shown, sheet), "sheets")

    # Rows are put together by a sort, whose memory is that of the task's cells, and
    # cells compress too well for a size in bytes to bound it: a task has a number of
    # cells, however many there are.
    size = sheets.agg(F.sum(F.col("n") + F.col("last") - F.col("header_row")).alias("n")).first()["n"] or 0
    parts = 1 + size // CELLS_PER_TASK
    keys = [*sheet, "row_idx"]
    tokens = config_tokens(cfg or {})
    body = sel.filter(F.col("row_idx") > F.col("header_row")).join(head, [*sheet, "col_idx"]).select(*keys, "col_idx", "col_name", "text", "kind")
    # Every row position up to the sheet's last non-empty row, dealt in blocks, as a
    # cell without a column.
    span = (sheets.filter(F.col("last") > F.col("header_row")).select(*sheet, "last", F.explode(F.expr(f"sequence(header_row + 1L, cast(last AS bigint), {ROWS_PER_BLOCK}L)")).alias("low"))
            .repartition(parts, *sheet, "low"))
    grid = span.select(*sheet, F.explode(F.expr(f"sequence(low, least(low + {ROWS_PER_BLOCK - 1}L, cast(last AS bigint)))")).alias("row_idx"))
    grid = grid.withColumn("row_idx", F.col("row_idx").cast(cells.schema["row_idx"].dataType))
    body = grid.unionByName(body, allowMissingColumns=True).repartition(parts, *keys)
    filled = F.col("text").isNotNull()
    name = F.col("col_name")
    # A column repeats under one name: the first non-empty cell by position.
    picks = [F.min_by(F.struct("text", "kind"), F.when(filled & (name == c), F.col("col_idx"))).alias(f"v{i}") for i, c in enumerate(columns)]
    flags = [F.bool_or(name.contains(t) & has_text(F.col("text"))).alias(f"t{i}") for i, t in enumerate(tokens)]
    wide = body.groupBy(*keys).agg(*picks, *flags) if picks or flags else body.select(*keys).distinct()
    rows = wide.join(sheets.drop("n"), sheet).filter((F.col("row_idx") > F.col("header_row")) & (F.col("row_idx") <= F.col("last")))
    return rows.select(
        F.col("file_path").alias(PATH), F.col("file_name").alias(FILE), F.col("file_seq").alias(FILE_SEQ), F.col("sheet_name").alias(SHEET),
        F.col("cfg_sheet_seq").alias(SHEET_SEQ), (F.col("row_idx") - F.col("header_row") - 1).alias(ROW), F.col("names").alias(SHEET_COLUMNS),
        *[F.col(f"v{i}.text").alias(c) for i, c in enumerate(columns)], *[F.col(f"v{i}.kind").alias(KIND + c) for i, c in enumerate(columns)],
        *[F.col(f"t{i}").alias(HAS + t) for i, t in enumerate(tokens)])


# ---------------------------------------------------------------- writer
def _is_number(text: str) -> bool:
    try:
        float(text)
        return True
    except ValueError:
        return False


def _cell_ref(col: int, row: int) -> str:
    s, c = "", col + 1
    while c:
        c, r = divmod(c - 1, 26)
        s = chr(65 + r) + s
    return f"{s}{row + 1}"


def workbook_bytes(sheets: dict[str, list[tuple[int, int, str, str]]]) -> bytes:
    """A minimal .xlsx: ``{sheet: [(row_idx, col_idx, kind, text), ...]}``.
    Text cells are inline strings, ``n`` cells numbers, ``b`` booleans."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        names = list(sheets)
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" '
                             'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                             for i in range(len(names))) + "</Types>")
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml",
                   '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                   'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
                   + "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
                   + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
                             f'Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(names))) + "</Relationships>")
        for i, n in enumerate(names):
            rows: dict[int, list] = {}
            for r, c, kind, text in sheets[n]:
                if kind is not None and text is not None:
                    rows.setdefault(r, []).append((c, kind, text))
            parts = []
            for r in sorted(rows):
                cells = []
                for c, kind, text in sorted(rows[r]):
                    ref = _cell_ref(c, r)
                    if kind == "n" and _is_number(text):
                        cells.append(f'<c r="{ref}"><v>{escape(text)}</v></c>')
                    elif kind == "b":
                        cells.append(f'<c r="{ref}" t="b"><v>{1 if text == "True" else 0}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>')
                parts.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml",
                       '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                       f'<sheetData>{"".join(parts)}</sheetData></worksheet>')
    return buf.getvalue()

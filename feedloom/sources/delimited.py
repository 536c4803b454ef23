"""Raw typed-cell scan of delimited files (A4), as a Spark plan.

A large file is read by many tasks, each from a byte offset of its own
(``_metadata.file_block_start``), so no task knows which record it begins with, or
whether it begins inside a quoted field that holds line feeds. Both follow from
what the parts before do to the state "inside quotes":

* a line maps the state before it to the state after it; there are four such
  maps (keep, swap, set to outside, set to inside), found by two patterns;
* inside a part, the state before a line is what the last setting line left,
  swapped as often as swapping lines came since; it is worked out for both states
  that the part may begin with, and so are the records it starts;
* one row a part then gives each part's first state and first record number.

Lines are dealt once, by part (a part is at most ``maxPartitionBytes`` long), and
written; all else is joined to them by a table of one row a part. Only the lines
of records that go over several lines are grouped.

A field is quoted if its first character is a quote; a doubled quote inside
stands for one, what follows the closing quote up to the separator is kept, and a
quote elsewhere is a plain character (``12" blade``), as in Python's ``csv``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_table

DELIMITED_SUFFIXES = (".csv", ".tsv", ".txt")
#: A record over more lines is a quote that was never closed: its file fails.
MAX_RECORD_LINES = 10_000
PART = ["file_path", "block"]


class Syntax:
    """Patterns of one separator and quote character."""

    def __init__(self, sep: str = ",", quote: str = '"'):
        s, q = (f"\\x{{{ord(c):x}}}" for c in (sep, quote))
        content = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
        field = f"(?:{q}{content}{q}[^{s}]*+|[^{s}{q}][^{s}]*+|)"
        open_end = f"{q}{content}$"
        # A line ends inside a quoted field, having begun outside or inside one.
        self.outside = f"(?s)^(?:{field}{s})*+{open_end}"
        self.inside = f"(?s)^{content}(?:$|{q}[^{s}]*+{s}(?:{field}{s})*+{open_end})"
        self.fields = f"(?s){s}({q}{content}{q}[^{s}]*+|[^{s}]*+)"
        self.quoted = f"(?s)^{q}({content}){q}(.*)$"
        self.sep, self.quote = sep, quote


def _states(df: DataFrame, part: list[str], order: str, outside: str, inside: str, firsts: dict[str, int]) -> DataFrame:
    """``df`` with a column for each of ``firsts``: the state before each row (1
    inside quotes, 0 outside) if the group begins with that state. ``outside``
    and ``inside``: the state after a row that begins outside or inside."""
    o, i = F.col(outside), F.col(inside)
    rows = Window.partitionBy(*part).orderBy(order)
    earlier = rows.rowsBetween(Window.unboundedPreceding, -1)
    swap = (o & ~i).cast("int")
    known = df.withColumns({"__swaps": F.coalesce(F.sum(swap).over(earlier), F.lit(0)),
                            "__set": F.when(o == i, (o.cast("int") + F.sum(swap).over(rows.rowsBetween(Window.unboundedPreceding, 0))) % 2)})
    last = F.last("__set", ignorenulls=True).over(earlier)
    return known.withColumns({n: (F.coalesce(last, F.lit(first)) + F.col("__swaps")) % 2 for n, first in firsts.items()}).drop("__swaps", "__set")


def numbered_lines(spark: SparkSession, paths, syntax: Syntax) -> DataFrame:
    """``file_path, block, at, line, state, after, record``: every line of the
    files with the state before and after it and its record's number (from 0)."""
    read = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    mapped = read.withColumns({"o": F.col("line").rlike(syntax.outside), "i": F.col("line").rlike(syntax.inside)})
    local = _states(mapped, PART, "at", "o", "i", {"s0": 0, "s1": 1})
    upto = Window.partitionBy(*PART).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    lines = stage_table(local.withColumns({f"r{k}": F.sum(F.when(F.col(f"s{k}") == 0, 1).otherwise(0)).over(upto) for k in (0, 1)}), "lines")

    def after(state: Column) -> Column:
        return F.when(state == 1, F.col("i")).otherwise(F.col("o"))
    parts = lines.groupBy(*PART).agg(F.max_by(after(F.col("s0")), "at").alias("o"), F.max_by(after(F.col("s1")), "at").alias("i"),
                                     F.max("r0").alias("n0"), F.max("r1").alias("n1"))
    first = _states(parts, ["file_path"], "block", "o", "i", {"begin": 0})
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    first = first.select(*PART, "begin", F.coalesce(F.sum(F.when(F.col("begin") == 0, F.col("n0")).otherwise(F.col("n1"))).over(earlier), F.lit(0)).alias("records"))
    state = F.when(F.col("begin") == 0, F.col("s0")).otherwise(F.col("s1"))
    record = F.col("records") + F.when(F.col("begin") == 0, F.col("r0")).otherwise(F.col("r1")) - 1
    return lines.join(first, PART).select(*PART, "at", "line", state.alias("state"), after(state).cast("int").alias("after"), record.alias("record"))


def records(spark: SparkSession, paths, syntax: Syntax) -> tuple[DataFrame, DataFrame]:
    """(``file_path, record, text`` of every record, files that cannot be read as
    ``file_path, reason``)."""
    lines = stage_table(numbered_lines(spark, paths, syntax), "records")
    one = lines.filter("state = 0 and after = 0").select("file_path", "record", F.col("line").alias("text"))
    several = lines.filter("state = 1 or after = 1")
    sizes = several.groupBy("file_path", "record").agg(F.count("*").alias("n"))
    endless = sizes.filter(F.col("n") > MAX_RECORD_LINES).groupBy("file_path").agg(F.min("record").alias("record"))
    bad = stage_table(endless.select("file_path", F.concat(F.lit("Fatal error: record "), F.col("record").cast("string"),
                                                           F.lit(f" has more than {MAX_RECORD_LINES} lines; a quote is not closed")).alias("reason")), "endless")
    joined = (several.join(bad, "file_path", "left_anti").groupBy("file_path", "record")
              .agg(F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("x"))  # MAX_RECORD_LINES at most
              .select("file_path", "record", F.array_join(F.transform("x", lambda e: e["line"]), "\n").alias("text")))
    whole = one.join(bad, "file_path", "left_anti").unionByName(joined)
    text = F.regexp_replace(F.col("text"), r"\r\z", "")
    return whole.withColumn("text", F.when(F.col("record") == 0, F.ltrim(text, F.lit("﻿"))).otherwise(text)), bad


def fields_of(text: Column, syntax: Syntax) -> Column:
    """The field values of a record's text, as an array."""
    def value(f: Column) -> Column:
        inner = F.replace(F.regexp_extract(f, syntax.quoted, 1), F.lit(syntax.quote * 2), F.lit(syntax.quote))
        return F.when(f.rlike(syntax.quoted), F.concat(inner, F.regexp_extract(f, syntax.quoted, 2))).otherwise(f)
    return F.transform(F.regexp_extract_all(F.concat(F.lit(syntax.sep), text), F.lit(syntax.fields), F.lit(1)), value)


def delimited_cells(spark: SparkSession, paths, sep: str = ",", quote: str = '"', sheet_name: str = "DATA", typed: bool = True) -> DataFrame:
    """A4: ``file_path, file_name, sheet_name, row_idx, col_idx, kind, text`` of
    every field of the files; ``row_idx`` is the record's number from 0, blank
    records included.

    Kind ``s``, or with ``typed`` ``n`` for a plain number, or null for an empty
    field. A file with a quote that is never closed has one row of kind ``fatal``
    that says so. Only ``\\n`` and ``\\r\\n`` end a line.
    """
    if len(sep) != 1 or len(quote) != 1 or re.match(r"\s", quote):
        raise ValueError("separator and quote are single characters")
    syntax = Syntax(sep, quote)
    rows, bad = records(spark, paths, syntax)
    cells = rows.filter(F.col("text") != "").select("file_path", F.col("record").alias("row_idx"), F.posexplode(fields_of(F.col("text"), syntax)).alias("col_idx", "text"))
    number = F.col("text").rlike(r"^[+-]?[0-9]+(?:\.[0-9]+)?$") if typed else F.lit(False)
    kind = F.when(F.col("text") == "", F.lit(None).cast("string")).when(number, F.lit("n")).otherwise(F.lit("s"))
    cells = cells.withColumns({"kind": kind, "text": F.when(F.col("text") != "", F.col("text"))})
    nothing = F.lit(None).cast("int")
    fatal = bad.select("file_path", nothing.cast("long").alias("row_idx"), nothing.alias("col_idx"), F.col("reason").alias("text"), F.lit("fatal").alias("kind"))
    return cells.unionByName(fatal).select("file_path", F.element_at(F.split("file_path", "/"), -1).alias("file_name"), F.lit(sheet_name).alias("sheet_name"),
                                           "row_idx", "col_idx", "kind", "text")

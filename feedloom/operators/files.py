"""File inventory, vendor match and disposition.

A file list is metadata (one row per file), orders of magnitude smaller
than the rows inside the files; rule tables are config-sized. A file is told by
its path: files of one name in two folders are two files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ids import global_index
from .substrings import INLINE_RULES, first_substring

# Workbook suffixes the mapped ingest accepts (any case), the
# raw landing also takes binary workbooks; lock files start with "~$".
MAPPED_SUFFIXES = (".xlsx", ".xlsm", ".xls")
RAW_SUFFIXES = (".xlsx", ".xlsm", ".xlsb", ".xls")
LOCK_PREFIX = "~$"


def with_name_parts(files: DataFrame, path_col: str = "path") -> DataFrame:
    p = F.col(path_col)
    name = F.element_at(F.split(p, "/"), -1)
    return files.withColumns({
        "file_name": name,
        "ext": F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1)),
        "stem": F.regexp_replace(name, r"\.[^.]*$", ""),
    })


def file_inventory(files: DataFrame, suffixes=MAPPED_SUFFIXES, exclude_dirs=(), path_col: str = "path",
                   number: bool = True) -> DataFrame:
    """A1: keep workbook files, drop lock files and excluded folders, and
    order them by path, part by part, like a sorted directory walk.

    ``number=True`` adds a dense ``file_seq`` from 1. ``number=False`` makes
    ``file_seq`` the path-parts array itself, which orders the same way; the
    ingest and the reports use that form.
    """
    df = with_name_parts(files, path_col)
    keep = (~F.col("file_name").startswith(LOCK_PREFIX)) & F.col("ext").isin(*suffixes)
    # Compare without a local "file:" scheme, so "/in/archive" also excludes "file:/in/archive/x".
    plain = F.regexp_replace(F.col(path_col), r"^file:(//)?", "")
    for d in exclude_dirs:
        d = re.sub(r"^file:(//)?", "", str(d)).rstrip("/") + "/"
        keep = keep & ~plain.startswith(d)
    df = df.filter(keep)
    df = df.withColumn("file_seq", F.split(F.col(path_col), "/"))
    if not number:
        return df
    return global_index(df, ["file_seq"], "__n", base=1).withColumn("file_seq", F.col("__n")).drop("__n")


def vendor_match(files: DataFrame, rules: DataFrame, inline: int = INLINE_RULES) -> DataFrame:
    """A2: first mapping (list order) with a pattern contained in the
    lower-cased file name; unmatched files get ``vendor_code`` NULL and status
    ``skipped``.

    A rule table of at most ``inline`` rows is read once on the driver and
    tested as one array in list order, so a file needs no join. A larger one
    stays a table: file names look up its patterns by trigrams
    (:func:`~feedloom.operators.substrings.first_substring`).
    """
    order = ["mapping_seq", "pattern_seq"]
    named = files.withColumn("__low", F.lower(F.col("file_name")))
    listed = rules.orderBy(*order).take(inline + 1)
    if len(listed) > inline:
        hits = first_substring(named, "__low", rules, order).select(F.col("text").alias("__low"), F.col("rule").alias("__hit"))
        found = named.join(hits, "__low", "left")
    else:
        hit = F.lit(None).cast("struct<vendor_code: string, mapping_seq: int>")
        if listed:
            table = F.array(*[F.struct(F.lit(r["vendor_code"]).cast("string").alias("vendor_code"), F.lit(r["mapping_seq"]).alias("mapping_seq"),
                                       F.lit(r["pattern"]).alias("pattern")) for r in listed])
            hit = F.get(F.filter(table, lambda r: F.col("__low").contains(r["pattern"])), F.lit(0))
        found = named.withColumn("__hit", hit)
    skipped = F.col("__hit").isNull()
    return found.select(
        *files.columns, F.col("__hit.vendor_code").alias("vendor_code"), F.col("__hit.mapping_seq").alias("mapping_seq"),
        F.when(skipped, F.lit("skipped")).otherwise(F.lit("matched")).alias("status"),
        F.when(skipped, F.lit("No vendor mapping matched file_name")).alias("reason"))


def disposition(files: DataFrame, existing: DataFrame, run_stamp: str,
                archive_dir: str = "/in/archive", error_dir: str = "/in/error") -> DataFrame:
    """Where each processed file goes. A name already present in the
    destination, or taken there by an earlier file of the run, gets
    ``_<run_stamp>`` before its suffix, and ``_<n>`` too from the third file on.

    ``files`` carries ``status`` (matched or ok / skipped / failed); ``existing``
    lists ``(dir, file_name)`` already in the destinations.
    """
    done = F.col("status").isin("matched", "ok")
    dest_dir = F.when(done, F.lit(archive_dir)).when(F.col("status") == "failed", F.lit(error_dir))
    df = files.withColumn("dest_dir", dest_dir)
    taken = existing.select(F.col("dir").alias("dest_dir"), "file_name").distinct().withColumn("__taken", F.lit(1))
    df = df.join(taken, ["dest_dir", "file_name"], "left")
    # Files of one name and destination: a window over equal names only.
    place = F.row_number().over(Window.partitionBy("dest_dir", "file_name").orderBy("path")) - 1 + F.coalesce("__taken", F.lit(0))
    more = F.when(F.col("__place") > 1, F.concat(F.lit("_"), F.col("__place").cast("string"))).otherwise(F.lit(""))
    name = F.when(F.col("__place") > 0, F.concat("stem", F.lit("_" + run_stamp), more, F.regexp_extract("file_name", r"(\.[^.]*)$", 1))).otherwise(F.col("file_name"))
    df = df.withColumn("__place", place)
    return df.select(
        *[c for c in files.columns],
        F.when(done, F.lit("archived")).when(F.col("status") == "failed", F.lit("error")).otherwise(F.lit("skipped")).alias("disposition"),
        F.when(F.col("dest_dir").isNotNull(), F.concat(F.col("dest_dir"), F.lit("/"), name)).alias("moved_to"),
    )

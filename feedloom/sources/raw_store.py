"""Raw landing tables of any number of sheets, written by one job.

Sheets have columns of their own, so their tables differ; a job, or a pivot, for
each sheet would read the landing as often as there are sheets. Here every row of
every sheet is one row with a map of its values, in a folder partitioned by table
name, and the sheets' columns are rows of a second folder. Both are replaced
table by table (dynamic partition overwrite): a reload replaces the tables of the
sheets it holds and no others. :func:`read_raw_table` gives one table in its wide
form, with its own columns in sheet order; it reads that table's files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = ("raw_id long, source_file string, source_sheet string, header_row long, source_row_number long, loaded_at timestamp, "
        "values map<string, string>, table_name string")
COLUMNS = "col_idx int, stored_column_name string, original_header string, table_name string"
LINEAGE = ["raw_id", "source_file", "source_sheet", "header_row", "source_row_number", "loaded_at"]
#: Rows of a table that one task writes: a sheet with a third of all rows is
#: dealt to many.
ROWS_PER_FILE = 1 << 18


def table_sheets(tables: DataFrame) -> DataFrame:
    """``source_file, source_sheet, table_name``: the sheet behind each table; of
    several with one table name the last in file order, as each replaces the one
    before."""
    last = F.max(F.struct("file_name", "sheet_name")).alias("s")
    return tables.groupBy("table_name").agg(last).select(F.col("s.file_name").alias("source_file"), F.col("s.sheet_name").alias("source_sheet"), "table_name")


def raw_rows(landed: dict[str, DataFrame], loaded_at=None) -> DataFrame:
    """The rows of all tables in the form of ``ROWS``. A row has at most as many
    values as a sheet has columns."""
    keys = ["table_name", "source_file", "source_sheet", "header_row", "source_row_number"]
    at = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    filled = F.when(F.col("value").isNotNull(), F.struct("stored_column_name", "value"))
    rows = (landed["landing"].join(table_sheets(landed["tables"]), ["source_file", "source_sheet"])
            .groupBy(*keys).agg(F.map_from_entries(F.collect_list(filled)).alias("values")))
    return rows.select((F.col("source_row_number") + 1).alias("raw_id"), *keys[1:], at.alias("loaded_at"), "values", "table_name")


def write_raw_rows(landed: dict[str, DataFrame], root: str, loaded_at=None) -> None:
    """Write the tables of a load (:func:`~feedloom.operators.landing.raw_landing`)
    under ``root``: one job for the rows, one for the columns."""
    def replace(df: DataFrame, path: str) -> None:
        df.write.partitionBy("table_name").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)

    rows = raw_rows(landed, loaded_at)
    replace(rows.repartition("table_name", F.expr(f"source_row_number div {ROWS_PER_FILE}")), f"{root}/rows")
    sheets = table_sheets(landed["tables"]).select(F.col("source_file").alias("file_name"), F.col("source_sheet").alias("sheet_name"), "table_name")
    columns = landed["columns"].join(sheets, ["file_name", "sheet_name"]).select("col_idx", "stored_column_name", "original_header", "table_name")
    replace(columns.repartition("table_name"), f"{root}/columns")


def read_raw_rows(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all tables, values as maps."""
    return spark.read.schema(ROWS).parquet(f"{root}/rows")


def raw_table_names(spark: SparkSession, root: str) -> list[str]:
    """The tables under ``root`` (one name a folder)."""
    found = spark.read.schema(COLUMNS).parquet(f"{root}/columns").select("table_name").distinct()
    return sorted(r["table_name"] for r in found.collect())


def read_raw_table(spark: SparkSession, root: str, table_name: str) -> DataFrame:
    """One table in its wide form: lineage, then its columns in sheet order, all
    text."""
    columns = spark.read.schema(COLUMNS).parquet(f"{root}/columns").filter(F.col("table_name") == table_name)
    names = [r["stored_column_name"] for r in columns.orderBy("col_idx").select("stored_column_name").collect()]  # a sheet's columns
    if not names:
        raise ValueError(f"there is no raw table {table_name}")
    rows = read_raw_rows(spark, root).filter(F.col("table_name") == table_name)
    return rows.select(*LINEAGE, *[F.col("values")[n].alias(n) for n in names])


def register_views(spark: SparkSession, root: str, names: list[str] | None = None) -> list[str]:
    """A temporary view for each table, so that SQL names it like a table."""
    names = raw_table_names(spark, root) if names is None else names
    for n in names:
        read_raw_table(spark, root, n).createOrReplaceTempView(f"`{n}`")
    return names

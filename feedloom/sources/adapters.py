"""Supplier-feed shaped inputs derived from the driver tables.

The adapters are plain SQL shared with the DuckDB oracle (``{part}`` and
``{supplier}`` are table placeholders). Spark runs them through
``spark.sql(text, part=df)``, so they are ordinary lazy plans over the whole
parquet tables, with column pruning into the scan. ``feed_grid`` is built
with the DataFrame API instead: its per-brand row number uses the skew-safe
:func:`positional_index` rather than one window task per brand, and its
five-column fan-out is an ``explode`` rather than a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ids import positional_index

FEED_PARTS_SQL = """
SELECT p_partkey AS row_idx,
       p_brand AS vendor_code,
       concat('feed_', CAST(p_partkey % 4 AS STRING), '.xlsx') AS file_name,
       CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN '  '
            WHEN p_partkey % 23 = 0 THEN '0'
            ELSE concat('SKU-', CAST(p_partkey % 40 AS STRING)) END AS sku,
       CASE WHEN p_partkey % 46 = 0 THEN 'n' ELSE 's' END AS sku_kind,
       CASE p_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN concat('52 Inch Ceiling Fan ', p_name)
            WHEN 3 THEN concat(p_name, ' PENDANT') WHEN 4 THEN concat('remote for ', p_name)
            WHEN 5 THEN 'Fan' WHEN 6 THEN concat(p_name, ' chair') WHEN 7 THEN 'wall art' ELSE p_name END AS short_description,
       concat(p_type, ' ', p_name, CASE WHEN p_partkey % 13 = 0 THEN ' high CFM' ELSE '' END) AS product_name,
       CASE p_partkey % 10 WHEN 0 THEN concat('$', CAST(p_size AS STRING), ',500.25')
            WHEN 1 THEN concat(CAST(p_size AS STRING), ' - ', CAST(p_size + 10 AS STRING))
            WHEN 2 THEN '-' WHEN 3 THEN 'N/A' WHEN 4 THEN concat(CAST(p_size AS STRING), 'W')
            WHEN 5 THEN concat(' ', CAST(p_size AS STRING), '.5 ') WHEN 6 THEN '10D' WHEN 7 THEN '1e3'
            WHEN 8 THEN concat('-', CAST(p_size AS STRING), '-10') ELSE NULL END AS dnprice,
       CASE p_partkey % 7 WHEN 0 THEN 'Yes' WHEN 1 THEN ' n ' WHEN 2 THEN 'Included' WHEN 3 THEN 'not included'
            WHEN 4 THEN 'maybe' WHEN 5 THEN 'na' ELSE NULL END AS lamps_supplied,
       CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN '  ' ELSE 'frosted' END AS glass,
       CASE WHEN p_partkey % 2 = 0 THEN 'linen' ELSE NULL END AS shade_material,
       CASE WHEN p_partkey % 11 = 0 THEN '52' ELSE NULL END AS blade_span,
       CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size AS STRING) ELSE '' END AS canopy_height_inches,
       CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'EUR' ELSE 'CAD' END AS currency_code
FROM {part}
"""

FEED_HEADERS_SQL = """
SELECT p_type AS sheet_name, p_partkey AS col_idx,
       CASE p_partkey % 6 WHEN 0 THEN concat('  ', upper(p_name), ' (IN.) ') WHEN 1 THEN concat(p_name, ' - ', p_brand)
            WHEN 2 THEN '#' WHEN 3 THEN NULL
            WHEN 4 THEN concat(repeat('long ', 26), p_name) ELSE concat(p_name, '__', CAST(p_size AS STRING)) END AS original_header
FROM {part}
"""

FEED_GRID_SQL = """
WITH r AS (SELECT p.*, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INT) AS row_idx FROM {part} p),
     k AS (SELECT r.*, p_partkey % 12 AS m, CAST(substring(p_brand, 7) AS INT) % 4 AS hdr FROM r)
SELECT p_brand AS sheet_name, row_idx, col_idx,
       CASE WHEN row_idx <> hdr AND m = 5 THEN NULL
            WHEN row_idx < hdr AND col_idx > 0 THEN NULL
            WHEN col_idx = 4 THEN NULL
            WHEN row_idx <= hdr OR col_idx < 2 THEN 's' ELSE 'n' END AS kind,
       CASE WHEN row_idx <> hdr AND m = 5 THEN NULL
            WHEN row_idx < hdr AND col_idx > 0 THEN NULL
            WHEN col_idx = 4 THEN NULL
            WHEN row_idx = hdr THEN concat('Head ', CAST(col_idx AS STRING))
            WHEN row_idx < hdr THEN 'Title'
            WHEN col_idx = 0 THEN p_name WHEN col_idx = 1 THEN p_type
            ELSE CAST(p_size + col_idx AS STRING) END AS text
FROM k CROSS JOIN (SELECT 0 AS col_idx UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) c
"""

FEED_FILES_SQL = """
SELECT s_suppkey AS file_id,
       concat('/in/', CASE s_suppkey % 4 WHEN 0 THEN 'archive/' WHEN 1 THEN 'sub/' ELSE '' END,
              CASE WHEN s_suppkey % 7 = 0 THEN '~$' ELSE '' END,
              CASE s_suppkey % 3 WHEN 0 THEN 'Example1_Data_' WHEN 1 THEN 'EXAMPLE2_data_' ELSE 'other_' END,
              CAST(s_suppkey AS STRING),
              CASE s_suppkey % 5 WHEN 0 THEN '.xlsx' WHEN 1 THEN '.XLSM' WHEN 2 THEN '.xls' WHEN 3 THEN '.csv' ELSE '.xlsb' END) AS path
FROM {supplier}
"""

ADAPTERS = {
    "feed_parts": FEED_PARTS_SQL,
    "feed_headers": FEED_HEADERS_SQL,
    "feed_grid": FEED_GRID_SQL,
    "feed_files": FEED_FILES_SQL,
}

# The grid has one "workbook"; its sheets are the brands.
GRID_FILE = "grid.xlsx"


def duckdb_cte(*names: str) -> str:
    """``WITH`` clause defining the named adapters over DuckDB's table views."""
    parts = [f"{n} AS ({ADAPTERS[n].format(part='part', supplier='supplier').strip()})" for n in names]
    return "WITH " + ",\n".join(parts)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FEED_PARTS_SQL, part=table(spark, sf_dir, "part"))


def feed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FEED_HEADERS_SQL, part=table(spark, sf_dir, "part"))


def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FEED_FILES_SQL, supplier=table(spark, sf_dir, "supplier"))


def feed_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed cells ``(sheet_name, row_idx, col_idx, kind, text)``, same rows as FEED_GRID_SQL."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_type", "p_size")
    p = positional_index(p, ["p_brand"], ["p_partkey"], "row_idx").withColumn("row_idx", F.col("row_idx").cast("int"))
    p = p.withColumns({
        "m": F.col("p_partkey") % 12,
        "hdr": F.substring("p_brand", 7, 100).try_cast("int") % 4,
        "col_idx": F.explode(F.array(*[F.lit(i) for i in range(5)])),
    })
    r, c, hdr, m = F.col("row_idx"), F.col("col_idx"), F.col("hdr"), F.col("m")
    blank = ((r != hdr) & (m == 5)) | ((r < hdr) & (c > 0)) | (c == 4)
    kind = F.when(blank, F.lit(None).cast("string")).when((r <= hdr) | (c < 2), F.lit("s")).otherwise(F.lit("n"))
    text = (
        F.when(blank, F.lit(None).cast("string"))
        .when(r == hdr, F.concat(F.lit("Head "), c.cast("string")))
        .when(r < hdr, F.lit("Title"))
        .when(c == 0, F.col("p_name"))
        .when(c == 1, F.col("p_type"))
        .otherwise((F.col("p_size") + c).cast("string"))
    )
    return p.select(F.col("p_brand").alias("sheet_name"), "row_idx", c.alias("col_idx"),
                    kind.alias("kind"), text.alias("text"))

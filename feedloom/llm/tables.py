"""Reading the given tables and small Spark helpers of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import ship_package


def prepare(spark: SparkSession) -> None:
    """Make the package importable in tasks, and keep Arrow batches small, as
    they hold whole texts."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, mod: int, rest: int) -> Column:
    """crc32(doc_id as text) mod ``mod`` is ``rest``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % mod == rest, F.lit(False))

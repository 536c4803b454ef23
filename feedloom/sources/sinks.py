"""Sinks: snapshot tables, log files and the JDBC staging sink.

The relational target is reached the set-based way: each snapshot is bulk
written with the JDBC writer (``batchsize`` rows per round trip) into a
staging table; the target database then swaps or merges the staging table in
one statement. No per-row statements, no driver-side row loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_snapshot(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """A new snapshot version as Parquet at ``path`` (never the one being read)."""
    (df.repartition(partitions) if partitions else df).write.mode("overwrite").parquet(path)


def replace_table(df: DataFrame, table: str) -> None:
    """H9: drop-and-create a raw landing table (all text + lineage)."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 batchsize: int = 10000, isolation: str = "READ_COMMITTED", **extra) -> dict:
    """Options for ``DataFrameWriter.jdbc`` / ``format("jdbc")``."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize), "isolationLevel": isolation}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_jdbc(df: DataFrame, url: str, staging_table: str, mode: str = "overwrite", num_partitions: int | None = None,
               **options) -> None:
    """Bulk-load a snapshot into a staging table over JDBC.

    ``num_partitions`` caps concurrent connections (one per partition).
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.format("jdbc").options(**jdbc_options(url, staging_table, **options)).mode(mode).save()

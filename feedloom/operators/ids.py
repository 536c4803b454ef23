"""Distributed, skew-safe positional numbering.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends a whole group to
one task; a sheet or a file can hold a third of all rows. Here the order is
cut into buckets of at most ``2**bucket_bits`` consecutive order values, so
each window task sees one bounded bucket, and a small per-bucket count
table (one row per bucket) gives every bucket its starting offset.
Everything is deterministic (no partition ids, no sampling), so a lost
executor recomputes the same numbers.

Plan shape: the input is hash-partitioned once on one struct key
``(group, order prefix, bucket)``; the window, the per-bucket count and the
join back all reuse that partitioning, so only the tiny count table moves
again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table

KEY = "__pi_key"


def global_index(df: DataFrame, order_by: list[str], out: str, base: int = 0) -> DataFrame:
    """Add ``out`` = ``base`` + 0-based position of the row in the order of
    ``order_by`` (unique) over the whole table, for any column types.

    The rows are range partitioned and written once to the shared folder; the
    row counts of the range partitions (one row each) give their offsets.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by]
    staged = stage_table(df.repartitionByRange(*order).sortWithinPartitions(*order), "index").withColumn("__part", F.col("_metadata.file_name"))
    local = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    low = F.min(F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in order_by])).alias("low")
    counts = staged.groupBy("__part").agg(F.count(F.lit(1)).alias("n"), low)
    # One row for each range partition.
    offset = F.coalesce(F.sum("n").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__part", offset.alias("__offset"))
    return (staged.withColumn("__local", local).join(F.broadcast(offsets), "__part")
            .withColumn(out, (F.col("__offset") + F.col("__local") + F.lit(base)).cast("bigint")).drop("__part", "__local", "__offset"))


def positional_index(
    df: DataFrame,
    partition_by: list[str],
    order_by: list[str],
    out: str,
    bucket_bits: int = 16,
    base: int = 0,
) -> DataFrame:
    """Add ``out`` = ``base`` + 0-based position of the row in its group.

    Without groups the whole table is one order; see :func:`global_index`.

    ``order_by`` must be unique within a group; its last column must be an
    integer (row index, key, sequence); earlier ones may be of any type.
    """
    if not partition_by:
        return global_index(df, order_by, out, base)
    *prefix, last = order_by
    gkeys = list(partition_by) + list(prefix)
    # A struct key is never NULL and compares NULL fields as equal, so one
    # equi-join key covers NULL groups without a null-safe rewrite.
    keyed = df.withColumn(KEY, F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(gkeys)],
                                        F.shiftright(F.col(last).cast("bigint"), bucket_bits).alias("b")))
    ranked = keyed.withColumn(
        "__pi_local", F.row_number().over(Window.partitionBy(KEY).orderBy(*order_by)) - 1)

    stats = ranked.groupBy(KEY).agg(F.count(F.lit(1)).alias("__pi_n"))
    k = F.col(KEY)
    order = [k[f"k{i}"] for i in range(len(partition_by), len(gkeys))] + [k["b"]]
    spec = Window.partitionBy(*[k[f"k{i}"] for i in range(len(partition_by))]).orderBy(*order)
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(KEY, F.coalesce(F.sum("__pi_n").over(before), F.lit(0)).alias("__pi_offset"))
    return (
        ranked.join(stats, KEY, "inner")
        .withColumn(out, (F.col("__pi_offset") + F.col("__pi_local") + F.lit(base)).cast("bigint"))
        .drop(KEY, "__pi_local", "__pi_offset")
    )

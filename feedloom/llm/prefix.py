"""Global prefix sums over one order of all rows, without a global task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import stage_table

COPY_BLOCK = 1 << 16


def prefix_sums(rows: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``keys`` of every row with ``before`` (sum of ``size`` of all earlier
    rows), ``row`` (number of earlier rows) and ``total`` (sum of all sizes), in
    the order of ``keys`` (nulls first). ``size`` is one of the keys and not null.

    Equal rows are counted before the shuffle and carried as blocks of at most
    ``COPY_BLOCK`` copies, so no key, however frequent, is one task's work. The
    range partitions of the order are written once to the shared folder; their
    totals (one row each) give every partition its start, and a running sum
    inside the partition does the rest.
    """
    blocks = (rows.groupBy(*keys).agg(F.count("*").alias("n"))
              .select(*keys, "n", F.explode(F.sequence(F.lit(0), F.expr(f"cast((n - 1) div {COPY_BLOCK} as int)"))).alias("block"))
              .select(*keys, "block", F.least(F.lit(COPY_BLOCK), F.col("n") - F.col("block") * COPY_BLOCK).alias("n")))
    order = [F.col(c).asc_nulls_first() for c in (*keys, "block")]
    staged = stage_table(blocks.repartitionByRange(*order), "prefix")
    base = staged.withColumn("part", F.col("_metadata.file_name"))

    low = F.min(F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in (*keys, "block")]))
    totals = base.groupBy("part").agg(F.sum(F.col("n") * F.col(size)).alias("part_size"), F.sum("n").alias("part_rows"), low.alias("low"))
    # One row for each range partition: the only window over the whole table.
    earlier = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select(
        "part",
        F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("part_size").over(Window.partitionBy()).alias("total"))

    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (base
            .withColumns({"b": F.coalesce(F.sum(F.col("n") * F.col(size)).over(inside), F.lit(0)),
                          "r": F.coalesce(F.sum("n").over(inside), F.lit(0))})
            .join(F.broadcast(parts), "part")  # one row for each range partition
            .select(*keys, (F.col("b") + F.col("size_before")).alias("b"), (F.col("r") + F.col("rows_before")).alias("r"), "total",
                    F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("copy"))
            .select(*keys, (F.col("b") + F.col("copy") * F.col(size)).alias("before"), (F.col("r") + F.col("copy")).alias("row"), "total"))

"""Contiguous shards of near-equal byte size from global prefix sums.

Rows are put in one global order; partition totals and running sums give every
row its global byte offset (see ``prefix``), and the row belongs to the shard
whose equal share of all bytes holds the middle of the row. Only narrow columns
move (id, size, checksum), never the texts. Built-in SQL functions only.

Defined cases: a null text has size 8 and a null checksum; null ids sort first;
repeated rows are separate rows with neighbouring offsets; an empty table gives
an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import prefix_sums

ROW_OVERHEAD = 8


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``.

    Order: id (nulls first), checksum, size. ``slot`` counts from 0 inside the
    shard. A row's shard is ``floor((offset + size / 2) * shards / total)``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
                       (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"))
    placed = prefix_sums(rows, ["doc_id", "text_crc32", "size"], "size")
    cut = placed.withColumn("shard", F.expr(f"cast(least({shards - 1}, ((2 * before + size) * {shards}) div (2 * total)) as int)"))
    first = F.broadcast(cut.groupBy("shard").agg(F.min("row").alias("first_row")))  # one row for each shard
    return cut.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"))

"""Set-based upserts into snapshot tables (H1-H8).

Per-row MERGE statements become one plan per run:

* H3: the batch is folded to one row per natural key (last write wins,
  currency = last non-null), a partial aggregate before the shuffle, so a
  hot key costs one row per map task;
* H1/H2/H4: a full outer equi-join of the target snapshot and the folded
  batch. Both sides are unique on the key, so the join cannot blow up;
  the batch side arrives already hash-partitioned on the key by the fold;
* H5/H6: the same pattern keyed on ``product_id`` for attribute tables,
  anti-join + append for presence tables;
* H7/H8: routing by category, failed files removed before the fold.

:func:`merge_run` gives new DataFrames (new snapshots). Targets that stay, with a
commit log and growing buckets, are in :mod:`snapshots`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (
    ATTRIBUTE_TABLES, CORE_COLUMNS, DEFAULT_CURRENCY, KEY_COLUMNS, PRESENCE_TABLES, SQL_TYPES,
)
from ..session import stage_table
from .ids import global_index

KEY = list(KEY_COLUMNS)
ORDER = ["file_seq", "sheet_seq", "row_idx"]
CORE_ATTRS = [c for c, _ in CORE_COLUMNS if c not in KEY_COLUMNS]
CORE_OUT = ["product_id"] + [c for c, _ in CORE_COLUMNS]


def _seq() -> Column:
    return F.struct(*[F.col(c) for c in ORDER])


def last_write_wins(ok_rows: DataFrame) -> DataFrame:
    """H3: one row per key, as left by merging the rows in feed order.

    Every attribute comes from the last row (NULLs included); the currency
    is the last non-NULL one (NULL when none came in); ``first_*`` keeps the
    first-seen position for id assignment. The same single aggregate also
    folds each attribute table among the rows routed to it
    (``<table>_rec``, NULL when none was) and the presence flags
    (``in_<table>``), so one shuffle serves every destination table.
    """
    seq = _seq()
    attrs = [c for c in CORE_ATTRS if c != "currency_code"]
    cur = F.col("currency_code")
    cat = F.col("category_type")
    aggs = [
        F.max_by(F.struct(*attrs), seq).alias("last"),
        F.max_by(cur, F.when(cur.isNotNull(), seq)).alias("currency_code"),
        F.min(seq).alias("first"),
        F.count(F.lit(1)).alias("n_rows"),
    ]
    extra = []
    for t in ATTRIBUTE_TABLES:
        if t in ok_rows.columns:
            aggs.append(F.max_by(F.col(t), F.when(F.col(t).isNotNull(), seq)).alias(f"{t}_rec"))
            extra.append(f"{t}_rec")
    for t in PRESENCE_TABLES:
        aggs.append(F.coalesce(F.bool_or(cat == F.lit(t)), F.lit(False)).alias(f"in_{t}"))
        extra.append(f"in_{t}")
    folded = ok_rows.groupBy(*KEY).agg(*aggs)
    return folded.select(
        *KEY, "last.*", "currency_code",
        F.col("first.file_seq").alias("first_file_seq"),
        F.col("first.sheet_seq").alias("first_sheet_seq"),
        F.col("first.row_idx").alias("first_row_idx"),
        "n_rows", *extra,
    )


def empty_core(spark) -> DataFrame:
    cols = ", ".join([f"{n} {SQL_TYPES[k]}" for n, k in [("product_id", "I")] + CORE_COLUMNS])
    return spark.createDataFrame([], cols)


FIRST = ["first_file_seq", "first_sheet_seq", "first_row_idx"]


def merge_core(target: DataFrame, folded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """H1 + H2 + H4: upsert the folded batch into the core snapshot.

    Matched keys take every incoming attribute (NULLs too) and
    ``COALESCE(new, old)`` currency; new keys get ``COALESCE(new, 'USD')``
    and ids ``max(product_id) + 1 ...`` in first-seen order. Existing ids
    never change. ``keep`` passes extra folded columns through (NULL for
    target-only keys).

    The target is scanned once, by one full outer join, whose result is written
    as a columnar table. Ids are numbered on the narrow set of new keys in it
    (key + first position).
    """
    keep = list(keep or [])
    s = folded.select(*KEY, *[F.col(c).alias(f"s_{c}") for c in CORE_ATTRS], *FIRST, *keep, F.lit(True).alias("__s"))
    t = target.select(*CORE_OUT).withColumn("__t", F.lit(True))
    in_s, in_t = F.col("__s").isNotNull(), F.col("__t").isNotNull()
    cols = {}
    for c in CORE_ATTRS:
        if c == "currency_code":
            cols[c] = (
                F.when(in_s & in_t, F.coalesce(F.col("s_currency_code"), F.col(c)))
                .when(in_s, F.coalesce(F.col("s_currency_code"), F.lit(DEFAULT_CURRENCY)))
                .otherwise(F.col(c))
            )
        else:
            cols[c] = F.when(in_s, F.col(f"s_{c}")).otherwise(F.col(c))
    joined = stage_table(t.join(s, KEY, "full_outer").withColumns(cols).select(*CORE_OUT, *FIRST, *keep), "merged")
    max_id = joined.agg(F.coalesce(F.max("product_id"), F.lit(0))).first()[0]
    new = joined.filter(F.col("product_id").isNull())
    ids = global_index(new.select(*KEY, *FIRST), FIRST, "__id", base=int(max_id) + 1).select(*KEY, "__id")
    known = joined.filter(F.col("product_id").isNotNull()).select(*CORE_OUT, *keep)
    return known.unionByName(new.drop("product_id").join(ids, KEY).withColumnRenamed("__id", "product_id").select(*CORE_OUT, *keep))


def first_load(folded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """H1 into an empty table: every key is new, ids ``1..n`` in first-seen
    order, currency ``COALESCE(new, 'USD')`` (no join with a target)."""
    ided = global_index(folded, FIRST, "product_id", base=1)
    cols = {"currency_code": F.coalesce(F.col("currency_code"), F.lit(DEFAULT_CURRENCY))}
    return ided.withColumns(cols).select(*CORE_OUT, *(keep or []))


def merge_attributes(target: DataFrame | None, merged: DataFrame, table: str) -> DataFrame:
    """H5a-c: full-overwrite upsert of an attribute table keyed on ``product_id``.

    ``merged`` is the core merge output carrying ``<table>_rec``.
    """
    names = [n for n, _ in ATTRIBUTE_TABLES[table]]
    rec = f"{table}_rec"
    src = merged.filter(F.col(rec).isNotNull()).select(
        "product_id", *[F.col(f"{rec}.{n}").alias(f"s_{n}") for n in names], F.lit(True).alias("__s"))
    if target is None:
        return src.select("product_id", *[F.col(f"s_{n}").alias(n) for n in names])
    j = target.select("product_id", *names).join(src, "product_id", "full_outer")
    in_s = F.col("__s").isNotNull()
    return j.select("product_id", *[F.when(in_s, F.col(f"s_{n}")).otherwise(F.col(n)).alias(n) for n in names])


def insert_if_absent(target: DataFrame | None, merged: DataFrame, table: str) -> DataFrame:
    """H6: presence tables only gain ids (``IF NOT EXISTS ... INSERT``)."""
    ids = merged.filter(F.coalesce(F.col(f"in_{table}"), F.lit(False))).select("product_id")
    if target is None:
        return ids
    tgt = target.select("product_id")
    return tgt.unionByName(ids.join(tgt, "product_id", "left_anti"))


def exclude_failed_files(rows: DataFrame, failed_files: DataFrame) -> DataFrame:
    """H8: a failed file (``path``) contributes nothing; row errors do not fail
    their file."""
    return rows.join(failed_files.select(F.col("path").alias("source_path")).distinct(), "source_path", "left_anti")


def _folded_extras(folded: DataFrame) -> list[str]:
    return [c for c in folded.columns if c.endswith("_rec") or c.startswith("in_")]


def merge_run(targets: dict[str, DataFrame], ok_rows: DataFrame) -> dict[str, DataFrame]:
    """H1-H7 for one run: new snapshots of core and every category table.

    Attribute tables fold the rows routed to them (not the core winner), so
    a key seen as lighting and then as fans updates both tables, and a
    product that changes category keeps its old attribute row.
    """
    folded = last_write_wins(ok_rows)
    extra = _folded_extras(folded)
    tgt_core = targets.get("core")
    # The merged core is a columnar table: the tables below read only their own
    # columns of it.
    merged = first_load(folded, keep=extra) if tgt_core is None else merge_core(tgt_core, folded, keep=extra)
    out = {"core": merged.select(*CORE_OUT)}
    for table in ATTRIBUTE_TABLES:
        out[table] = merge_attributes(targets.get(table), merged, table)
    for table in PRESENCE_TABLES:
        out[table] = insert_if_absent(targets.get(table), merged, table)
    return out




def route_column() -> Column:
    """H7: the category table a row goes to; other categories stay core-only."""
    known = [*ATTRIBUTE_TABLES, *PRESENCE_TABLES]
    return F.when(F.col("category_type").isin(*known), F.col("category_type")).otherwise(F.lit("core_only"))


def route_categories(ok_rows: DataFrame) -> dict[str, DataFrame]:
    """H7: rows per destination table."""
    routed = ok_rows.withColumn("route", route_column())
    return {t: routed.filter(F.col("route") == t).drop("route") for t in [*ATTRIBUTE_TABLES, *PRESENCE_TABLES, "core_only"]}

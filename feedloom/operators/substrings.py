"""First pattern contained in a text, for any number of patterns.

Testing every pattern on every text is a cross join. Here each pattern is filed
under one of its grams, the one that the fewest patterns have. A gram has the
largest power of two of characters that the pattern has, so it is more than half
of the pattern: patterns are told apart by it however many there are. Each text
looks up its own grams, one equi-join for each gram size in use (few: powers of
two). What it finds is tested with ``contains``. Rules are numbered in their order
first, so that the first one of a text is the least number, which a hash aggregate
folds before the shuffle. Texts are compared as they stand; lower-case both sides
for a match in any case.

Rule tables and their grams look small to the planner (a scan's size is that of
its compressed files, and an exploded row counts as one); a broadcast of them would
pass through the driver. So the joins say how they are done, by counted rows; the
result is the same either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .ids import global_index

#: Rules that callers test as an array inside the row; more go through the join.
INLINE_RULES = 2000
#: Rows of a rule table that a join sends to every executor.
BROADCAST_ROWS = 1 << 16
#: Texts whose grams one task looks up.
TEXTS_PER_TASK = 1 << 17


def grams(text: Column, n: int | Column) -> Column:
    """The distinct runs of ``n`` characters of a text; none if it is shorter."""
    size = (F.lit(n) if isinstance(n, int) else n).cast("string")
    # Each character that begins a run is matched by itself, the run looked ahead for.
    return F.array_distinct(F.regexp_extract_all(text, F.concat(F.lit("(?s)(?=(.{"), size, F.lit("}))."))))


def filed_patterns(rules: DataFrame, order: list[str]) -> DataFrame:
    """``place, rule, pattern, n, key``: every distinct pattern with the first of its
    rules, numbered in their order, under its rarest gram: its size and hash."""
    first = rules.filter("pattern is not null").groupBy("pattern").agg(
        F.min_by(F.struct(*rules.columns), F.struct(*order)).alias("rule"))
    first = first.select("*", *[F.col(f"rule.{c}").alias(f"o{i}") for i, c in enumerate(order)])
    placed = global_index(first, [*[f"o{i}" for i in range(len(order))], "pattern"], "place")
    size = F.expr("if(pattern = '', 0, shiftleft(1, char_length(bin(char_length(pattern))) - 1))")
    placed = placed.select("place", "rule", "pattern", size.alias("n"))
    own = F.when(F.col("n") > 0, grams(F.col("pattern"), F.col("n"))).otherwise(F.array(F.lit("")))
    long = placed.select("place", F.explode(own).alias("gram")).select("place", F.xxhash64("gram").alias("key"))
    often = long.groupBy("key").agg(F.count("*").alias("f"))
    rarest = long.join(often.hint("merge"), "key").groupBy("place").agg(F.min(F.struct("f", "key")).alias("r")).select("place", F.col("r.key").alias("key"))
    return placed.join(rarest.hint("merge"), "place")


def first_substring(texts: DataFrame, text: str, rules: DataFrame, order: list[str]) -> DataFrame:
    """``text, rule``: for every distinct value of ``text`` that holds a pattern,
    the first such rule by ``order``. ``rules`` has a column ``pattern``; an empty
    pattern is in every text."""
    def beside(df: DataFrame, rows: int) -> DataFrame:
        return df.hint("broadcast" if rows <= BROADCAST_ROWS else "merge")

    distinct = stage_table(texts.filter(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct(), "texts")
    # A text has many grams: tasks are bounded by texts, not by their compressed bytes.
    distinct = distinct.repartition(1 + distinct.count() // TEXTS_PER_TASK, "text")
    filed = stage_table(filed_patterns(rules, order), "patterns")
    sizes = {r["n"]: r["count"] for r in filed.groupBy("n").count().collect()}  # one row for each power of two
    hits = distinct.select("text", F.lit(None).cast("long").alias("place")).limit(0)
    for n, rows in sorted(sizes.items()):
        own = F.explode(grams(F.col("text"), n) if n else F.array(F.lit(""))).alias("gram")
        looked = distinct.select("text", own).select("text", F.xxhash64("gram").alias("key")).join(
            beside(filed.filter(F.col("n") == n).select("key", "pattern", "place"), rows), "key")
        hits = hits.unionByName(looked.filter(F.col("text").contains(F.col("pattern"))).select("text", "place"))
    least = hits.groupBy("text").agg(F.min("place").alias("place"))
    return least.join(beside(filed.select("place", "rule"), sum(sizes.values())), "place").select("text", "rule")

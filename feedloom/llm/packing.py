"""Optimal length buckets and token-budget batches.

The lengths of all documents give one global histogram of distinct lengths.
Dynamic programming over it chooses the boundaries of at most ``buckets`` buckets
with the least padding: a document is padded to the longest length of its bucket.
The histogram is exact at any size. It is small beside the data: ``d`` distinct
lengths are ``d * d / 2`` tokens at least, so ten billion tokens have 141,422 at most.
A caller may pass ``cell`` (:func:`length_cell`) for a histogram of a fixed size: a
cell's lengths differ by less than 1 in ``PER_OCTAVE``, so the padding is then at
most that share of all tokens above the least possible.
Inside a bucket documents are put in
hashed order, counted by global prefix sums, and cut into batches whose padded
tokens stay within the budget. A document longer than the budget is whole and
alone in its batch.

Defined cases: null or wordless texts have length 0 and share the first bucket;
repeated rows are separate members; ties between plans go to the smaller first
cut; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import warnings
from array import array
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import stage_table

from .prefix import prefix_sums

#: Distinct lengths beyond which a caller is told of ``cell``.
MAX_LENGTHS = 1 << 20
EXACT = 256
PER_OCTAVE = 4096


def word_count(text: Column) -> Column:
    """Length in tokens: runs of bytes other than white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def length_cell(length: Column) -> Column:
    """The histogram cell of a length; cells keep the order of lengths."""
    octave = F.floor(F.log2(F.greatest(length, F.lit(1)).cast("double"))).cast("int")
    fine = F.floor((length / F.pow(F.lit(2.0), octave) - 1) * PER_OCTAVE)
    return F.when(length < EXACT, length).otherwise(EXACT + octave * PER_OCTAVE + fine).cast("int")


def choose_boundaries(tops: list[int], counts: list[int], buckets: int) -> list[int]:
    """Boundaries (longest lengths) with the least padded total. ``tops``:
    longest length of each cell, ascending; ``counts``: documents in it.

    With one bucket more, cells up to ``j`` cost ``top[j] upto[j + 1]`` plus the
    least of ``cost[i] - top[j] upto[i + 1]`` over the last cell ``i`` of the
    buckets before. These are lines in ``top[j]`` with falling slopes, asked at
    rising places, so their lower hull gives each least value in constant time
    on average. All numbers are whole."""
    upto = [0]
    for c in counts:
        upto.append(upto[-1] + c)
    cells = len(tops)
    cost = [t * u for t, u in zip(tops, upto[1:])]     # one bucket over cells 0..j
    cuts = []                                         # an array for each bucket, as cells may be many
    for _ in range(1, min(buckets, cells)):
        nxt, cut, hull, best = cost[:], array("q", [-1]) * cells, [], 0
        for j in range(1, cells):
            line = (-upto[j], cost[j - 1], j - 1)
            while len(hull) > 1 and _is_above(hull[-2], hull[-1], line):
                hull.pop()
            hull.append(line)
            best = min(best, len(hull) - 1)
            while best + 1 < len(hull) and hull[best + 1][0] * tops[j] + hull[best + 1][1] < hull[best][0] * tops[j] + hull[best][1]:
                best += 1
            slope, start, i = hull[best]
            if (total := tops[j] * upto[j + 1] + slope * tops[j] + start) < nxt[j]:
                nxt[j], cut[j] = total, i
        cuts.append(cut)
        cost = nxt
    j, ends = cells - 1, [cells - 1]
    for cut in reversed(cuts):
        if cut[j] >= 0:
            j = cut[j]
            ends.append(j)
    return sorted(tops[e] for e in ends)


def _is_above(a: tuple, b: tuple, c: tuple) -> bool:
    """Line ``b`` is nowhere below both ``a`` (steeper up) and ``c`` (steeper down)."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(docs: DataFrame, buckets: int = 16, token_budget: int = 65_536, id_col: str = "doc_id", text_col: str = "text",
         length: Column | None = None, cell: Callable[[Column], Column] | None = None) -> DataFrame:
    """``doc_id, n_tokens, bucket, bucket_tokens, batch, slot`` for every row.

    ``bucket_tokens`` is the padded length, ``batch`` counts from 0 inside the
    bucket and ``slot`` inside the batch."""
    text = F.col(text_col)
    # Texts are counted once; these narrow rows are read again by every step.
    rows = stage_table(docs.select(F.col(id_col).alias("doc_id"), (word_count(text) if length is None else length).alias("n_tokens"),
                                   F.crc32(text.cast("binary")).alias("crc")), "lengths")
    n_tokens = F.col("n_tokens")
    # One row for each distinct length (or cell): the square root of twice the tokens at most.
    cells = (rows.groupBy((n_tokens if cell is None else cell(n_tokens)).alias("cell")).agg(F.count("*").alias("n"), F.max("n_tokens").alias("top"))
             .orderBy("cell").collect())
    if len(cells) > MAX_LENGTHS:
        warnings.warn(f"{len(cells)} distinct lengths are read by the driver; cell=length_cell bounds them", stacklevel=2)
    bounds = choose_boundaries([r["top"] for r in cells], [r["n"] for r in cells], buckets) if cells else [0]
    bucket = sum((F.when(F.col("n_tokens") > b, 1).otherwise(0) for b in bounds[:-1]), F.lit(0))
    keyed = rows.withColumns({"bucket": bucket.cast("int"), "mixed": F.xxhash64("doc_id", "crc")})
    placed = prefix_sums(keyed, ["bucket", "mixed", "doc_id", "crc", "n_tokens"], "n_tokens")
    first = F.broadcast(placed.groupBy("bucket").agg(F.min("row").alias("first_row")))  # one row for each bucket
    padded = F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket") + 1)
    return (placed.join(first, "bucket")
            .withColumns({"bucket_tokens": padded, "i": F.col("row") - F.col("first_row")})
            .withColumn("room", F.expr(f"greatest(1L, {token_budget} div greatest(1L, bucket_tokens))"))
            .select("doc_id", "n_tokens", "bucket", "bucket_tokens", F.expr("i div room").alias("batch"), F.expr("i % room").alias("slot")))

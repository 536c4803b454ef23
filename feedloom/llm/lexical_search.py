"""Ranked lexical search the other way round: items wait, documents stream.

The items' terms form an inverted index (term to items) that is broadcast.
Every task streams its documents through it: a document's term counts meet the
postings of the terms that items hold, which gives its score for every item it
shares a term with, and each item keeps a heap of its ``k`` best documents so
far. Tasks hand on their heaps only, at most ``k`` rows an item, which are merged
in two steps (within a share of the documents, then all).

A first pass over the documents counts what the weights need: documents with a
term, all terms, and for each item term the documents that hold it. Tasks hand
on one row each and at most one row for each item term they saw.

Items go in blocks of at most ``BLOCK_TERMS`` distinct (item, term) pairs, two
passes a block, so neither the broadcast nor the heaps grow with the number of
items; one item's terms are never split, and its pairs are bounded by its text.
A hot term costs its postings for each document, never pairs of documents.

Weights, in 64-bit integers (``div`` rounds down): w = floor(1000 ln((2N + 2) /
(2 df + 1))), m = 100 - b + ((b n N) div L) with b = 90, and a term gives
w ((10^9 tf) div (1000 tf + 8 m)). Sums stay below 2^53, so they are exact in
the double-precision sums used (an item may hold up to some 100,000 terms;
checked).

Defined cases: null or wordless texts have no terms and are not found; an item
without terms has no result; rows of ``items`` with one id are one item with the
terms of all its texts (a null id is an id); repeated documents are separate
results with ranks of their own, equal scores by ascending id, null ids last;
empty tables give an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegralType, StringType

from feedloom.session import stage_table

from . import words as W
from .tables import prepare

CHUNK_BYTES = 1 << 20
#: Distinct (item, term) pairs of a block, about 24 bytes each in a broadcast.
BLOCK_TERMS = 2_000_000
#: Cells (items times documents) of the score table that a task fills at once.
SCORE_CELLS = 1 << 21
#: Shares of the documents whose heaps are merged first.
SHARES = 64
B = 90


@dataclass
class Index:
    """Inverted index of a block. ``terms``: sorted term hashes; the items of
    term ``t`` are ``items[bounds[t]:bounds[t + 1]]``, of ``count`` items."""
    terms: np.ndarray
    bounds: np.ndarray
    items: np.ndarray
    count: int


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, terms``: one row for each item that has a term; the distinct
    term hashes of all its texts."""
    id_type = items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            w = W.split(W.texts_of(chunk, "text"), W.ALNUM_WORDS)
            h = W.hash_words(w).view(np.int64)
            sets = [np.unique(h[a:b]) for a, b in zip(w.bounds[:-1], w.bounds[1:])]
            yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array(sets, pa.list_(pa.int64()))], ["item_id", "terms"])

    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).mapInArrow(run, f"item_id {id_type}, terms array<long>")
    return rows.select("item_id", F.explode("terms").alias("term")).distinct().groupBy("item_id").agg(F.collect_list("term").alias("terms"))


def blocks(terms: DataFrame) -> Iterator[tuple[Index, list]]:
    """Inverted indexes over consecutive items, with the items' ids, fetched one
    block at a time: items of at most ``BLOCK_TERMS`` pairs (one item at least)."""
    held, ids, size = [], [], 0

    def build() -> tuple[Index, list]:
        pairs = np.concatenate(held)
        item = np.repeat(np.arange(len(held)), [len(x) for x in held])
        order = np.argsort(pairs, kind="stable")
        pairs, item = pairs[order], item[order]
        new = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        return Index(pairs[new], np.concatenate([new, [len(pairs)]]), item.astype(np.int32), len(held)), ids

    for row in terms.toLocalIterator():
        x = np.array(row["terms"], dtype=np.int64).view(np.uint64)
        if size and size + len(x) > BLOCK_TERMS:
            yield build()
            held, ids, size = [], [], 0
        held.append(x)
        ids.append(row["item_id"])
        size += len(x)
    if held:
        yield build()


def _counts(texts: list[bytes | None], index: Index):
    """(terms of each text, and for each (text, index term): text, term, tf)."""
    w = W.split(texts, W.ALNUM_WORDS)
    at = W.find(index.terms, W.hash_words(w))
    known = at >= 0
    pair, tf = np.unique(w.doc_of()[known] * np.int64(len(index.terms)) + at[known], return_counts=True)
    return w.counts, pair // len(index.terms), pair % len(index.terms), tf


def _statistics_pass(sent):
    """Rows (term, docs, words): one row without a term for the task, then one
    for each index term it saw."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, docs, words = sent.value, 0, 0
        df = np.zeros(len(index.terms), dtype=np.int64)
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            n, _, term, _ = _counts(W.texts_of(chunk, "text"), index)
            docs, words = docs + int((n > 0).sum()), words + int(n.sum())
            df += np.bincount(term, minlength=len(df))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([None, *seen.tolist()], pa.int64()), pa.array([docs, *df[seen].tolist()], pa.int64()),
                                          pa.array([words] + [None] * len(seen), pa.int64())], ["term", "docs", "words"])
    return run


class Heaps:
    """The best ``k`` (score, document id) of every item so far. Rows are items,
    best first; free places have score 0. ``null`` tells null ids."""

    def __init__(self, items: int, k: int, dtype, free):
        self.k = k
        self.score = np.zeros((items, k), dtype=np.int64)
        self.doc = np.full((items, k), free, dtype=dtype)
        self.null = np.zeros((items, k), dtype=bool)

    def floor(self) -> np.ndarray:
        """The least score with which a document can enter each heap."""
        return np.maximum(self.score[:, -1], 1)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        touched = np.unique(item)
        if not len(touched):
            return
        old = self.score[touched] > 0
        item = np.concatenate([item, np.repeat(touched, old.sum(axis=1))])
        score = np.concatenate([score, self.score[touched][old]])
        doc = np.concatenate([doc, self.doc[touched][old]])
        null = np.concatenate([null, self.null[touched][old]])
        by = np.lexsort((np.unique(doc, return_inverse=True)[1], null, -score, item))
        item, score, doc, null = item[by], score[by], doc[by], null[by]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        best = place < self.k
        at = item[best], place[best]
        self.score[touched] = 0
        self.score[at], self.doc[at], self.null[at] = score[best], doc[best], null[best]


def score_table(index: Index, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, rows: int) -> np.ndarray:
    """Scores (items times ``rows`` documents) of the entries (document, term,
    gain), their postings unrolled ``SCORE_CELLS`` at a time."""
    total = np.zeros(index.count * rows)
    upto = np.concatenate([[0], np.cumsum(np.diff(index.bounds)[term])])
    x = 0
    while x < len(term):
        y = max(x + 1, int(np.searchsorted(upto, upto[x] + SCORE_CELLS, side="right")) - 1)
        wide = np.diff(upto[x:y + 1])
        post = np.repeat(index.bounds[term[x:y]] - (upto[x:y] - upto[x]), wide) + np.arange(upto[y] - upto[x])
        cell = index.items[post].astype(np.int64) * rows + np.repeat(doc[x:y], wide)
        total += np.bincount(cell, weights=np.repeat(gain[x:y], wide), minlength=len(total))
        x = y
    return total.reshape(index.count, rows).astype(np.int64)


def _scores_pass(sent, sent_weights, docs: int, words: int, k: int, id_type: pa.DataType):
    """Rows (item, doc_id, score): the heaps of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weights = sent.value, sent_weights.value
        free = "" if pa.types.is_string(id_type) else 0
        heaps = Heaps(index.count, k, object if free == "" else np.int64, free)
        step = max(1, SCORE_CELLS // index.count)
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            column = chunk.column(0)
            null = column.is_null().to_numpy(zero_copy_only=False)
            doc_id = column.fill_null(free).to_numpy(zero_copy_only=False)
            n, doc, term, tf = _counts(W.texts_of(chunk, "text"), index)
            m = 100 - B + (B * n * docs) // max(words, 1)
            gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            for a in range(0, len(n), step):
                lo, hi = np.searchsorted(doc, [a, a + step])
                table = score_table(index, doc[lo:hi] - a, term[lo:hi], gain[lo:hi], min(step, len(n) - a))
                item, d = np.nonzero(table >= heaps.floor()[:, None])
                heaps.add(item, table[item, d], doc_id[d + a], null[d + a])
        item, place = np.nonzero(heaps.score)
        found, none = heaps.doc[item, place], heaps.null[item, place]
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array([None if x else d for d, x in zip(found.tolist(), none.tolist())], id_type),
                                          pa.array(heaps.score[item, place])], ["item", "doc_id", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest
    scores above 0 for each item."""
    spark = docs.sparkSession
    prepare(spark)
    sc = spark.sparkContext
    id_type, item_type = docs.schema[id_col].dataType, items.schema[item_id_col].dataType
    if not isinstance(id_type, (IntegralType, StringType)):
        raise TypeError(f"{id_col}: ids are integers or strings")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    terms = stage_table(item_terms(items, item_id_col, item_text_col), "items")
    out = None
    for index, ids in blocks(terms):
        sent = sc.broadcast(index)
        seen = source.select("text").mapInArrow(_statistics_pass(sent), "term long, docs long, words long")
        # One row for each term of the block, and one for the whole table.
        counted = seen.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).toArrow().to_pylist()
        whole = next((r for r in counted if r["term"] is None), {"docs": 0, "words": 0})
        weights = np.zeros(len(index.terms), dtype=np.int64)
        for r in counted:
            if r["term"] is not None:
                weights[r["term"]] = math.floor(1000 * math.log((2 * whole["docs"] + 2) / (2 * r["docs"] + 1)))
        heaviest = np.zeros(index.count, dtype=np.int64)
        np.add.at(heaviest, index.items, np.repeat(weights, np.diff(index.bounds)) * 1_000_000)
        if heaviest.max(initial=0) >= 1 << 53:
            raise ValueError("an item has too many terms for exact sums")
        named = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], f"item long, item_id {item_type.simpleString()}")
        heaps = source.mapInArrow(_scores_pass(sent, sc.broadcast(weights), whole["docs"], whole["words"], k, to_arrow_type(id_type)),
                                  f"item long, doc_id {id_type.simpleString()}, score long")
        best = [F.desc("score"), F.asc_nulls_last("doc_id")]
        share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES))
        merged = (heaps.withColumn("share", share)
                  .withColumn("rank", F.row_number().over(Window.partitionBy("item", "share").orderBy(*best))).filter(F.col("rank") <= k)
                  .withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).filter(F.col("rank") <= k))
        part = stage_table(merged.join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "found")
        out = part if out is None else out.unionByName(part)
        sent.unpersist()
    return out if out is not None else spark.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id {id_type.simpleString()}, score long")

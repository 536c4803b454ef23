"""Benchmark decontamination with an FM-index for each training shard.

A shard is a chunk of whole documents inside a task. Its words become symbols
of the benchmark's vocabulary; stretches of a document that cannot hold a test
phrase (a word outside the vocabulary breaks a stretch, and a stretch shorter
than the shortest phrase holds none) are left out, which loses nothing. Over
the rest an FM-index is built: suffix order by rank doubling, the
Burrows-Wheeler column in a wavelet matrix, and suffix positions sampled every
``SAMPLE`` symbols from the start of each stretch. All test phrases are searched
backward at once through the wavelet ranks, occurrences are located by walking
to a sampled position, and overlapping or touching spans of a document are
merged into removal spans.

Phrases: every run of ``window`` consecutive words of an item; an item with
fewer words, but not none, is one phrase.

The benchmark is sent to the tasks in blocks of at most ``BLOCK_WORDS`` words,
one pass over the documents for each block, so its size is bounded however
large the benchmark is.

Defined cases: null or wordless texts have no words, no spans, and are clean;
null or wordless items match nothing; equal items or items with equal phrases
are all reported; items with a null id hit but are not listed; repeated document
rows are judged one by one; an empty benchmark leaves every document clean;
other columns are ignored (or passed on as they are by ``drop_contaminated``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.session import stage_table

from . import words as W
from .tables import prepare

SAMPLE = 8
SHARD_BYTES = 8 << 20
BLOCK_WORDS = 2_000_000


# -- FM-index ---------------------------------------------------------------

def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array by rank doubling; 0 is a separator and never equal to
    another separator, so comparisons end with the stretch."""
    n = len(text)
    rank = text.astype(np.int64) + n
    stops = np.flatnonzero(text == 0)
    rank[stops] = np.arange(len(stops))
    step = 1
    while True:
        nxt = np.zeros(n, dtype=np.int64)
        nxt[:n - step] = rank[step:] + 1
        order = np.lexsort((nxt, rank))
        a, b = rank[order], nxt[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        if new.max() == n - 1:
            return order
        rank, step = new, step * 2


class WaveletMatrix:
    """Rank and access over a symbol sequence, one bit level after another."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = []
        for bit in range(max(1, int(sigma).bit_length()) - 1, -1, -1):
            one = (seq >> bit) & 1
            zeros = np.zeros(len(seq) + 1, dtype=np.int64)
            np.cumsum(1 - one, out=zeros[1:])
            self.levels.append((bit, one.astype(bool), zeros, zeros[-1]))
            seq = np.concatenate([seq[one == 0], seq[one == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its end position."""
        lo, hi = np.zeros_like(ends), ends
        for bit, _, zeros, n_zero in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            lo = np.where(one, n_zero + lo - zeros[lo], zeros[lo])
            hi = np.where(one, n_zero + hi - zeros[hi], zeros[hi])
        return hi - lo

    def access(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros_like(rows)
        for bit, ones, zeros, n_zero in self.levels:
            one = ones[rows]
            out |= one.astype(np.int64) << bit
            rows = np.where(one, n_zero + rows - zeros[rows], zeros[rows])
        return out


class FMIndex:
    def __init__(self, text: np.ndarray, offset_in_run: np.ndarray, sigma: int):
        """``text``: symbols from 1, each stretch followed by 0.
        ``offset_in_run``: distance of each position from its stretch's start."""
        order = suffix_order(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))])
        self.bwt = WaveletMatrix(text[order - 1], sigma)
        kept = (offset_in_run % SAMPLE == 0)[order]
        self.sampled = kept
        self.sample_at = np.cumsum(kept) - 1
        self.samples = order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns (one a row, right-aligned), all at once."""
        n = len(patterns)
        lo, hi = np.zeros(n, dtype=np.int64), np.full(n, self.first[-1], dtype=np.int64)
        live = np.arange(n)
        for back in range(1, patterns.shape[1] + 1):
            live = live[(lengths[live] >= back) & (lo[live] < hi[live])]
            symbol = patterns[live, -back]
            lo[live] = self.first[symbol] + self.bwt.rank(symbol, lo[live])
            hi[live] = self.first[symbol] + self.bwt.rank(symbol, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step back until a sampled one."""
        out, steps = np.zeros_like(rows), np.zeros_like(rows)
        left, at = np.arange(len(rows)), rows.copy()
        while len(left):
            done = self.sampled[at]
            out[left[done]] = self.samples[self.sample_at[at[done]]] + steps[left[done]]
            left, at = left[~done], at[~done]
            steps[left] += 1
            symbol = self.bwt.access(at)
            at = self.first[symbol] + self.bwt.rank(symbol, at)
        return out


# -- test phrases -----------------------------------------------------------

@dataclass
class Phrases:
    """One block of the benchmark, compiled."""
    vocabulary: np.ndarray     # sorted word hashes; symbol = index + 1
    patterns: np.ndarray       # distinct phrases, right-aligned, 0-padded
    lengths: np.ndarray
    owner_bounds: np.ndarray   # owners[owner_bounds[p]:owner_bounds[p+1]]: item numbers of phrase p
    owners: np.ndarray
    item_ids: list             # by item number; may hold None


def compile_phrases(item_ids: list, texts: list[bytes | None], window: int) -> Phrases:
    w = W.split(texts, W.ALNUM_WORDS)
    hashes = W.hash_words(w)
    vocabulary = np.unique(hashes)
    symbols = np.searchsorted(vocabulary, hashes) + 1
    seen: dict[tuple, set[int]] = {}
    for d in range(len(texts)):
        s = symbols[w.bounds[d]:w.bounds[d + 1]].tolist()
        for i in range(max(1, len(s) - window + 1) if s else 0):
            seen.setdefault(tuple(s[i:i + window]), set()).add(d)
    patterns = np.zeros((len(seen), window), dtype=np.int64)
    lengths = np.zeros(len(seen), dtype=np.int64)
    for p, phrase in enumerate(seen):
        patterns[p, window - len(phrase):] = phrase
        lengths[p] = len(phrase)
    owners = [sorted(x) for x in seen.values()]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in owners])]).astype(np.int64)
    return Phrases(vocabulary, patterns, lengths, bounds,
                   np.array([i for x in owners for i in x], dtype=np.int64), list(item_ids))


def phrase_blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[Phrases]:
    """The benchmark, compiled block by block (one block in the driver at a time)."""
    prepare(benchmark.sparkSession)
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col(id_col), F.col(text_col).cast("binary")).toLocalIterator():
        text = bytes(row[1]) if row[1] is not None else b""
        ids.append(row[0])
        texts.append(text)
        size += len(text) // 2 + 1  # a word has two bytes at least, with its space
        if size >= BLOCK_WORDS:
            yield compile_phrases(ids, texts, window)
            ids, texts, size = [], [], 0
    yield compile_phrases(ids, texts, window)


# -- searching a shard ------------------------------------------------------

def find_phrases(w: W.Words, hashes: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of all phrases in a shard: first word (index into the
    shard's words) and phrase number."""
    none = np.empty(0, dtype=np.int64)
    if not len(phrases.patterns) or not len(hashes):
        return none, none
    symbol = W.find(phrases.vocabulary, hashes) + 1
    known = symbol > 0
    begins = known.copy()                       # stretches: runs of known words inside a text
    begins[1:] &= ~known[:-1]
    heads = w.bounds[:-1][np.diff(w.bounds) > 0]
    begins[heads] = known[heads]
    run = np.cumsum(begins) - 1
    length = np.bincount(run[known], minlength=int(begins.sum()))
    kept = known & (length[np.maximum(run, 0)] >= phrases.lengths.min()) if len(length) else known
    at = np.flatnonzero(kept)
    if not len(at):
        return none, none
    new = np.concatenate([[True], run[at][1:] != run[at][:-1]])
    place = np.arange(len(at)) + np.cumsum(new) - 1           # leaves a slot for the 0 after each stretch
    text = np.zeros(place[-1] + 2, dtype=np.int64)
    text[place] = symbol[at]
    word_at = np.full(len(text), -1, dtype=np.int64)
    word_at[place] = at
    head = np.flatnonzero(new)
    offset = np.ones(len(text), dtype=np.int64)               # separators are never sampled or reached
    offset[place] = np.arange(len(at)) - head[np.cumsum(new) - 1]
    index = FMIndex(text, offset, len(phrases.vocabulary))
    lo, hi = index.search(phrases.patterns, phrases.lengths)
    found = np.maximum(hi - lo, 0)
    phrase = np.repeat(np.arange(len(lo)), found)
    rows = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found) + np.repeat(lo, found)
    return word_at[index.locate(rows)], phrase


def cover(n_words: int, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which words lie in any of the spans."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def shard_hits(texts: list[bytes | None], phrases: Phrases):
    """Words of the shard, hit mask of the words, distinct (text, item) pairs."""
    w = W.split(texts, W.ALNUM_WORDS)
    start, phrase = find_phrases(w, W.hash_words(w), phrases)
    hit = cover(len(w.starts), start, phrases.lengths[phrase] if len(phrase) else phrase)
    if not len(start):
        return w, hit, np.empty((0, 2), dtype=np.int64)
    text = np.searchsorted(w.bounds, start, side="right") - 1
    pair = np.unique(np.stack([text, phrase], axis=1), axis=0)
    many = np.diff(phrases.owner_bounds)[pair[:, 1]]
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(phrases.owner_bounds[pair[:, 1]], many)
    return w, hit, np.unique(np.stack([np.repeat(pair[:, 0], many), phrases.owners[at]], axis=1), axis=0)


def merged_spans(w: W.Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, end word) of the removal spans, words counted inside the text."""
    if not hit.any():
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    text = w.doc_of()
    at = np.flatnonzero(hit)
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])])
    first = at[new]
    last = at[np.concatenate([new[1:], [True]])]
    return text[first], first - w.bounds[text[first]], last + 1 - w.bounds[text[first]]


# -- operators --------------------------------------------------------------

SPANS = "array<struct<first: long, end: long>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                       text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document: ``doc_id, n_words, spans`` (merged removal
    spans in words, end exclusive) and ``items`` (sorted ids of items with an
    occurring phrase)."""
    item_type = benchmark.schema[item_id_col].dataType.simpleString()
    sc = docs.sparkSession.sparkContext

    from pyspark.sql.pandas.types import to_arrow_type
    arrow_item = to_arrow_type(benchmark.schema[item_id_col].dataType)
    id_type = docs.schema[id_col].dataType.simpleString()

    def one_pass(source: DataFrame, block: Phrases) -> DataFrame:
        sent = sc.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            phrases = sent.value
            for chunk in W.chunks(batches, "text", SHARD_BYTES):
                w, hit, pairs = shard_hits(W.texts_of(chunk, "text"), phrases)
                text, first, end = merged_spans(w, hit)
                n = chunk.num_rows
                at = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
                spans = pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["first", "end"]))
                items = [[] for _ in range(n)]
                for d, i in pairs.tolist():
                    if phrases.item_ids[i] is not None:
                        items[d].append(phrases.item_ids[i])
                yield pa.RecordBatch.from_arrays([*chunk.columns[:2], pa.array(w.counts), spans, pa.array([sorted(set(x)) for x in items], type=pa.list_(arrow_item))],
                                                 ["row", "doc_id", "n_words", "spans", "items"])

        return source.mapInArrow(run, f"row long, doc_id {id_type}, n_words long, spans {SPANS}, items array<{item_type}>")

    source = docs.select(F.lit(0).cast("long").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = phrase_blocks(benchmark, window, item_id_col, item_text_col)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        return one_pass(source, block).drop("row")
    # Several blocks: the rows get written numbers, and the findings of the
    # passes are put together by them.
    source = stage_table(source.withColumn("row", F.monotonically_increasing_id()), "decon")
    whole = stage_table(one_pass(source, block), "decon")
    while following is not None:
        whole = whole.unionByName(stage_table(one_pass(source, following), "decon"))
        following = next(blocks, None)
    union = whole.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                     F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
                                     F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return union.withColumn("spans", F.expr(
        "aggregate(spans, cast(array() as " + SPANS + "), (done, s) -> if(size(done) > 0 and s.first <= element_at(done, -1).end,"
        " concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first, 'end', greatest(element_at(done, -1).end, s.end)))),"
        " concat(done, array(s))))")).drop("row")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents without a removal span, all their columns as they were."""
    out = docs
    for k, block in enumerate(phrase_blocks(benchmark, window, item_id_col, item_text_col)):
        out = stage_table(out, "decon") if k else out
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for chunk in W.chunks(batches, text_col, SHARD_BYTES):
                w, hit, _ = shard_hits(W.texts_of(chunk, text_col), sent.value)
                yield chunk.filter(pa.array(W.segments_sum(hit, w.bounds) == 0))

        out = out.mapInArrow(run, docs.schema)
    return out


def cut_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                      item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """All documents, with the removal spans cut out of ``text_col`` (from the
    first byte of a span's first word to the last byte of its last). All blocks of
    a benchmark are searched in the text as it came; its spans are cut at once."""
    out, blocks = docs, phrase_blocks(benchmark, window, item_id_col, item_text_col)
    block, k = next(blocks), 0
    while block is not None:
        following = next(blocks, None)
        out = _cut_pass(stage_table(out, "decon") if k else out, docs, block, text_col, k > 0, following is None)
        block, k = following, k + 1
    return out


_FOUND = "__spans_before"


def _cut_pass(rows: DataFrame, docs: DataFrame, block: Phrases, text_col: str, has_spans: bool, last: bool) -> DataFrame:
    """Search one block. The spans found (in words of the whole text) go on in a
    column beside the row; the last pass cuts them all."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    place, columns = docs.columns.index(text_col), len(docs.columns)
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, text_col, SHARD_BYTES):
            texts = W.texts_of(chunk, text_col)
            w, hit, _ = shard_hits(texts, sent.value)
            if has_spans:
                for d, spans in enumerate(chunk.column(columns).to_pylist()):
                    for s in spans:
                        hit[w.bounds[d] + s["first"]:w.bounds[d] + s["end"]] = True
            found: list[list] = [[] for _ in texts]
            for d, a, b in zip(*(x.tolist() for x in merged_spans(w, hit))):
                found[d].append({"first": a, "end": b})
            fields, arrays = list(chunk.schema)[:columns], chunk.columns[:columns]
            if not last:
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, span)], [*(f.name for f in fields), _FOUND])
                continue
            for d, spans in enumerate(found):
                kept, at = [], 0
                for s in spans:
                    a, b = w.bounds[d] + s["first"], w.bounds[d] + s["end"] - 1
                    kept.append(texts[d][at:int(w.starts[a] - w.offsets[d])])
                    at = int(w.starts[b] + w.lens[b] - w.offsets[d])
                if spans:
                    texts[d] = b"".join([*kept, texts[d][at:]])
            arrays[place] = pa.array(texts, type=pa.binary()).cast(fields[place].type)
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in fields])

    schema = docs.schema if last else T.StructType([*docs.schema.fields, T.StructField(_FOUND, T._parse_datatype_string(SPANS))])
    return rows.mapInArrow(run, schema)

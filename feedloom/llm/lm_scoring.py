"""Language-model scores from a log-frequency Bloom filter.

Counts of words and word pairs of the training documents are quantised on a
logarithmic scale; a pair or word with code q is put into a Bloom filter q times,
as (item, 1) .. (item, q). A count is read back by asking for (item, 1),
(item, 2), ... until one is missing, or the code of the total is reached.
Probabilities are smoothed: ``P(w | v) = (c(v w) + PRIOR * P(w)) / (c(v) + PRIOR)`` with
``P(w) = (c(w) + 1) / (N + V + 1)``. A code stands for a range of counts; above the
line its least count is taken, below it its greatest, so the probabilities of
all words after ``v`` sum to 1 at most, whatever the counts are. The one thing that
can add to them is an error of the filter (an item found that was not put in, or
at too high a code); a pair found more often than one of its words is such an
error and is taken down to that word's count.

Counting covers all training documents. Every task counts its pairs in chunks
and hands them on packed (sorted 32-bit remainders and counts, one row for each
slice of the hash range); a slice's counts meet in one task, which sets the bits
of its own part of the filter. A slice has ``BITS_PER_PAIR`` bits for each of its
entries, so the error rate is the same at every size. The number of slices grows
with the training documents: one holds about ``SLICE_PAIRS`` tokens' items.

The filter is a table of slices, of which a task holds one at a time. Documents
are scored in chunks: a chunk's distinct items go to their slices, are probed
there, and their codes come back to the chunk.

The unigram base score needs exact counts of every word. They come from an exact
count table: words found at least ``t`` times, ``FREQUENT`` of them at most, are
sent to the workers; the rarer words of a document are joined with the table.

Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased; words
are told apart by a 64-bit hash. The end of a text is a token, which is also the
word before its first one.

Defined cases: a null or wordless text is its end token alone; repeated rows are
learned and scored one by one; without any training document all counts are 0;
documents with a null id are learned from and scored; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from feedloom.session import stage_table

from . import words as W
from .tables import prepare

CHUNK_BYTES = 2 << 20
#: Text scored at a time; its distinct items are one row for each slice.
SCORE_BYTES = 4 << 20
#: Words a task holds before it hands on its counts.
FLUSH = 1 << 20
FREQUENT = 1 << 19
PRIOR = 8.0
BASE = 2.0            # code q stands for counts from BASE^(q-1) to BASE^q - 1
PROBES = 3
#: Bits for each entry (item, q) of the filter.
BITS_PER_PAIR = 10
#: Training tokens a slice, about.
SLICE_PAIRS = 1 << 22
LEAST_SLICE_BITS = 6
END = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end token after each, and their bounds."""
    w = W.split(texts, W.SPACE_WORDS)
    out = np.insert(W.hash_words(w), w.bounds[1:], END)
    return out, w.bounds + np.arange(len(w.bounds))


def pair_hashes(t: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One hash for each token and the token before it (END before the first).
    The end token before a text's first word is the one of the text before."""
    before = np.concatenate([[END], t[:-1]]) if len(t) else t
    return W.mix(before * _PAIR + t)


def code_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE)).astype(np.int64) + 1


def least_of(code: np.ndarray) -> np.ndarray:
    """The least count of a code; 0 for code 0."""
    return np.where(code > 0, BASE ** (code - 1.0), 0.0)


def most_of(code: np.ndarray) -> np.ndarray:
    """The greatest count of a code; 0 for code 0."""
    return np.where(code > 0, np.maximum(BASE ** (code - 1.0), BASE ** code.astype(float) - 1), 0.0)


# -- filter -------------------------------------------------------------------

@dataclass
class FilterShape:
    slice_bits: int     # the hash's top bits choose a slice
    size: int           # bits of a slice

    def slot(self, h: np.ndarray, q: int, k: int) -> np.ndarray:
        """Bit number inside the slice of probe k for (item, q)."""
        x = W.mix((h & np.uint64((1 << (64 - self.slice_bits)) - 1)) * np.uint64(2 * q + 1) + np.uint64(q))
        a, b = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
        return ((a + np.uint64(k) * b) % np.uint64(self.size)).astype(np.int64)


def set_bits(remainder: np.ndarray, counts: np.ndarray, slice_bits: int, each: int) -> bytes:
    """The bits of one slice, ``each`` for an entry. ``remainder``: distinct
    32-bit values."""
    h = remainder.astype(np.uint64) << np.uint64(32 - slice_bits)
    code, q = code_of(counts), 1
    shape = FilterShape(slice_bits, max(64, -(-each * int(code.sum()) // 8) * 8))
    bits = np.zeros(shape.size, dtype=bool)
    while len(h):
        for k in range(PROBES):
            bits[shape.slot(h, q, k)] = True
        q += 1
        h, code = h[code >= q], code[code >= q]
    return np.packbits(bits, bitorder="little").tobytes()


def probe(remainder: np.ndarray, data: bytes, slice_bits: int, most: int) -> np.ndarray:
    """The codes of 32-bit values of one slice: membership probes until one
    fails, ``most`` at most."""
    bits = np.frombuffer(data, dtype=np.uint8)
    shape = FilterShape(slice_bits, 8 * len(bits))
    h = remainder.astype(np.uint64) << np.uint64(32 - slice_bits)
    code, left = np.zeros(len(h), dtype=np.uint8), np.arange(len(h))
    for q in range(1, most + 1):
        for k in range(PROBES):
            at = shape.slot(h, q, k)
            ok = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            h, left = h[ok], left[ok]
        if not len(left):
            break
        code[left] = q
    return code


@dataclass
class LogFrequencyFilter:
    slice_bits: int     # the hash's top bits choose a slice
    most: int           # no code is above the code of the total
    slices: DataFrame   # (slice, bits)

    def codes(self, h: np.ndarray) -> np.ndarray:
        """The code of each item, read slice by slice on the driver (for a few
        items; documents are scored where the slices are)."""
        values = h >> np.uint64(32 - self.slice_bits)
        number = (values >> np.uint64(32)).astype(np.int64)
        code = np.zeros(len(h), dtype=np.int64)
        for row in self.slices.toLocalIterator():
            at = np.flatnonzero(number == row["slice"])
            code[at] = probe(values[at] & np.uint64(0xFFFFFFFF), row["bits"], self.slice_bits, self.most)
        return code


def _pack(values: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 32-bit values and their counts (or none), as compressed byte planes
    of the differences."""
    step = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    planes = step.view(np.uint8).reshape(-1, 4).T
    return len(values).to_bytes(4, "little") + planes[:2].tobytes() + zlib.compress(planes[2:].tobytes() + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    rest = np.frombuffer(zlib.decompress(data[4 + 2 * n:]), dtype=np.uint8)
    planes = np.concatenate([np.frombuffer(data, np.uint8, 2 * n, 4), rest[:2 * n]]).reshape(4, n)
    step = np.ascontiguousarray(planes.T).view("<u4").ravel()
    return np.cumsum(step, dtype=np.uint32), np.ascontiguousarray(rest[2 * n:].reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


# -- counting -------------------------------------------------------------------

def _words_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, times): the word counts of chunks of training documents."""
    held, size = [], 0

    def hand_on():
        code, unique = pd.factorize(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(np.bincount(code, minlength=len(unique)))], ["word", "times"])

    for chunk in W.chunks(batches, "text", CHUNK_BYTES):
        held.append(tokens(W.texts_of(chunk, "text"))[0])
        size += len(held[-1])
        if size >= FLUSH:
            yield hand_on()
            held, size = [], 0
    if held:
        yield hand_on()


def _sliced(values: np.ndarray, counts: np.ndarray | None, slice_bits: int) -> tuple[list[int], list[bytes]]:
    """Sorted distinct items, as the filter sees them, packed for each slice."""
    cuts = np.searchsorted(values, np.arange((1 << slice_bits) + 1, dtype=np.uint64) << np.uint64(32))
    part = np.flatnonzero(cuts[:-1] < cuts[1:]).tolist()
    low, none = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.empty(0, dtype=np.int64)
    return part, [_pack(low[cuts[k]:cuts[k + 1]], none if counts is None else counts[cuts[k]:cuts[k + 1]]) for k in part]


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each value of the first column, by which they are ordered."""
    held = []
    for batch in batches:
        key = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and a < b and held[0].column(0)[0].as_py() != key[a]:
                yield pa.Table.from_batches(held)
                held = []
            if a < b:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _pairs_pass(slice_bits: int):
    """(slice, packed): the item counts of chunks, for each slice of the range.
    Items are words and word pairs."""
    def pack(held):
        values = np.sort(np.concatenate(held) >> np.uint64(32 - slice_bits))
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        part, rows = _sliced(values[first], np.diff(np.concatenate([first, [len(values)]])), slice_bits)
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(rows, pa.binary())], ["slice", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            t, bounds = tokens(W.texts_of(chunk, "text"))
            held += [t, pair_hashes(t, bounds)]
            size += len(t)
            if size >= FLUSH:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)
    return run


def _fill_pass(slice_bits: int, each: int):
    """The filter's bits of every slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches):
            parts = [_unpack(x) for x in group["packed"].to_pylist()]
            values, counts = _summed(np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts]))
            yield pa.RecordBatch.from_arrays([pa.array([group["slice"][0].as_py()], pa.int32()), pa.array([set_bits(values, counts, slice_bits, each)], pa.binary())],
                                             ["slice", "bits"])
    return run


def _slice_parts(spark, slice_bits: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), (1 << slice_bits) // 8)


@dataclass
class Model:
    total: int                 # N
    distinct: int              # V
    frequent: np.ndarray       # sorted hashes of frequent words
    frequent_counts: np.ndarray
    counts: DataFrame          # (word, times), all words
    filter: LogFrequencyFilter


def learn(training: DataFrame, text_col: str = "text") -> Model:
    """Word counts, and the filter of words and word pairs, of all training
    documents."""
    spark = training.sparkSession
    prepare(spark)
    text = training.select(F.col(text_col).alias("text"))
    counts = stage_table(text.mapInArrow(_words_pass, "word long, times long").groupBy("word").agg(F.sum("times").alias("times")), "words")
    levels = (counts.groupBy(F.floor(F.log2("times") * 4).cast("int").alias("level")).agg(F.count("*").alias("n"), F.sum("times").alias("times"))
              .orderBy(F.desc("level")).collect())  # 256 rows at most
    distinct, total = sum(r["n"] for r in levels), sum(r["times"] for r in levels)
    taken, low = 0, 256
    for r in levels:
        taken += r["n"]
        if taken > FREQUENT:
            break
        low = r["level"]
    often = counts.filter(F.floor(F.log2("times") * 4) >= low).toArrow()  # FREQUENT rows at most
    word, times = often["word"].to_numpy().view(np.uint64), often["times"].to_numpy()
    order = np.argsort(word)

    slice_bits = max(LEAST_SLICE_BITS, int(total // SLICE_PAIRS).bit_length())
    made = (text.mapInArrow(_pairs_pass(slice_bits), "slice int, packed binary")
            .repartition(_slice_parts(spark, slice_bits), "slice").sortWithinPartitions("slice").mapInArrow(_fill_pass(slice_bits, BITS_PER_PAIR), "slice int, bits binary"))
    model_filter = LogFrequencyFilter(slice_bits, int(code_of(np.array([total]))[0]), stage_table(made, "filter"))
    return Model(total, distinct, word[order], times[order], counts, model_filter)


# -- scoring --------------------------------------------------------------------

def smoothed(pair: np.ndarray, before: np.ndarray, word: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """log10 P(word | word before), from the codes of the pair and its words."""
    prior = PRIOR * (least_of(word) + 1) / (total + distinct + 1)
    return np.log10((least_of(np.minimum(pair, np.minimum(before, word))) + prior) / (most_of(before) + PRIOR))


def items_of(t: np.ndarray, bounds: np.ndarray, slice_bits: int) -> np.ndarray:
    """The distinct items of a chunk, sorted, as the filter sees them."""
    values = np.sort(np.concatenate([t, pair_hashes(t, bounds), [END]]) >> np.uint64(32 - slice_bits))
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def score_tokens(t: np.ndarray, bounds: np.ndarray, codes: np.ndarray, slice_bits: int, total: int, distinct: int) -> np.ndarray:
    """log10 probability of every token given the one before. ``codes``: of
    ``items_of`` the chunk."""
    items, codes = items_of(t, bounds, slice_bits), codes.astype(np.int64)

    def found(h):
        code, unique = pd.factorize(h)
        return codes[np.searchsorted(items, unique >> np.uint64(32 - slice_bits))][code]

    word = found(t)
    before = np.concatenate([found(np.array([END])), word[:-1]]) if len(t) else word
    return smoothed(found(pair_hashes(t, bounds)), before, word, total, distinct)


def _chunks_pass(slice_bits: int, size: int, id_type: pa.DataType):
    """The ids and text of each chunk (slice -1; a null text is empty), and its
    distinct items of each slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, number = ["chunk", "slice", "doc_id", "sizes", "data"], TaskContext.get().partitionId() << 32
        for chunk in W.chunks(batches, "text", size):
            texts = [x or b"" for x in W.texts_of(chunk, "text")]
            part, rows = _sliced(items_of(*tokens(texts), slice_bits), None, slice_bits)
            n, ends = len(part) + 1, [0, len(texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int64()), pa.array([-1, *part], pa.int32()),
                 pa.concat_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), chunk.column(0).cast(id_type)), pa.nulls(n - 1, pa.list_(id_type))]),
                 pa.array([[len(x) for x in texts], *[None] * (n - 1)], pa.list_(pa.int32())),
                 pa.array([pa.compress(b"".join(texts), "zstd", asbytes=True), *rows], pa.binary())], names)
            number += 1
    return run


def _probe_pass(slice_bits: int, most: int):
    """(chunk, slice, codes) of the items of every chunk. Rows are ordered by
    slice and chunk; the slice's bits come first, as chunk -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, bytes(8)
        for batch in batches:
            out = []
            for k, chunk, data in zip(*(c.to_pylist() for c in batch.columns)):
                if k != now:
                    now, bits = k, bytes(8)             # a slice without bits holds nothing
                if chunk < 0:
                    bits = data
                else:
                    out.append((chunk, k, zlib.compress(probe(_unpack(data)[0], bits, slice_bits, most).tobytes(), 1)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.binary()))],
                                             ["chunk", "slice", "data"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every
    document row."""
    spark = docs.sparkSession
    prepare(spark)
    slice_bits, parts = model.filter.slice_bits, _slice_parts(spark, model.filter.slice_bits)
    sent = spark.sparkContext.broadcast((model.frequent, model.frequent_counts, model.total, model.distinct))
    id_type = docs.schema[id_col].dataType.simpleString()

    # Written once, so a chunk's rows and its items stay the same for all reads.
    chunks = stage_table(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _chunks_pass(slice_bits, SCORE_BYTES, to_arrow_type(docs.schema[id_col].dataType)),
        f"chunk long, slice int, doc_id array<{id_type}>, sizes array<int>, data binary"), "chunks")
    codes = (chunks.filter("slice >= 0").select("slice", "chunk", "data")
             .union(model.filter.slices.select("slice", F.lit(-1).cast("long").alias("chunk"), F.col("bits").alias("data")))
             .repartition(parts, "slice").sortWithinPartitions("slice", "chunk")
             .mapInArrow(_probe_pass(slice_bits, model.filter.most), "chunk long, slice int, data binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, times, total, distinct = sent.value
        gain = np.log10(times + 1.0)
        for group in _grouped(batches):
            raw, *codes = group["data"].to_pylist()
            ends = np.concatenate([[0], np.cumsum(group["sizes"][0].as_py())]).tolist()
            raw = pa.decompress(raw, ends[-1], "zstd", asbytes=True)
            texts = [raw[a:b] for a, b in zip(ends[:-1], ends[1:])]
            found = np.frombuffer(b"".join(zlib.decompress(x) for x in codes), dtype=np.uint8)
            t, bounds = tokens(texts)
            code, unique = pd.factorize(t)
            at = W.find(frequent, unique)
            known = (at >= 0)[code]
            part = np.where(at >= 0, gain[at] if len(gain) else 0.0, 0.0)[code]
            n = np.diff(bounds)
            text = np.repeat(np.arange(len(n)), n)
            rare = np.flatnonzero(~known)
            rest = pa.ListArray.from_arrays(np.searchsorted(text[rare], np.arange(len(n) + 1)).astype(np.int32), pa.array(t[rare].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [group["doc_id"][0].values, pa.array(n), pa.array(W.segments_sum(known.astype(np.int64), bounds)),
                 pa.array(W.segments_sum(part, bounds)), pa.array(W.segments_sum(score_tokens(t, bounds, found, slice_bits, total, distinct), bounds)), rest],
                ["doc_id", "n_tokens", "n_known", "gain", "score", "rare"])

    first = (chunks.filter("slice < 0")
             .union(codes.select("chunk", "slice", F.lit(None).cast(f"array<{id_type}>"), F.lit(None).cast("array<int>"), "data"))
             .repartition("chunk").sortWithinPartitions("chunk", "slice")
             .mapInArrow(run, f"doc_id {id_type}, n_tokens long, n_known long, gain double, score double, rare array<long>"))
    # The row number is written with the rows, so it holds for both reads.
    rows = stage_table(first.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = (rows.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
            .join(model.counts, "word")
            .groupBy("row").agg(F.sum("n").alias("known"), F.sum(F.col("n") * F.log10(F.col("times") + 1)).alias("more")))
    floor = F.log10(F.lit(float(model.total + model.distinct + 1)))
    return rows.join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("gain") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"), "score")

"""Language identification of mixed-language text by a Viterbi pass over words.

Learning: labelled documents give, for each language, counts of hashed letter
trigrams (word boundaries count as letters) and the scripts its words use. At
most about ``TRAIN_DOCS`` documents a language are drawn by a hash of the id (a
documented bound on the labelled sample; whole texts are used). The counts are
summed by Spark; the model has at most ``BUCKETS`` numbers a language.

Prediction: a word's script leaves only the languages that use it; their scores
are trigram log-likelihoods. The best path through a text's words pays
``SWITCH`` for every change of language, and its runs are the labelled spans.
A text's language is that of most letters on its path.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
words in a script that no learned language uses count for none, and a text of
such words gets the first learned language with score 0; ties go to the
language first in order; without any labelled text all is ``und``; rows are
judged one by one, so repeated rows get equal results; other columns are ignored
(or passed on by ``keep_identified``); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .tables import prepare

CHUNK_BYTES = 4 << 20
BUCKETS = 1 << 16
TRAIN_DOCS = 4000
#: Cost of a language change, in units of natural log-likelihood.
SWITCH = 12.0
SMOOTH = 0.1
#: A language uses a script if it writes at least this share of its words in it.
SCRIPT_SHARE = 0.002

# Unicode blocks of scripts.
SCRIPTS = [
    ("latin", [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0x24F), (0x1E00, 0x1EFF)]),
    ("greek", [(0x370, 0x3FF), (0x1F00, 0x1FFF)]),
    ("cyrillic", [(0x400, 0x52F)]),
    ("armenian", [(0x530, 0x58F)]),
    ("hebrew", [(0x590, 0x5FF)]),
    ("arabic", [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)]),
    ("devanagari", [(0x900, 0x97F)]),
    ("bengali", [(0x980, 0x9FF)]),
    ("tamil", [(0xB80, 0xBFF)]),
    ("thai", [(0xE00, 0xE7F)]),
    ("georgian", [(0x10A0, 0x10FF)]),
    ("hangul", [(0x1100, 0x11FF), (0xAC00, 0xD7AF)]),
    ("kana", [(0x3040, 0x30FF)]),
    ("han", [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)]),
]


@cache
def _code_tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: is it a letter; its script's number (0: another)."""
    letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    script = np.zeros(0x110000, dtype=np.uint8)
    for k, (_, ranges) in enumerate(SCRIPTS, 1):
        for low, high in ranges:
            script[low:high + 1] = k
    return letter, script


@dataclass
class LetterWords:
    buckets: np.ndarray   # trigram bucket of each code point
    starts: np.ndarray    # code point index of each word's first letter
    lens: np.ndarray
    script: np.ndarray    # of the first letter
    bounds: np.ndarray    # words of text d: bounds[d]:bounds[d+1]


def letter_words(texts: list[bytes | None]) -> LetterWords:
    letter, script = _code_tables()
    raw = [(t or b"").decode("utf-8", "replace").lower() for t in texts]
    sizes = np.fromiter((len(t) + 1 for t in raw), dtype=np.int64, count=len(raw))
    code = np.frombuffer((" " + " ".join(raw) + "  ").encode("utf-32-le", "replace"), dtype=np.uint32)
    inside = letter[code]
    edge = np.diff(inside.view(np.int8))
    starts = np.flatnonzero(edge == 1) + 1
    lens = np.flatnonzero(edge == -1) + 1 - starts
    code = np.where(inside, code, 32)
    mixed = np.zeros(len(code), dtype=np.uint32)
    mixed[1:-1] = code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77) + code[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    buckets = (mixed >> np.uint32(16)).astype(np.uint16)
    offsets = np.concatenate([[1], 1 + np.cumsum(sizes)])
    return LetterWords(buckets, starts, lens, script[code[starts]] if len(starts) else np.empty(0, np.uint8), np.searchsorted(starts, offsets))


def letters_at(w: LetterWords) -> np.ndarray:
    """Indices of all letters, word after word."""
    ends = np.cumsum(w.lens)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - w.lens, w.lens) + np.repeat(w.starts, w.lens)


# -- model --------------------------------------------------------------------

@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray      # [language, bucket]
    uses: np.ndarray      # [script, language]


def _counts_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, feature, times): trigram buckets, then BUCKETS + script of words."""
    sums: dict[str, np.ndarray] = {}
    for chunk in W.chunks(batches, "text", CHUNK_BYTES):
        lang = np.array(chunk.column(0).to_pylist(), dtype=object)
        texts = W.texts_of(chunk, "text")
        for name in sorted(set(lang)):
            w = letter_words([texts[i] for i in np.flatnonzero(lang == name)])
            got = sums.setdefault(name, np.zeros(BUCKETS + 256, dtype=np.int64))
            got[:BUCKETS] += np.bincount(w.buckets[letters_at(w)], minlength=BUCKETS)
            got[BUCKETS:] += np.bincount(w.script, minlength=256)
    for name, got in sums.items():
        at = np.flatnonzero(got)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(got[at])], ["lang", "feature", "times"])


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = TRAIN_DOCS) -> Model:
    """Fit on at most about ``per_language`` documents of each language."""
    prepare(labelled.sparkSession)
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string")).alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not sizes:
        return Model([], np.zeros((0, BUCKETS)), np.zeros((256, 0), dtype=bool))
    # The hash, as a share of its range, must lie under the language's share.
    share = F.element_at(F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, per_language / n)))]), F.col("lang"))
    drawn = rows.filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).select("lang", "text")
    counts = (drawn.mapInArrow(_counts_pass, "lang string, feature int, times long")
              .groupBy("lang", "feature").agg(F.sum("times").alias("times")).toArrow())  # BUCKETS + 256 rows a language at most
    langs = sorted(sizes)
    table = np.zeros((len(langs), BUCKETS + 256))
    table[np.searchsorted(langs, counts["lang"].to_pylist()), counts["feature"].to_numpy()] = counts["times"].to_numpy()
    grams, scripts = table[:, :BUCKETS], table[:, BUCKETS:]
    logp = np.log(grams + SMOOTH) - np.log(grams.sum(axis=1, keepdims=True) + SMOOTH * BUCKETS)
    uses = (scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True))) & (scripts > 0)
    return Model(langs, logp.astype(np.float32), uses.T.copy())


# -- prediction ---------------------------------------------------------------

def best_paths(scores: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """The best label of each word. ``scores``: [word, label]; the texts are
    walked side by side, one word of each at a time."""
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    start, counts = bounds[:-1][order], counts[order]
    steps = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(steps), side="left")  # texts with more than t words
    best = np.empty(len(scores), dtype=np.int16)
    stays = np.empty(scores.shape, dtype=bool)
    value = np.zeros((len(counts), scores.shape[1]), dtype=np.float32)
    for t in range(steps):
        m = active[t]
        at, v = start[:m] + t, value[:m]
        top = v.argmax(axis=1)
        floor = v[np.arange(m), top][:, None] - (switch if t else 0)
        best[at] = top
        stays[at] = v >= floor
        np.maximum(v, floor, out=v)
        v -= floor                                      # keeps values small on long texts
        v += scores[at]
    label = np.empty(len(scores), dtype=np.int16)
    state = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        at, s = start[:active[t]] + t, state[:active[t]]
        label[at] = s
        state[:active[t]] = np.where(stays[at, s], s, best[at])
    return label


def label_words(texts: list[bytes | None], model: Model, switch: float = SWITCH):
    """Words, label of each word, and whether its script is a learned one."""
    w = letter_words(texts)
    at = w.buckets[letters_at(w)]
    first = np.cumsum(w.lens) - w.lens
    scores = np.empty((len(w.starts), len(model.langs)), dtype=np.float32)
    for k in range(len(model.langs)):
        scores[:, k] = np.add.reduceat(model.logp[k][at], first) if len(first) else 0
    uses = model.uses[w.script]
    known = uses.any(axis=1)
    worst = scores.min(axis=1, keepdims=True) - 4 * switch
    scores = np.where(uses, scores, np.where(known[:, None], worst, 0)).astype(np.float32)
    scores -= scores.max(axis=1, keepdims=True) if len(scores) else 0
    return w, best_paths(scores, w.bounds, switch), known


def decide(w: LetterWords, label: np.ndarray, known: np.ndarray, langs: int) -> tuple[np.ndarray, np.ndarray]:
    """Label of each text (-1: no letter) and its share of the letters."""
    text = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))
    letters = np.bincount(text * langs + label, weights=w.lens * known, minlength=(len(w.bounds) - 1) * langs).reshape(-1, langs)
    total = W.segments_sum(w.lens, w.bounds)
    top = letters.argmax(axis=1)
    share = letters[np.arange(len(top)), top] / np.maximum(1, total)
    return np.where(total > 0, top, -1), np.where(total > 0, share, 0.0)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, spans`` for every document row. ``score``:
    share of the letters on the path in that language; ``spans``: runs of words
    (runs of letters) in one language, end exclusive."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = pa.array([*m.langs, "und"], pa.string())
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            n = chunk.num_rows
            if m.langs:
                w, label, known = label_words(W.texts_of(chunk, "text"), m)
                top, share = decide(w, label, known, len(m.langs))
                text = np.repeat(np.arange(n), np.diff(w.bounds))
                new = np.flatnonzero(np.concatenate([[True], (label[1:] != label[:-1]) | (text[1:] != text[:-1])])) if len(label) else np.empty(0, np.int64)
                end = np.concatenate([new[1:], [len(label)]]).astype(np.int64) if len(new) else new
                base = w.bounds[text[new]]
                spans = pa.ListArray.from_arrays(np.searchsorted(text[new], np.arange(n + 1)).astype(np.int32), pa.StructArray.from_arrays(
                    [pa.array(new - base), pa.array(end - base), names.take(pa.array(label[new].astype(np.int32)))], ["first", "end", "lang"]))
            else:
                top, share = np.full(n, -1), np.zeros(n)
                spans = pa.array([[]] * n, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))
            yield pa.RecordBatch.from_arrays([chunk.column(0), names.take(pa.array(np.where(top < 0, len(m.langs), top))), pa.array(share.astype(np.float64)), spans],
                                             ["doc_id", "lang_pred", "score", "spans"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, spans array<struct<first: long, end: long, lang: string>>")


def keep_identified(docs: DataFrame, model: Model, least_share: float = 1 / 3, text_col: str = "text") -> DataFrame:
    """The documents with letters of which at least ``least_share`` lie in one
    language, all their columns as they were."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for chunk in W.chunks(batches, text_col, CHUNK_BYTES):
            if m.langs:
                top, share = decide(*label_words(W.texts_of(chunk, text_col), m), len(m.langs))
                yield chunk.filter(pa.array((top >= 0) & (share >= least_share)))

    return docs.mapInArrow(run, docs.schema)

"""Secret scan with a random forest that removes false positives.

Candidates are the runs of text between white space, quotes, brackets, commas,
``=``, ``:`` and ``|`` that hold a digit and at least ``LEAST`` bytes, or follow a
naming word (``password`` and so on, also as a part of a word between ``_``, ``-``
and ``.``) and an assignment. Each gets features:
length and classes of characters, character transitions (how usual each pair of
neighbouring bytes is in the corpus), dictionary coverage (share of its letters
in runs that the corpus uses often as words), path and address marks, and the
words around it.

Corpus statistics cover all documents: byte pair counts (65,536 numbers) and the
exact counts of all words, of which the often used ones are kept. A word is used
often if it is at least ``DICT_SHARE`` of all words, so there are at most
1 / ``DICT_SHARE`` (500,000) of them at every size.

The forest is trained on labelled findings whose labels do not come from the
features: ``plant_findings`` plants values of known make (``FORMATS``: keys and
random values; addresses, digests, placeholders, words of the document and so
on) between words of drawn documents and computes their features there as for
any candidate; findings of those documents that fully match a published key
format, or the form of an address, number or date, are taken too. A table of
reviewed findings can be given instead. Values are planted into about
``PLANT_DOCS`` documents drawn by hash of id and text; at most about
``TRAIN_FINDINGS`` findings of each class, drawn by hash among those of different
features, are used (the documented bounds of the sample).

Defined cases: null texts have no candidates; equal rows get equal results (and
equal planted values, which count once); if labelled findings of both classes
are not to be had, the strict formats (``strict_label``) alone decide; other columns are ignored (or passed on by ``mask_secrets``); an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import stage_table

from . import words as W
from .tables import prepare

CHUNK_BYTES = 4 << 20
LEAST = 8
#: A word belongs to the dictionary if it is at least this share of all words.
DICT_SHARE = 2e-6
PLANT_DOCS = 20_000
TRAIN_FINDINGS = 20_000
TREES, DEPTH = 24, 6

NAMING = {b"password", b"passwd", b"pwd", b"pass", b"secret", b"token", b"key", b"apikey", b"api_key", b"api-key", b"auth", b"credential",
          b"credentials", b"bearer", b"access_key", b"secret_key", b"access_token", b"private_key", b"client_secret"}
_SEPARATORS = b" \t\n\r\x0b\x0c\"'`<>(){}[],;=:|"
#: Case is kept; separators become spaces.
_TABLE = bytes(32 if b in _SEPARATORS else b for b in range(256))
#: A-Z lower-cased; the marks between the parts of a name become spaces too.
_PARTS = bytes(32 if b in b"_-." else b for b in _TABLE.lower())

_CLASS = np.zeros(256, dtype=np.int8)  # 0 other, 1 lower, 2 upper, 3 digit
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_KNOWN = re.compile(rb"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|sk_live_[0-9A-Za-z]{16,}")
_NOT = re.compile(rb"\+?[0-9().,/_#*%-]+|[0-9]+(?:\.[0-9]+)+[a-z.]*|[^@]+@[^@]+\.[A-Za-z.]+|(?:www\.|https?)[^ ]*|v[0-9.]+|//.*")

FEATURES = ["length", "digits", "upper", "lower", "hexadecimal", "entropy", "longest_run", "class_changes", "mean_transition", "least_transition",
            "dictionary", "slashes", "dots", "at_sign", "other_marks", "named_before", "named_near", "assigned", "quoted", "before_dictionary", "after_dictionary"]


# -- corpus statistics ----------------------------------------------------------

@dataclass
class Statistics:
    pair_logp: np.ndarray      # log2 probability of a byte after a byte
    often: np.ndarray          # uint64, hashes of the often used words, sorted
    rows: int = 0              # documents


_PAIR, _WORD, _WORDS, _ROWS = range(4)


def _counts(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind), pa.int32()), pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(n, pa.int64())],
                                      ["kind", "h", "n"])


def _statistics_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of each chunk; byte pairs, words and rows of the whole task."""
    pairs, words, rows = np.zeros(65536, dtype=np.int64), 0, 0
    for chunk in W.chunks(batches, "text", CHUNK_BYTES):
        texts = W.texts_of(chunk, "text")
        raw = np.frombuffer(b"\n".join(t or b"" for t in texts), dtype=np.uint8)
        pairs += np.bincount((raw[:-1].astype(np.uint16) << 8) | raw[1:], minlength=65536)
        h, n = np.unique(W.hash_words(W.split(texts, W.ALNUM_WORDS)), return_counts=True)
        words, rows = words + int(n.sum()), rows + len(texts)
        yield _counts(_WORD, h, n)
    seen = np.flatnonzero(pairs)
    yield _counts(_PAIR, seen, pairs[seen])
    yield _counts(_WORDS, np.zeros(1), np.array([words]))
    yield _counts(_ROWS, np.zeros(1), np.array([rows]))


def corpus_statistics(docs: DataFrame, text_col: str = "text") -> Statistics:
    """Byte pair and word counts over all documents, in one pass. Both are summed
    by key, after Spark's partial sums in each task; the driver gets the byte
    pairs, two totals and the often used words."""
    prepare(docs.sparkSession)
    text = docs.select(F.col(text_col).alias("text"))
    summed = stage_table(text.mapInArrow(_statistics_pass, "kind int, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n"))
                         .filter((F.col("kind") != _WORD) | (F.col("n") >= 3)), "statistics")
    pairs, totals = np.full(65536, 0.5), {_WORDS: 0, _ROWS: 0}
    for kind, h, n in summed.filter(F.col("kind") != _WORD).collect():  # at most 65,538 rows
        if kind == _PAIR:
            pairs[h] += n
        else:
            totals[kind] = n
    least = max(3, DICT_SHARE * totals[_WORDS])
    often = summed.filter((F.col("kind") == _WORD) & (F.col("n") >= least)).select("h").toArrow()  # at most 1 / DICT_SHARE rows
    pairs = pairs.reshape(256, 256)
    return Statistics(np.log2(pairs / pairs.sum(axis=1, keepdims=True)).astype(np.float32),
                      np.sort(often.column(0).to_numpy().view(np.uint64)), totals[_ROWS])


# -- candidates -----------------------------------------------------------------

def _coverage(word: bytes, stats: Statistics) -> float:
    """Share of the word's letters in runs that are often used as words."""
    runs = re.findall(rb"[A-Za-z\x80-\xff]+", word)
    total = sum(map(len, runs))
    if not total:
        return 0.0
    known = sum(len(r) for r in runs if len(r) > 2 and W.find(stats.often, np.array([W.hash_bytes(r.lower())], dtype=np.uint64))[0] >= 0)
    return known / total


def _trimmed(raw: bytes, start: int, end: int) -> tuple[int, int]:
    """Without marks of a sentence at its ends."""
    while start < end and raw[start] in b".!?*#%&$~^":
        start += 1
    while end > start and raw[end - 1] in b".!?*#%&$~^":
        end -= 1
    return start, end


def is_naming(word: bytes) -> bool:
    word = word.lower()
    return word in NAMING or any(part in NAMING for part in re.split(rb"[_.-]", word))


def find_candidates(texts: list[bytes | None], stats: Statistics) -> list[list[dict]]:
    """The candidates of every text: first and end byte, the words, features."""
    w = W.split(texts, _TABLE)
    digit = np.concatenate([[0], np.cumsum((w.buf >= 48) & (w.buf <= 57))])
    has_digit = digit[w.starts + w.lens] > digit[w.starts]
    plain = W.hash_words(W.Words(np.frombuffer(w.buf.tobytes().lower(), np.uint8), w.starts, w.lens, w.bounds, w.offsets))
    naming = np.sort(np.array([W.hash_bytes(x) for x in NAMING], dtype=np.uint64))
    named = W.find(naming, plain) >= 0
    parts = W.split(texts, _PARTS)
    part = W.find(naming, W.hash_words(parts)) >= 0
    named[np.searchsorted(w.starts, parts.starts[part], side="right") - 1] = True
    after_name = np.concatenate([[False], named[:-1]]) if len(named) else named
    text_of = w.doc_of()
    out: list[list[dict]] = [[] for _ in texts]
    for i in np.flatnonzero((has_digit & (w.lens >= LEAST)) | (after_name & (w.lens >= 6))).tolist():
        d = int(text_of[i])
        raw, base = texts[d], int(w.offsets[d])
        start, end = _trimmed(raw, int(w.starts[i]) - base, int(w.starts[i] + w.lens[i]) - base)
        lo, hi = int(w.bounds[d]), int(w.bounds[d + 1])
        left = raw[max(0, start - 3):start]
        assigned = b"=" in left or b":" in left
        if end - start < 6 or not (has_digit[i] and end - start >= LEAST) and not assigned:
            continue
        word = raw[start:end]
        code = np.frombuffer(word, dtype=np.uint8)
        kind = _CLASS[code]
        moves = stats.pair_logp[code[:-1], code[1:]]
        n, counts = len(code), np.bincount(code)
        share = counts[counts > 0] / n
        change = np.flatnonzero(np.diff(kind))
        before = [raw[int(w.starts[j]) - base:int(w.starts[j] + w.lens[j]) - base] for j in range(max(lo, i - 3), i)]
        after = [raw[int(w.starts[j]) - base:int(w.starts[j] + w.lens[j]) - base] for j in range(i + 1, min(hi, i + 3))]
        near = [is_naming(x) for x in before]
        hexadecimal = sum(c in b"0123456789abcdefABCDEF" for c in word) / n
        out[d].append({
            "first": start, "end": end, "word": word, "assigned": assigned and bool(near) and near[-1],
            "features": [
                float(n), float((kind == 3).mean()), float((kind == 2).mean()), float((kind == 1).mean()), hexadecimal, float(-(share * np.log2(share)).sum()),
                float(np.diff(np.concatenate([[-1], change, [n - 1]])).max()), len(change) / n, float(moves.mean()), float(moves.min()),
                _coverage(word, stats), float(word.count(b"/") + word.count(b"\\")), float(word.count(b".")), float(b"@" in word),
                float((kind == 0).mean()), float(bool(near) and near[-1]), float(any(near)), float(assigned),
                float(raw[start - 1:start] in (b'"', b"'", b"`")), _coverage(before[-1], stats) if before else 0.0, _coverage(after[0], stats) if after else 0.0]})
    return out


def strict_label(c: dict) -> int | None:
    """1 for known key formats and assigned random values, 0 for addresses,
    numbers, dates and dictionary words, None where neither is sure."""
    f = dict(zip(FEATURES, c["features"]))
    if _KNOWN.fullmatch(c["word"]):
        return 1
    if _NOT.fullmatch(c["word"]) or f["dictionary"] >= 0.8:
        return 0
    if c["assigned"] and f["length"] >= 12 and f["entropy"] >= 2.5 and f["digits"] > 0 and f["lower"] + f["upper"] > 0:
        return 1
    return None


# -- forest -----------------------------------------------------------------------

@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), threshold, left, right, vote."""
    trees: list[tuple[np.ndarray, ...]]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Share of trees that vote for a secret."""
        votes = np.zeros(len(x))
        for feature, threshold, left, right, vote in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while (feature[at] >= 0).any():
                inner = feature[at] >= 0
                low = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            votes += vote[at]
        return votes / max(1, len(self.trees))


def _tree_arrays(text: str) -> tuple[np.ndarray, ...]:
    """A tree from its printed form (nested If/Else lines)."""
    lines = [x.strip() for x in text.splitlines()]
    lines = [x for x in lines if x.startswith(("If", "Else", "Predict"))]
    feature, threshold, left, right, vote = [], [], [], [], []

    def read(at: int) -> tuple[int, int]:
        node = len(feature)
        for column in (feature, threshold, left, right, vote):
            column.append(0)
        if lines[at].startswith("Predict"):
            feature[node], vote[node] = -1, float(lines[at].split(":")[1])
            return node, at + 1
        number, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
        feature[node], threshold[node] = int(number), float(limit)
        left[node], at = read(at + 1)
        right[node], at = read(at + 1)   # past the Else line
        return node, at

    read(0)
    return tuple(np.array(c, dtype=np.float64 if c in (threshold, vote) else np.int64) for c in (feature, threshold, left, right, vote))


def train_forest(findings: DataFrame, per_class: int = TRAIN_FINDINGS, seed: int = 7) -> Forest | None:
    """``findings``: features (array of double), label (0 or 1), h (a hash).
    Findings of equal features and label count once. None if one of the classes
    is missing from the sample."""
    different = stage_table(findings.filter("label is not null").groupBy("features", "label").agg(F.min("h").alias("h")), "findings")
    sizes = {r["label"]: r["n"] for r in different.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    if set(sizes) != {0, 1}:
        return None
    share = F.when(F.col("label") == 1, min(1.0, per_class / sizes[1])).otherwise(min(1.0, per_class / sizes[0]))
    drawn = different.filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30))
    if {r["label"] for r in drawn.select("label").distinct().collect()} != {0, 1}:
        return None
    rows = drawn.select(array_to_vector("features").alias("x"), F.col("label").cast("double").alias("label"))
    model = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed, subsamplingRate=0.7,
                                   featureSubsetStrategy="sqrt").fit(rows)
    return Forest([_tree_arrays(t.toDebugString) for t in model.trees])


# -- labelled findings --------------------------------------------------------------

_DIGITS, _HEX, _UPPER, _LOWER = "0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = _DIGITS + _UPPER + _LOWER
_NAMES = ["password", "passwd", "pwd", "secret", "token", "key", "api_key", "apikey", "db_password", "access_token", "AUTH_TOKEN", "secret-key", "client_secret"]


def _any(rng: np.random.Generator, alphabet: str, least: int, most: int | None = None) -> str:
    return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), int(rng.integers(least, (most or least) + 1))))


def _named(rng: np.random.Generator, value: str) -> tuple[str, str, str]:
    """The value after a naming word and an assignment, quoted or not."""
    mark = ["", "\"", "'"][int(rng.integers(3))]
    return _NAMES[int(rng.integers(len(_NAMES)))] + ["=", " = ", ": ", ":"][int(rng.integers(4))] + mark, value, mark


def _uuid(rng: np.random.Generator) -> str:
    return "-".join(_any(rng, _HEX, n) for n in (8, 4, 4, 4, 12))


def _placeholder(rng: np.random.Generator, word: str) -> str:
    return ["your_{w}_here", "changeme{d}", "xxxxxxxx{d}", "example_{w}", "{w}_{w}_{d}", "********{d}"][int(rng.integers(6))].format(w=word, d=_any(rng, _DIGITS, 1, 4))


#: Makes of planted findings: name, label (1: a secret), and a function of a
#: random generator and a word of the document that gives the text before the
#: value, the value and the text after it.
FORMATS = [
    ("cloud key id", 1, lambda r, w: ("", ["AKIA", "ASIA"][int(r.integers(2))] + _any(r, _UPPER + _DIGITS, 16), "")),
    ("repository token", 1, lambda r, w: ("", "gh" + "pousr"[int(r.integers(5))] + "_" + _any(r, _ALNUM, 36), "")),
    ("chat token", 1, lambda r, w: ("", "xox" + "abprs"[int(r.integers(5))] + "-" + _any(r, _DIGITS, 10, 12) + "-" + _any(r, _ALNUM, 24), "")),
    ("service key", 1, lambda r, w: ("", "AIza" + _any(r, _ALNUM + "_-", 35), "")),
    ("named hexadecimal value", 1, lambda r, w: _named(r, _any(r, _HEX, 12, 64))),
    ("named random value", 1, lambda r, w: _named(r, _any(r, _ALNUM, 10, 48))),
    ("named password with marks", 1, lambda r, w: _named(r, _any(r, _ALNUM, 4, 10) + "!@#$%&*+"[int(r.integers(8))] + _any(r, _ALNUM, 4, 10))),
    ("named base 64 value", 1, lambda r, w: _named(r, _any(r, _ALNUM + "+/", 20, 64))),
    ("named pass phrase", 1, lambda r, w: _named(r, "".join(_any(r, _UPPER, 1) + _any(r, _LOWER, 3, 6) for _ in range(3)) + _any(r, _DIGITS, 2, 4))),
    ("network address", 0, lambda r, w: ("", ".".join(_any(r, "123456789", 1, 3) for _ in range(4)), "")),
    ("telephone number", 0, lambda r, w: ("+1 ", f"{_any(r, _DIGITS, 3)}-{_any(r, _DIGITS, 3)}-{_any(r, _DIGITS, 4)}", "")),
    ("long number", 0, lambda r, w: ("", _any(r, _DIGITS, 8, 20), "")),
    ("mail address", 0, lambda r, w: ("", f"{w}.{_any(r, _DIGITS, 2)}@mail{_any(r, _DIGITS, 1)}.example.com", "")),
    ("web address", 0, lambda r, w: ("https:", f"//www.example.com/{w}/{_any(r, _DIGITS, 2, 6)}", "")),
    ("file path", 0, lambda r, w: ("", f"/{w}/v{_any(r, _DIGITS, 1)}/{w}_{_any(r, _DIGITS, 2, 4)}.txt", "")),
    ("time stamp", 0, lambda r, w: ("", f"20{_any(r, _DIGITS, 2)}-{_any(r, '01', 2)}-{_any(r, '12', 2)}T{_any(r, '01', 2)}", "")),
    ("version", 0, lambda r, w: ("", f"{w}-{_any(r, _DIGITS, 1)}.{_any(r, _DIGITS, 1, 2)}.{_any(r, _DIGITS, 1, 2)}", "")),
    ("commit digest", 0, lambda r, w: (["commit ", "revision: ", "in "][int(r.integers(3))], _any(r, _HEX, 40), "")),
    ("content digest", 0, lambda r, w: (["sha256:", "md5: ", "digest="][int(r.integers(3))], _any(r, _HEX, [32, 64][int(r.integers(2))]), "")),
    ("row identifier", 0, lambda r, w: (["id: ", "uuid=", ""][int(r.integers(3))], _uuid(r), "")),
    ("word with a number", 0, lambda r, w: ("", w + _any(r, _DIGITS, 2, 5), "")),
    ("ticket", 0, lambda r, w: (["see ", ""][int(r.integers(2))], f"{_any(r, _UPPER, 3, 5)}-{_any(r, _DIGITS, 4, 6)}", "")),
    ("named placeholder", 0, lambda r, w: _named(r, _placeholder(r, w))),
    ("named word", 0, lambda r, w: _named(r, w)),
    ("named number", 0, lambda r, w: _named(r, _any(r, _DIGITS, 8, 12))),
]


def known_label(word: bytes) -> int | None:
    """1 for a published key format, 0 for the form of an address, number or
    date, else None."""
    return 1 if _KNOWN.fullmatch(word) else 0 if _NOT.fullmatch(word) else None


def _planted(texts: list[bytes | None], seeds: list[int], formats: list[tuple], each: int) -> tuple[list[bytes], list[tuple[int, int, int, int]]]:
    """Texts of some words of a document around a planted value, and for each
    the value's first and end byte, its label and the number of its format."""
    w = W.split(texts, _TABLE)
    made, places = [], []
    for d, (text, seed) in enumerate(zip(texts, seeds)):
        rng = np.random.default_rng(seed & ((1 << 63) - 1))
        lo, hi, base = int(w.bounds[d]), int(w.bounds[d + 1]), int(w.offsets[d])

        def part(first: int, end: int) -> bytes:
            """Words ``first`` to ``end``, with what stands between them."""
            return text[int(w.starts[first]) - base:int(w.starts[end - 1] + w.lens[end - 1]) - base] if first < end else b""

        for number in rng.permutation(len(formats))[:each].tolist():
            at = int(rng.integers(lo, hi + 1))
            pick = int(rng.integers(lo, hi)) if hi > lo else -1
            word = re.sub(r"[^\w]", "", part(pick, pick + 1).decode("utf-8", "ignore")).lower() if hi > lo else ""
            _, label, make = formats[number]
            before, value, after = (x.encode() for x in make(rng, word or "word"))
            left = part(max(lo, at - 4), at) + b" " + before
            made.append(left + value + after + b" " + part(at, min(hi, at + 3)))
            places.append((len(left), len(left) + len(value), label, number))
    return made, places


def plant_findings(docs: DataFrame, stats: Statistics, formats: list[tuple] | None = None, rows: int = PLANT_DOCS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``features, label, format, h``: labelled findings of about ``rows`` documents
    drawn by hash of id and text. ``format`` is the number of the make of a
    planted value, -1 for a finding of the document itself. Fewer documents get
    more values each, at most one of every make."""
    makes = FORMATS if formats is None else formats
    sent = docs.sparkSession.sparkContext.broadcast(stats)
    each = min(len(makes), max(1, rows // max(1, stats.rows)))
    shape = [pa.list_(pa.float64()), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            texts = W.texts_of(chunk, "text")
            found = [(c["features"], known_label(c["word"]), -1) for cs in find_candidates(texts, sent.value) for c in cs]
            made, places = _planted(texts, chunk.column(1).to_pylist(), makes, each)
            for cs, (first, end, label, number) in zip(find_candidates(made, sent.value), places):
                found += [(c["features"], label, number) for c in cs if first <= c["first"] and c["end"] <= end]
            found = [f for f in found if f[1] is not None]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(shape)], ["features", "label", "format"])

    share = min(1.0, rows / max(1, stats.rows))
    drawn = (docs.select(F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("seed"))
             .filter(F.pmod("seed", F.lit(1 << 30)) < share * (1 << 30)))
    return drawn.mapInArrow(run, "features array<double>, label int, format int").withColumn("h", F.xxhash64("features"))


def _scored(texts: list[bytes | None], stats: Statistics, forest: Forest | None) -> tuple[list[list[dict]], list[list[float]]]:
    """The candidates of every text and their scores."""
    rows = find_candidates(texts, stats)
    flat = [c for cs in rows for c in cs]
    if forest is None or not flat:
        scores = [float(strict_label(c) == 1) for c in flat]
    else:
        scores = forest.scores(np.array([c["features"] for c in flat])).tolist()
    ends = np.cumsum([0, *map(len, rows)]).tolist()
    return rows, [scores[a:b] for a, b in zip(ends, ends[1:])]


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_candidates, n_secrets, secrets`` (first and end byte, score)
    for every document row."""
    stats = corpus_statistics(docs, text_col)
    forest = train_forest(plant_findings(docs, stats, id_col=id_col, text_col=text_col) if findings is None else findings)
    sent = docs.sparkSession.sparkContext.broadcast((stats, forest))
    shape = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, "text", CHUNK_BYTES):
            rows, scores = _scored(W.texts_of(chunk, "text"), *sent.value)
            kept = [[{"first": c["first"], "end": c["end"], "score": s} for c, s in zip(cs, ss) if s >= threshold] for cs, ss in zip(rows, scores)]
            yield pa.RecordBatch.from_arrays([chunk.column(0), pa.array([len(cs) for cs in rows], pa.int64()), pa.array([len(k) for k in kept], pa.int64()),
                                              pa.array(kept, shape)], ["doc_id", "n_candidates", "n_secrets", "secrets"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, n_candidates long, n_secrets long, secrets array<struct<first: int, end: int, score: double>>"))


def mask_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5, mask: str = "[SECRET]",
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents, each found secret replaced by ``mask``; other columns as
    they were."""
    stats = corpus_statistics(docs, text_col)
    forest = train_forest(plant_findings(docs, stats, id_col=id_col, text_col=text_col) if findings is None else findings)
    sent = docs.sparkSession.sparkContext.broadcast((stats, forest))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in W.chunks(batches, text_col, CHUNK_BYTES):
            texts = W.texts_of(chunk, text_col)
            cut = False
            for d, (cs, ss) in enumerate(zip(*_scored(texts, *sent.value))):
                found = [c for c, s in zip(cs, ss) if s >= threshold]
                if found:
                    ends = [0, *(c["end"] for c in found)]
                    texts[d] = b"".join(texts[d][at:c["first"]] + mask.encode() for at, c in zip(ends, found)) + texts[d][ends[-1]:]
                    cut = True
            field = chunk.schema.field(place)
            yield chunk.set_column(place, field, pa.array(texts, pa.binary()).cast(field.type)) if cut else chunk

    return docs.mapInArrow(run, docs.schema)

import hashlib
import random

import numpy as np
import pytest
from llm_data import EDGE_TEXTS, alnum_words, docs_df

from feedloom.llm import decontamination as D


def plain(rows, items, window=10):
    phrases = {}
    for item, text in items:
        w = alnum_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for doc_id, text in rows:
        w, hit, found = alnum_words(text), set(), set()
        for p, owners in phrases.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit |= set(range(i, i + len(p)))
                    found |= owners
        out.append((doc_id, len(w), len(hit), sorted(found - {None})))
    return out


def result(found):
    return sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["first"] for s in r["spans"]), list(r["items"])) for r in found.collect()), key=str)


def test_suffix_order_and_search():
    rng = np.random.default_rng(1)
    for sigma in (1, 2, 5):
        runs = [rng.integers(1, sigma + 1, rng.integers(1, 40)) for _ in range(12)]
        text = np.concatenate([np.append(r, 0) for r in runs]).astype(np.int64)
        offset = np.concatenate([np.append(np.arange(len(r)), 1) for r in runs])
        index = D.FMIndex(text, offset, sigma)
        for n in range(1, 6):
            pattern = rng.integers(1, sigma + 1, (20, n))
            lo, hi = index.search(pattern, np.full(20, n))
            for p, a, b in zip(pattern, lo, hi):
                want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == p).all()]
                got = index.locate(np.arange(a, b)) if b > a else []
                assert sorted(got) == want


def test_wavelet_rank_and_access():
    seq = np.random.default_rng(2).integers(0, 9, 200)
    m = D.WaveletMatrix(seq, 8)
    assert (m.access(np.arange(200)) == seq).all()
    for c in range(9):
        ends = np.arange(201)
        assert (m.rank(np.full(201, c), ends) == [(seq[:e] == c).sum() for e in ends]).all()


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    words = [f"t{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 4, 9, 10, 25])))) for i in range(12)]
    items += [(12, None), (13, "?!"), (14, items[3][1]), (None, "null item words that nobody else has in any text at all")]
    rows = list(EDGE_TEXTS)
    for i in range(100, 160):
        parts = [rng.choice(words) for _ in range(30)]
        for _ in range(rng.choice([0, 1, 3])):
            parts[rng.randrange(30):0] = (rng.choice(items)[1] or "").upper().split()
        rows.append((i, ", ".join(parts)))
    return rows, items


def test_against_plain(spark, case):
    rows, items = case
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, spans string")
    got = result(D.find_contamination(docs_df(spark, rows).repartition(3), bench))
    assert got == sorted(plain(rows, items), key=str)
    clean = D.drop_contaminated(docs_df(spark, rows), bench)
    assert sorted((r["doc_id"], r["text"]) for r in clean.collect() if r["doc_id"] is not None) == sorted(
        (r[0], t) for r, (_, t) in zip(plain(rows, items), rows) if not r[2] and r[0] is not None)
    assert clean.columns == docs_df(spark, rows).columns
    cut = D.cut_contamination(docs_df(spark, rows), bench)
    assert cut.count() == len(rows)
    for r, (i, n, hits, _) in zip(cut.collect(), plain(rows, items)):
        assert r["doc_id"] == i and len(alnum_words(r["text"])) == n - hits


def test_several_benchmark_blocks(spark, case, monkeypatch):
    rows, items = case
    monkeypatch.setattr(D, "BLOCK_WORDS", 60)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert result(D.find_contamination(docs_df(spark, rows), bench)) == sorted(plain(rows, items), key=str)


def test_cutting_several_blocks_equals_one(spark, case, monkeypatch):
    rows, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")

    def cut():
        return sorted(((r["doc_id"], r["text"]) for r in D.cut_contamination(docs_df(spark, rows).repartition(3), bench).collect()), key=str)
    one = cut()
    monkeypatch.setattr(D, "BLOCK_WORDS", 60)
    assert cut() == one
    # Words that a cut brings together are no phrase.
    docs = docs_df(spark, [(1, "p a b c q r s t")])
    bench = spark.createDataFrame([(1, "a b c"), (2, "p q r"), (3, "s t")], "item_id long, text string")
    for size in (1, 1000):
        monkeypatch.setattr(D, "BLOCK_WORDS", size)
        assert [r["text"] for r in D.cut_contamination(docs, bench).collect()] == ["p  q r "]


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert D.find_contamination(docs_df(spark, []), bench).collect() == []
    out = D.find_contamination(docs_df(spark, [(1, "a b")]), bench.limit(0)).collect()
    assert [(r["n_words"], r["spans"], r["items"]) for r in out] == [(2, [], [])]


def test_query_digest(spark):
    from feedloom.llm.queries import op1_decontamination
    rows = op1_decontamination(spark, "/root/testdata/sf0.001").collect()
    assert any(r["contaminated"] for r in rows) and not all(r["contaminated"] for r in rows)
    for r in rows:
        if not r["n_items"]:
            assert r["items_sha256"] == hashlib.sha256(b"").hexdigest()

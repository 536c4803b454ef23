import math
import random
import re

import numpy as np
import pytest
from llm_data import EDGE_TEXTS, docs_df

from feedloom.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(rows, items, k):
    docs = [(i, terms(t)) for i, t in rows]
    docs = [(i, t) for i, t in docs if t]
    count, words = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, t in docs:
            m = 10 + (90 * len(t) * count) // words
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[x] + 1))) * ((10 ** 9 * t.count(x)) // (1000 * t.count(x) + 8 * m))
                        for x in ts if x in t)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(map(str, out))


def items_df(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id string, text string, doc_id string, score int")


def corpus(seed=4, n=300):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(60)] + ["Émile", "x1y", "the"] * 5
    rows = [(i % (n - 5), " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(25)))) for i in range(n)]
    rows += [(9000 + i, "the copied text t1 t2") for i in range(40)] + EDGE_TEXTS
    items = [(f"q{i}", ", ".join(rng.choice(vocabulary).upper() for _ in range(rng.randrange(1, 12)))) for i in range(15)]
    items += [("q3", "also t59 the"), (None, "t7 t8"), ("none", "zzz unknown"), ("empty", " .. "), ("null", None), ("copy", "copied the t1"), ("copy", "copied the t1")]
    return rows, items


@pytest.mark.parametrize("block, cells", [(2_000_000, 1 << 21), (12, 64)])
def test_against_plain(spark, monkeypatch, block, cells):
    monkeypatch.setattr(S, "BLOCK_TERMS", block)
    monkeypatch.setattr(S, "SHARES", 3)
    rows, items = corpus()
    got = S.search(docs_df(spark, rows, ["item_id"]).repartition(5), items_df(spark, items), k=4)
    assert sorted(map(str, map(tuple, got.collect()))) == plain(rows, items, 4)


def test_text_ids_and_null_ids(spark):
    rows = [("b", "one two"), ("a", "one two"), (None, "one two"), ("c", "three")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(1)
    got = S.search(docs, items_df(spark, [("q", "one")]), k=3).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, "a"), (2, "b"), (3, None)]


def test_score_table_in_small_steps(monkeypatch):
    rng = np.random.default_rng(1)
    bounds = np.array([0, 3, 4, 9, 9, 12])
    index = S.Index(np.arange(5, dtype=np.uint64), bounds, rng.integers(0, 6, 12).astype(np.int32), 6)
    doc = np.sort(rng.integers(0, 7, 40))
    term, gain = rng.integers(0, 5, 40), rng.integers(1, 100, 40)
    want = np.zeros((6, 7), dtype=np.int64)
    for d, t, g in zip(doc, term, gain):
        for i in index.items[bounds[t]:bounds[t + 1]]:
            want[i, d] += g
    for cells in (1, 4, 1000):
        monkeypatch.setattr(S, "SCORE_CELLS", cells)
        assert (S.score_table(index, doc, term, gain, 7) == want).all()


def test_empty(spark):
    docs, items = docs_df(spark, [(1, "a b")]), items_df(spark, [("q", "a")])
    assert S.search(docs.limit(0), items).collect() == []
    assert S.search(docs, items.limit(0)).collect() == []
    assert S.search(docs.limit(0), items).columns == S.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]

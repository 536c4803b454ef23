import random

import numpy as np
import pytest
from llm_data import EDGE_TEXTS, brute_components, docs_df, near_copies

from feedloom.llm import jaccard_join as J


def result(df):
    return sorted(map(str, map(tuple, df.select("doc_id", "n_shingles", "component_id").collect())))


@pytest.mark.parametrize("boundary", [None, 0, 12])
def test_against_brute_force(spark, monkeypatch, boundary):
    if boundary is not None:
        monkeypatch.setattr(J, "choose_boundary", lambda histogram: boundary)
    rows = near_copies() + [(1000 + (i or 0) if i is not None else None, t) for i, t in EDGE_TEXTS if t is None or len(t) < 1000]
    got = J.near_duplicate_components(docs_df(spark, rows).repartition(3))
    assert result(got) == sorted(map(str, brute_components(rows)))


def test_long_lists_in_turns(spark, monkeypatch):
    monkeypatch.setattr(J, "LEADERS", 2)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            words[rng.randrange(80)] = f"x{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    got = J.near_duplicate_components(docs_df(spark, rows).repartition(5))
    assert result(got) == sorted(map(str, brute_components(rows)))


def test_keep_one(spark):
    copy = "a text that is here several times and has more than five words"
    rows = [(4, copy), (2, copy), (2, copy), (9, None), (9, None), (3, "another text that has also more than five words in it"), (None, copy)]
    docs = docs_df(spark, rows)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(2, copy), (9, None), (9, None), rows[5]], key=str)


def test_empty(spark):
    assert J.near_duplicate_components(docs_df(spark, [])).collect() == []


def test_parity_maps_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.1], rng.integers(0, 1 << 63, n // 8 + 1).astype(np.uint64)]))
        assert J.maps_differ(J.parity_map(a), J.parity_map(b)) <= len(np.setxor1d(a, b))


def test_sizes():
    for n in range(1, 60):
        for m in range(1, 60):
            for both in range(1, min(n, m) + 1):
                assert (100 * both >= 80 * (n + m - both)) == (both >= J.need(n, m))
    assert J.least(10) == 8 and J.most(8) == 10
    assert J.choose_boundary({5: 10, 500: 10}) >= 0


def test_one_template_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(J, "LEADERS", 1)
    for turns in (0, 3):
        monkeypatch.setattr(J, "TURNS", turns)
        rng = random.Random(turns)
        base = [f"b{i}" for i in range(70)]
        rows = []
        for i in range(110):
            words = list(base[:rng.choice([64, 70, 70])])
            for _ in range(rng.choice([1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
            rows.append((i, " ".join(words)))
        assert result(J.near_duplicate_components(docs_df(spark, rows).repartition(3))) == sorted(map(str, brute_components(rows)))

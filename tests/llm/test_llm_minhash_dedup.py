import random

import numpy as np
import pytest
from llm_data import EDGE_TEXTS, docs_df, near_copies, shingles
from pyspark.sql import functions as F

from feedloom.llm import minhash_dedup as M
from feedloom.llm.jaccard_join import shingle_sets


def brute(rows):
    """The contract, over all pairs."""
    sets = [shingles(t, 3) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    out = [(doc_id, len(sets[i]), low.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)]
    return sorted(str((*r, r[0] == r[2])) for r in out)


def result(df):
    return sorted(map(str, map(tuple, df.select("doc_id", "n_shingles", "component_id", "kept").collect())))


def test_against_brute_force(spark):
    rows = near_copies() + [(1000 + (i or 0) if i is not None else None, t) for i, t in EDGE_TEXTS if t is None or len(t) < 1000]
    docs = docs_df(spark, rows, ["signature", "bucket", "a", "b", "component_id", "kept"]).repartition(3)
    assert result(M.near_duplicates(docs)) == brute(rows)


def template_texts(count, replaced, seed=8, words=60, choices=10_000):
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(count):
        text = list(base)
        for _ in range(rng.choice(replaced)):
            text[rng.randrange(words)] = f"x{rng.randrange(choices)}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("replaced, choices, few", [([2], 10_000, 16), ([1, 2, 3], 10_000, 0), ([3, 4], 6, 0)])
def test_one_template(spark, monkeypatch, replaced, choices, few):
    monkeypatch.setattr(M, "FEW", few)
    rows = template_texts(150, replaced, choices=choices)
    assert result(M.near_duplicates(docs_df(spark, rows).repartition(5))) == brute(rows)


def test_last_turn_at_once(spark, monkeypatch):
    monkeypatch.setattr(M, "TURNS", 0)
    rows = template_texts(120, [1, 2, 3], words=80) + [(1000 + i, t) for i, t in near_copies(seed=5, groups=5)]
    assert result(M.near_duplicates(docs_df(spark, rows).repartition(2))) == brute(rows)


def test_template_without_links_is_not_paired(spark):
    """Lists of one template: pairs joined stay below a few for each entry."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    sets = []
    for i in range(400):
        text = list(base)
        text[20], text[40] = f"x{rng.randrange(10_000)}", f"y{rng.randrange(10_000)}"
        sets.append((i, sorted({hash(tuple(text[j:j + 3])) for j in range(58)})))
    table = spark.createDataFrame(sets, "node long, items array<long>")
    lists = M._prefix_lists(table, table.select("node"))
    entries = lists.withColumns({"root": F.col("node"), "main": F.lit(-1)})
    assert lists.count() >= 400
    a, b = M._all_across(entries)
    joined = a.join(b, M._JOINED).count()
    assert joined == M._rows_joined(a, b) <= lists.count()


def test_components_of_random_graphs(spark):
    rng = random.Random(9)
    for hub in (None, 3):
        edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(700, 700 + i) for i in range(1, 60)]
        edges = [(a, b) for a, b in edges if a != b]
        parent = {x: x for e in edges for x in e}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in edges:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
        want = {x: find(x) for x in parent if find(x) != x}
        got = M.star_components(spark.createDataFrame(edges, "a long, b long"), hub)
        assert {r["node"]: r["root"] for r in got.collect()} == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        n = 2000
        common = rng.integers(0, 1 << 63, int(n * share)).astype(np.uint64)
        own = [rng.integers(0, 1 << 63, (n - len(common)) // 2).astype(np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([common, o])) for o in own)
        s = M.signatures([a, b, a[:1]])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - true) < 5 * (true * (1 - true) / M.HASHES) ** 0.5
    small = M.signatures(shingle_sets([b"one two three four", b"one two", b"one two"], 3))
    assert (small[1] == small[2]).all() and M.band_keys(small).shape == (3, M.BANDS)


def test_size_classes(spark):
    rows = spark.range(1, 6000).select(F.col("id").cast("int").alias("n")).withColumn("c", M.size_class(F.col("n"))).withColumn("low", M.class_low(F.col("c"))).collect()
    assert all(r["low"] <= r["n"] for r in rows)
    assert all(a["c"] <= b["c"] for a, b in zip(rows, rows[1:]))
    assert all(r["n"] - r["low"] <= 0.03 * r["n"] + 1 for r in rows if not 50 <= r["n"] < 52)


def test_empty(spark):
    assert M.near_duplicates(docs_df(spark, [])).collect() == []

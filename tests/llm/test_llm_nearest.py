import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import nearest as N

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, score string, k1 string, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, "x", "x", "x") for i, v in rows], SCHEMA)


def brute(rows, k):
    """Nearest ids and scores of the queries (ids divisible by 20)."""
    fine = [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in fine:
        if i % 20 == 0:
            best = sorted({(-float(w @ v), j) for j, w in fine if j != i and len(w) == len(v)})[:k]
            out[i] = [(j, -s) for s, j in best]
    return out


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(N, "SHARD", 300)
    monkeypatch.setattr(N, "QUERY_BLOCK", 20)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 24))
    x = (centres[rng.integers(0, 6, 1500)] + 0.7 * rng.normal(size=(1500, 24))) * rng.uniform(0.5, 2, (1500, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    vectors = frame(spark, rows)
    got = N.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0)).collect()
    want, hit = brute(rows, 20), 0
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(want)
    for q, rs in by.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, 21))
        assert all((a["score"], -a["vec_id"]) > (b["score"], -b["vec_id"]) for a, b in zip(rs, rs[1:]))
        for r in rs:
            exact = np.array(rows[r["vec_id"]][1], dtype=np.float32).astype(float) @ np.array(rows[q][1], dtype=np.float32).astype(float)
            assert abs(exact - r["score"]) < 1e-9
        hit += len({r["vec_id"] for r in rs} & {j for j, _ in want[q]})
    assert hit >= 0.9 * 20 * len(want)


def test_copies_ties_and_bad_vectors(spark):
    rows = [(i, [1.0, 2.0, 0.0]) for i in range(0, 60)] + [(100, [1.0, 2.0, 1.0]), (101, [3.0, 0.0, 0.0]), (102, None), (103, []), (104, [0.0, 0.0, 0.0]),
            (105, [1.0, None, 2.0]), (106, [float("nan"), 1.0, 1.0]), (107, [float("inf"), 1.0, 1.0]), (120, [1.0, 1.0]), (140, [2.0, 1.0]), (160, None),
            (None, [1.0, 2.0, 5.0]), (180, [9.0, 9.0, 9.0]), (180, [9.0, 9.0, 9.0])]
    vectors = frame(spark, rows)
    got = {}
    for r in N.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=5).collect():
        got.setdefault(r["query_id"], set()).add((r["rank"], r["vec_id"], round(r["score"], 9)))
    want = {q: {(k + 1, j, round(s, 9)) for k, (j, s) in enumerate(found)} for q, found in brute(rows, 5).items()}
    assert got == want


@pytest.mark.parametrize("n", [0, 1, 2, 21])
def test_few_vectors(spark, n):
    vectors = frame(spark, [(i, [float(i + 1), 1.0]) for i in range(n)])
    got = N.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0)).collect()
    queries = len([i for i in range(n) if i % 20 == 0])
    assert len(got) == queries * min(20, max(0, n - 1))


def test_prune_keeps_diverse_neighbours():
    points = np.array([[1, 0], [0.99, 0.141], [0.98, 0.199], [0, 1]], dtype=np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    out = N.robust_prune(points, np.array([0]), np.array([[1, 2, 3, 1, -1, 0]]), 3, 1.2)
    assert out[0, 0] == 1 and 2 not in out[0] and 3 in out[0]

import collections
import math

import numpy as np
import pytest
from llm_data import EDGE_TEXTS, docs_df, near_copies, space_words

from feedloom.llm import lm_scoring as M


@pytest.fixture(scope="module")
def rows():
    return [*near_copies(seed=9), *[(5000 + (i or 0) if i is not None else None, t) for i, t in EDGE_TEXTS]]


def plain(training, rows):
    c, pairs = collections.Counter(), collections.Counter()
    for _, t in training:
        tokens = [*space_words(t), None]
        c.update(tokens)
        pairs.update(zip([None, *tokens], tokens))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        tokens = [*space_words(t), None]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tokens)
        out.append((i, len(tokens), sum(c[x] > 0 for x in tokens), n, base))
    return out, c, pairs


@pytest.mark.parametrize("frequent", [1 << 20, 5])
def test_base_scores(spark, monkeypatch, rows, frequent):
    monkeypatch.setattr(M, "FREQUENT", frequent)
    training = [r for r in rows if (r[0] or 0) % 3]
    got = M.score(docs_df(spark, rows).repartition(3), M.learn(docs_df(spark, training))).collect()
    want, _, _ = plain(training, rows)
    key = lambda r: (str(r[0]), r[1], r[2], round(r[4], 6))
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6


def test_filter_has_no_false_negatives(spark, rows):
    model = M.learn(docs_df(spark, rows))
    _, c, pairs = plain(rows, rows)
    text = [t.encode() if t is not None else None for _, t in rows]
    t, bounds = M.tokens(text)
    words, times = np.unique(t, return_counts=True)
    codes = model.filter.codes(words)
    assert (codes >= M.code_of(times)).all() and (codes == M.code_of(times)).mean() > 0.9
    h, times = np.unique(M.pair_hashes(t, bounds), return_counts=True)
    codes = model.filter.codes(h)
    assert len(h) == len(pairs) and (codes >= M.code_of(times)).all() and (codes == M.code_of(times)).mean() > 0.9
    assert (model.filter.codes(np.arange(10_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) == 0).mean() > 0.8


def test_packing_of_counts():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 32, 5000, dtype=np.uint64).astype(np.uint32))
    counts = rng.integers(1, 1 << 20, len(values))
    a, b = M._unpack(M._pack(values, counts))
    assert (a == values).all() and (b == counts).all()


def test_better_than_the_base_score_on_held_out_text(spark):
    from feedloom.llm.queries import op9_lm_scoring
    held = [r for r in op9_lm_scoring(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_empty(spark):
    empty = M.learn(docs_df(spark, []))
    got = M.score(docs_df(spark, [(1, "a b")]), empty).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got] == [(3, 0, 0, 0.0)]
    assert M.score(docs_df(spark, []), empty).collect() == []


def plain_scores(c, pairs, rows):
    def range_of(n):
        return (0, 0) if not n else (2 ** (n.bit_length() - 1), 2 ** n.bit_length() - 1)
    n, v, out = sum(c.values()), len(c), []
    for i, t in rows:
        tokens = [*space_words(t), None]
        both = [(range_of(pairs[x, y])[0], range_of(c[x])[1], M.PRIOR * (range_of(c[y])[0] + 1) / (n + v + 1)) for x, y in zip([None, *tokens], tokens)]
        out.append((str(i), sum(math.log10((p + prior) / (before + M.PRIOR)) for p, before, prior in both)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(20))
def test_probabilities_sum_to_one_at_most(seed):
    """All words, and one unknown word, after each word and after an unknown one."""
    rng = np.random.default_rng(seed)
    v = int(rng.integers(1, 40))
    text = [0, *rng.choice(v, size=int(rng.integers(1, 2000)), p=rng.dirichlet(np.full(v, 0.3))).tolist(), 0]
    pairs = np.zeros((v + 1, v + 1), dtype=np.int64)                 # word v is unknown
    np.add.at(pairs, (text[:-1], text[1:]), 1)
    words = np.append(np.bincount(text[1:], minlength=v), 0)
    words[0] = max(words[0], pairs[0].sum())
    code = lambda n: np.where(n > 0, M.code_of(n), 0)
    distinct = int((words > 0).sum())
    for before in range(v + 1):
        p = 10 ** M.smoothed(code(pairs[before]), np.full(v + 1, code(words[before])), code(words), int(words.sum()), distinct)
        sum_ = p[words > 0].sum() + p[-1]
        assert (p > 0).all() and sum_ <= 1 + 1e-12, (before, sum_)


def test_sum_of_six_in_three_pairs():
    """Six times v, followed by three words twice each."""
    code = M.code_of(np.array([2, 2, 2, 6]))
    p = 10 ** M.smoothed(np.array([*code[:3], 0, 0]), np.full(5, code[3]), np.array([*code, 0]), 12, 4)
    assert p.sum() <= 1


def test_a_pair_is_not_more_frequent_than_its_words():
    code = lambda *x: np.array(x)
    assert M.smoothed(code(9), code(5), code(2), 1000, 100) == M.smoothed(code(2), code(5), code(2), 1000, 100)
    assert M.smoothed(code(3), code(5), code(0), 1000, 100) == M.smoothed(code(0), code(5), code(0), 1000, 100)


def test_scores_do_not_depend_on_the_filter_being_cut(spark, monkeypatch, rows):
    monkeypatch.setattr(M, "MAX_FILTER_BYTES", 1 << 10, raising=False)
    monkeypatch.setattr(M, "SLICE_PAIRS", 50)
    monkeypatch.setattr(M, "SCORE_BYTES", 3000, raising=False)
    monkeypatch.setattr(M, "BITS_PER_PAIR", 300)
    training = [r for r in rows if (r[0] or 0) % 3]
    model = M.learn(docs_df(spark, training))
    _, c, pairs = plain(training, rows)
    got = sorted((str(r["doc_id"]), r["score"]) for r in M.score(docs_df(spark, rows).repartition(3), model).collect())
    for a, b in zip(got, plain_scores(c, pairs, rows), strict=True):
        assert a[0] == b[0] and abs(a[1] - b[1]) < 1e-6
    entries = sum(int(M.code_of(np.array(list(x.values()))).sum()) for x in (c, pairs))
    assert model.filter.slices.count() > 100 and sum(8 * len(r["bits"]) for r in model.filter.slices.collect()) >= 0.99 * 300 * entries


def test_a_full_filter_ends_at_the_code_of_the_total():
    values = np.arange(100, dtype=np.uint32)
    assert (M.probe(values, b"\xff" * 64, 6, 9) == 9).all()

import itertools
import random
import zlib

import pytest
from llm_data import EDGE_TEXTS, docs_df, space_words
from pyspark.sql import functions as F

from feedloom.llm import packing, prefix, sharding


def plain_shards(rows, shards):
    key = sorted(((i is not None, i or 0, t is not None, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in rows))
    total, before, first, out = sum(k[4] for k in key), 0, {}, []
    for row, k in enumerate(key):
        shard = min(shards - 1, (2 * before + k[4]) * shards // (2 * total))
        first.setdefault(shard, row)
        out.append((k[1] if k[0] else None, k[4], k[3] if k[2] else None, shard, row - first[shard]))
        before += k[4]
    return out


def test_shards_against_plain(spark):
    rng = random.Random(1)
    rows = list(EDGE_TEXTS) + [(rng.randrange(500), "z" * rng.randrange(300)) for _ in range(700)] + [(77, "copy")] * 300
    for shards in (1, 5, 24):
        got = sharding.shard_by_bytes(docs_df(spark, rows).repartition(4), shards).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_shards(rows, shards)))


def test_shards_split_copy_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix, "COPY_BLOCK", 7)
    rows = [(1, "a")] * 100 + [(2, "bb")] * 20 + [(None, None)] * 30
    got = sharding.shard_by_bytes(docs_df(spark, rows), 6).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain_shards(rows, 6)))


def test_empty(spark):
    assert sharding.shard_by_bytes(docs_df(spark, [])).collect() == []
    assert packing.pack(docs_df(spark, [])).collect() == []


def test_boundaries_are_optimal():
    rng = random.Random(2)
    for _ in range(60):
        tops = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 9) for _ in tops]

        def padded(bounds):
            return sum(c * min(b for b in bounds if b >= t) for t, c in zip(tops, counts))
        for k in (1, 2, 3, 12):
            best = min(padded([*cut, tops[-1]]) for n in range(min(k, len(tops))) for cut in itertools.combinations(tops[:-1], n))
            found = packing.choose_boundaries(tops, counts, k)
            assert len(found) <= k and padded(found) == best


def test_boundaries_are_optimal_above_256():
    assert packing.choose_boundaries([8192, 8200, 8220, 8250], [100] * 4, 16) == [8192, 8200, 8220, 8250]
    rng = random.Random(7)
    for _ in range(25):
        tops = sorted(rng.sample(range(1, 40_000), rng.randrange(2, 40)))
        counts = [rng.choice([1, 5, 10 ** 12]) * rng.randrange(1, 9) for _ in tops]
        upto = list(itertools.accumulate(counts, initial=0))
        for k in (2, 3, 7):
            cost = [t * u for t, u in zip(tops, upto[1:])]      # plain dynamic programming
            for _ in range(k - 1):
                cost = [min([cost[j], *(cost[i] + tops[j] * (upto[j + 1] - upto[i + 1]) for i in range(j))]) for j in range(len(tops))]
            found = packing.choose_boundaries(tops, counts, k)
            assert len(found) <= k and sum(c * min(b for b in found if b >= t) for t, c in zip(tops, counts)) == cost[-1]


def test_lengths_beyond_the_exact_number(spark, monkeypatch):
    """The padding over cells is within 1 in PER_OCTAVE of the tokens."""
    rng = random.Random(1)
    lengths = [rng.randrange(1, 9000) for _ in range(3000)]
    docs = spark.createDataFrame([(i, "x", n) for i, n in enumerate(lengths)], "doc_id long, text string, n long")

    def padded():
        return sum(r["bucket_tokens"] for r in packing.pack(docs, buckets=6, length=F.col("n")).collect())
    exact = padded()
    monkeypatch.setattr(packing, "MAX_LENGTHS", 100)
    assert exact <= padded() <= exact + sum(lengths) / packing.PER_OCTAVE + 6


def test_cells_keep_order(spark):
    rows = spark.range(0, 5000).select(F.col("id").alias("n")).union(spark.range(1 << 29, (1 << 29) + 50).select("id"))
    cells = [r["c"] for r in rows.select("n", packing.length_cell(F.col("n")).alias("c")).orderBy("n").collect()]
    assert cells == sorted(cells) and cells[:256] == list(range(256))


def test_packing_invariants(spark):
    rng = random.Random(3)
    rows = list(EDGE_TEXTS) + [(i, "w " * rng.randrange(200)) for i in range(100, 900)] + [(5000, "same same")] * 200
    budget = 600
    got = packing.pack(docs_df(spark, rows), buckets=5, token_budget=budget).collect()
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=str) == sorted(((i, len(space_words(t))) for i, t in rows), key=str)
    batches = {}
    for r in got:
        assert r["n_tokens"] <= r["bucket_tokens"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for group in batches.values():
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
        assert len(group) == 1 or len(group) * group[0]["bucket_tokens"] <= budget
    for bucket in {b for b, _ in batches}:
        numbers = sorted(n for b, n in batches if b == bucket)
        assert numbers == list(range(len(numbers)))


def test_boundaries_do_not_depend_on_the_number_of_lengths(spark, monkeypatch):
    """Exact at any size; cells only if the caller asks for them."""
    lengths = [*range(8192, 8392), 9000, 9001]
    docs = spark.createDataFrame([(i, "x", n) for i, n in enumerate(lengths)], "doc_id long, text string, n long")

    def rows(**options):
        return sorted(map(tuple, packing.pack(docs, buckets=202, length=F.col("n"), **options).collect()))
    exact = rows()
    assert [r[3] for r in exact] == lengths          # a bucket for each length: no padding
    assert sum(r[3] for r in rows(cell=packing.length_cell)) > sum(lengths)
    monkeypatch.setattr(packing, "MAX_LENGTHS", 10)
    with pytest.warns(UserWarning, match="202 distinct lengths"):
        assert rows() == exact


def test_pipeline_packs_by_exact_lengths(spark, monkeypatch):
    """The pipeline's last stage, with more distinct lengths than MAX_LENGTHS."""
    import corpus_pipeline

    docs = docs_df(spark, [(i, "w " * n) for i, n in enumerate([*range(300, 312), 1000, 1001, 5000, 5001])])
    monkeypatch.setattr(packing, "MAX_LENGTHS", 3)
    with pytest.warns(UserWarning, match="16 distinct lengths"):
        got = corpus_pipeline.pack(spark, docs, "").collect()
    assert all(r["bucket_tokens"] == r["n_tokens"] for r in got) and len(got) == 16

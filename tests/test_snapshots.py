"""Commit log, deltas and growing buckets: rows always equal the plain merge."""
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from feedloom.operators import merge as M
from feedloom.operators import snapshots as S
from feedloom.streaming import drop_folder as D
from test_merge import CFG, _ok, _rows


def _batch(spark, b, count=20, keys=23):
    data = [(f"f{b:03}.xlsx", i, f"K{(i * (b + 3)) % keys}", "s", f"fin{b}-{i}", ["EUR", None][i % 2], ["lamp", "fan", "kit", "other"][(i + b) % 4], f"s{i}")
            for i in range(count + b)]
    return _ok(_rows(spark, data))


def _rows_of(tables, names=S.TABLES):
    return {t: sorted(map(str, map(tuple, tables[t].select(*sorted(tables[t].columns)).collect()))) for t in names}


def _files(root, table):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{root}/{table}") for f in fs if f.endswith(".parquet"))


def test_equals_plain_merge_and_keeps_versions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "BUCKET_ROWS", 6)
    root, plain, seen = str(tmp_path / "snap"), {}, []
    for b in range(4):
        ok = _batch(spark, b, keys=9 + 8 * b)
        plain = M.merge_run(plain, ok)
        for _ in range(2):                       # a replayed batch finds its own commit
            assert S.merge_batch(spark, root, ok, "job", b, buckets=2) == b
        seen.append(_rows_of(plain))
        assert _rows_of(S.read_snapshot(spark, root)) == seen[-1]
    assert [_rows_of(S.read_snapshot(spark, root, v)) for v in S.versions(spark, root)] == seen
    assert S.read_commit(spark, root)["base"]["buckets"] > 2     # buckets grew with the rows
    with pytest.raises(FileNotFoundError, match="does not exist"):
        S.read_snapshot(spark, root, 9)


def test_second_job_and_new_checkpoint_keep_all_rows(spark, tmp_path):
    root = str(tmp_path / "snap")
    a, b = _batch(spark, 0, keys=7), _batch(spark, 1, keys=50)
    S.merge_batch(spark, root, a, "one", 0)
    S.merge_batch(spark, root, b, "two", 0)                      # a batch 0 of its own
    want = _rows_of(M.merge_run(M.merge_run({}, a), b))
    assert _rows_of(S.read_snapshot(spark, root)) == want
    S.merge_batch(spark, root, a, "one", 0)                      # the first one's replay
    assert _rows_of(S.read_snapshot(spark, root)) == want
    with pytest.raises(RuntimeError, match="does not exist"):    # batch 1 of "one" was never committed here
        S.merge_batch(spark, root, a, "one", 2)


def test_two_writers_at_once(spark, tmp_path):
    """The second writer commits while the first one is about to."""
    root = str(tmp_path / "snap")
    first, a, b = (_batch(spark, i, keys=k) for i, k in ((0, 5), (1, 40), (2, 60)))
    S.merge_batch(spark, root, first)
    calls = []

    def other():
        if not calls:
            calls.append(1)
            S.merge_batch(spark, root, b, "two", 0)
    assert S.merge_batch(spark, root, a, "one", 0, before_commit=other) == 2
    want = M.merge_run(M.merge_run(M.merge_run({}, first), b), a)
    got = S.read_snapshot(spark, root)
    assert _rows_of(got) == _rows_of(want)
    ids = [r.product_id for r in got["core"].collect()]
    assert len(set(ids)) == len(ids) == S.read_commit(spark, root)["next_id"] - 1


def test_interleaved_writers_never_share_an_id(spark, tmp_path):
    root, rng = str(tmp_path / "snap"), random.Random(5)
    left = [(f"job{j}", n, _batch(spark, 3 * j + n, count=6, keys=15)) for j in range(2) for n in range(2)]

    def go(depth=0):
        """Merge a batch; before its commit, perhaps another one is merged."""
        if left:
            stream, n, rows = left.pop(next(i for i, x in enumerate(left) if all(y[0] != x[0] or y[1] > x[1] for y in left[:i])))
            S.merge_batch(spark, root, rows, stream, n, before_commit=lambda: go(depth + 1) if depth < 1 and rng.random() < 0.7 and left and left[0][0] != stream else None)
    while left:
        go()
    core = S.read_snapshot(spark, root)["core"].collect()
    ids = [r.product_id for r in core]
    assert sorted(ids) == list(range(1, len(ids) + 1)) and len({r.inventory_partno for r in core}) == len(core)
    history = {}
    for v in S.versions(spark, root):
        for r in S.read_snapshot(spark, root, v)["core"].collect():
            assert history.setdefault(r.inventory_partno, r.product_id) == r.product_id


def test_small_batch_writes_in_proportion(spark, tmp_path):
    root = str(tmp_path / "snap")
    big = _ok(_rows(spark, [("a.xlsx", i, f"K{i}", "s", "red", None, "lamp", "x") for i in range(400)]))
    S.merge_batch(spark, root, big, buckets=8)
    base = _files(root, "core")
    assert len(base) == 8
    S.merge_batch(spark, root, _ok(_rows(spark, [("b.xlsx", i, f"K{i * 40}", "s", "blue", None, "lamp", None) for i in range(8)])))
    added = set(_files(root, "core")) - set(base)
    assert sum(spark.read.parquet(f).count() for f in added) == 8 and set(base) <= set(_files(root, "core"))
    core = S.read_snapshot(spark, root)["core"]
    assert core.count() == 400 and core.filter("finish = 'blue'").count() == 8
    before = _rows_of(S.read_snapshot(spark, root))
    assert S.fold(spark, root) == 2 and S.fold(spark, root) is None
    assert _rows_of(S.read_snapshot(spark, root)) == before and S.read_commit(spark, root)["deltas"] == []
    entries = {e.dir for e in S._entries(spark, root, S.read_commit(spark, root)) if e.table == "core"}
    assert len(entries) == 2                                     # buckets without a changed key kept their files
    assert S.vacuum(spark, root, keep=1, older_than_hours=24) == 0
    assert S.vacuum(spark, root, keep=1, older_than_hours=-1) > 0
    assert _rows_of(S.read_snapshot(spark, root)) == before and S.versions(spark, root) == [2]


def test_buckets_split_without_moving_others(spark):
    hashes = spark.range(-500, 500).select((F.col("id") * 7919).cast("int").alias("h"))
    for n, more in ((1, 2), (3, 4), (4, 5), (5, 13), (6, 6)):
        rows = hashes.select("h", S.bucket_of(F.col("h"), n).alias("a"), S.bucket_of(F.col("h"), more).alias("b")).collect()
        moved = S.split_buckets(n, more)
        assert all(0 <= r.a < n and 0 <= r.b < more and (r.a in moved or r.a == r.b) for r in rows)
        assert all(r.a == S._bucket(r.h, n) for r in rows)


def test_put_if_absent_has_one_winner(spark, tmp_path):
    path, won = f"{tmp_path}/log/v=0/commit.json", []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if S.put_if_absent(spark, path, str(i)) else None) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1
    with open(path) as fh:
        assert fh.read() == str(won[0])
    assert [f for f in os.listdir(f"{tmp_path}/log/v=0") if f.endswith(".tmp")] == []


def test_rename_does_not_overwrite(spark, tmp_path):
    (tmp_path / "a").write_text("1")
    (tmp_path / "b").write_text("2")
    draft, target = (S._path(spark, f"{tmp_path}/{n}")[1] for n in ("a", "c"))
    S._rename(spark, draft, target)
    assert (tmp_path / "c").read_text() == "1" and not (tmp_path / "a").exists()
    with pytest.raises(Exception, match="FileAlreadyExists"):
        S._rename(spark, S._path(spark, f"{tmp_path}/b")[1], target)
    assert (tmp_path / "c").read_text() == "1"


def test_streams_of_two_checkpoints(spark, tmp_path):
    cfg = {"vendor_code": "Acme", "file_match": ["acme"], "sheets": [{"sheet_name": "S"}], "category": {"default": "lighting"},
           "column_map": {"core": {"inventory_partno": ["item"], "finish": ["finish"]}}}
    root, scratch = f"{tmp_path}/snap", set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))
    for job, lines in (("one", "0,A,red\n1,B,blue\n"), ("two", "0,C,green\n1,A,black\n"), ("one", "0,D,white\n")):
        drop = f"{tmp_path}/{job}"
        os.makedirs(drop, exist_ok=True)
        with open(f"{drop}/acme_{len(os.listdir(drop))}.csv", "w") as fh:
            fh.write("n,item,finish\n" + lines)
        query = D.start_feed(spark, drop, [cfg], root, f"{tmp_path}/ckpt-{job}", "n long, item string, finish string", "csv", {"row": "n"}, {"header": "true"})
        query.awaitTermination()
        assert [p.observedMetrics["feed"]["rows_read"] for p in query.recentProgress if p.numInputRows] == [lines.count("\n")]
    core = {r.inventory_partno: (r.product_id, r.finish) for r in D.latest_snapshot(spark, root)["core"].collect()}
    assert core == {"A": (1, "black"), "B": (2, "blue"), "C": (3, "green"), "D": (4, "white")}
    assert D.latest_snapshot(spark, root, f"{tmp_path}/ckpt-two")["core"].count() == 3
    assert set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:"))) == scratch   # working tables are gone

import zlib

import numpy as np
from llm_data import EDGE_TEXTS, docs_df

from feedloom.llm import language_id as L
from feedloom.llm.queries import op3_language_id


def plain_viterbi(scores, switch):
    n, k = scores.shape
    value, back = scores[0].astype(float), []
    for t in range(1, n):
        move = value[:, None] - switch * (1 - np.eye(k))
        back.append(move.argmax(axis=0))
        value = move.max(axis=0) + scores[t]
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return value.max(), path[::-1]


def test_paths_are_best():
    rng = np.random.default_rng(1)
    lengths = [0, 1, 7, 0, 30, 12, 1]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    scores = rng.normal(size=(bounds[-1], 3)).astype(np.float32)
    label = L.best_paths(scores, bounds, 1.5)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            best, _ = plain_viterbi(scores[a:b], 1.5)
            got = label[a:b]
            value = scores[np.arange(a, b), got].sum() - 1.5 * (got[1:] != got[:-1]).sum()
            assert abs(best - value) < 1e-3


def _labelled(spark):
    rows = []
    for i in range(40):
        rows.append((i, "the cat and the dog were with them in this house that night " * 3, "en"))
        rows.append((100 + i, "der hund und die katze waren nicht in diesem haus heute nacht " * 3, "de"))
        rows.append((200 + i, "кошка и собака были сегодня ночью в этом доме вместе с ними " * 3, "ru"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_spans_scripts_and_rejects(spark):
    model = L.train(_labelled(spark))
    assert model.langs == ["de", "en", "ru"]
    texts = [(1, "the dog and the cat were in this house. der hund und die katze waren nicht in diesem haus"), (2, "собака и кошка"),
             (3, "12 34"), (4, None), (5, "ελληνικά"), *[(100 + (i or 0), t) for i, t in EDGE_TEXTS]]
    docs = docs_df(spark, texts)
    got = {r["doc_id"]: r for r in L.identify(docs, model).collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "de"] and got[1]["spans"][0]["end"] == 9
    assert got[2]["lang_pred"] == "ru" and got[2]["score"] == 1.0
    assert got[3]["lang_pred"] == got[4]["lang_pred"] == "und" and got[4]["score"] == 0.0
    assert got[5]["lang_pred"] == "de" and got[5]["score"] == 0.0      # a script that was not learned
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = {r["doc_id"] for r in L.keep_identified(docs, model).collect()}
    assert {1, 2} <= kept and not {3, 4, 5} & kept


def test_empty_and_unlabelled(spark):
    model = L.train(_labelled(spark).limit(0))
    assert [r["lang_pred"] for r in L.identify(docs_df(spark, [(1, "some words")]), model).collect()] == ["und"]
    assert L.keep_identified(docs_df(spark, [(1, "some words")]), model).count() == 0
    assert L.identify(docs_df(spark, []), L.train(_labelled(spark))).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op3_language_id(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)

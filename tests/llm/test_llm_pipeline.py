"""Registered queries, the SQL form, and the pipeline against plain versions."""
import __spark_entry__ as E
import corpus_pipeline
from compare import compare, duck
from llm_data import brute_components, space_words
from test_llm_decontamination import plain
from test_llm_secret_scan import PLANTED

from feedloom.llm import language_id
from feedloom.llm.tables import remainder, table

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = E.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secrets", "packing"]


def test_sql_form(spark):
    for name in [q for q in E.oracle_sql() if q.startswith("op")]:
        problems, n = compare(E.queries()[name](spark, SF), duck(SF), E.oracle_sql()[name])
        assert not problems and n > 0, (name, problems)


def test_pipeline_against_plain_versions(spark):
    docs = table(spark, SF, "documents")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    one = stages["language_id"](spark, docs, SF)
    model = language_id.train(docs.filter(~remainder(docs.doc_id, 4, 2)))
    sure = {r["doc_id"] for r in language_id.identify(docs, model).collect() if r["lang_pred"] != "und" and r["score"] >= 1 / 3}
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == sure
    assert len(sure) >= 0.98 * len(rows)

    kept = sorted(sure)
    components = brute_components([(i, rows[i]["text"]) for i in kept])
    first = {i for i, n, c in components if not n or c == i}
    two = stages["near_duplicates"](spark, docs.filter(docs.doc_id.isin(kept)), SF)
    assert two.columns == columns and sorted(r["doc_id"] for r in two.collect()) == sorted(first)

    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {i for i, _, hit, _ in plain([(i, rows[i]["text"]) for i in sorted(first)], items) if not hit}
    assert clean < first
    three = stages["decontamination"](spark, docs.filter(docs.doc_id.isin(sorted(first))), SF)
    assert three.columns == columns and {r["doc_id"] for r in three.collect()} == clean

    four = stages["secrets"](spark, docs.filter(docs.doc_id.isin(sorted(clean))), SF)
    assert four.columns == columns and dict(four.dtypes) == dict(docs.dtypes)
    for r in four.collect():
        assert not PLANTED.search(r["text"].encode())
        if not PLANTED.search(rows[r["doc_id"]]["text"].encode()):
            assert r["text"] == rows[r["doc_id"]]["text"]
        assert r["n_chars"] == len(r["text"])

    packed = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r["doc_id"] for r in packed) == sorted(clean)
    lengths = {r["doc_id"]: len(space_words(r["text"])) for r in four.collect()}
    assert all(r["n_tokens"] == lengths[r["doc_id"]] <= r["bucket_tokens"] for r in packed)

"""Snapshot merge semantics (H1-H8) and their properties."""
from pyspark.sql import functions as F

from feedloom.operators import merge as M
from feedloom.operators.report import file_counters
from feedloom.plans.ingest import as_feed, canonical_rows

CFG = {
    "vendor_code": "V", "sheets": [{"sheet_name": "S"}],
    "category": {"strategy": "layered", "default": "lighting",
                 "column_value": {"columns": ["desc"], "mappings": {"fans": ["fan"], "lighting": ["lamp"], "accessories": ["kit"]}}},
    "column_map": {"core": {"inventory_partno": ["sku"], "finish": ["finish"], "currency_code": ["cur"]},
                   "lighting": {"shade": ["shade"]}, "fans": {"style": ["shade"]}},
}
SCHEMA = "file_name string, row_idx int, sku string, sku_kind string, finish string, cur string, desc string, shade string"


def _rows(spark, data):
    feed = as_feed(spark.createDataFrame(data, SCHEMA), row="row_idx", file="file_name", kinds={"sku": "sku_kind"})
    return canonical_rows(feed, CFG)


def _ok(rows):
    return rows.filter(F.col("status") == "ok")


def _by_key(df):
    return {r.inventory_partno: r for r in df.collect()}


def test_merge_semantics(spark):
    t_rows = _rows(spark, [("a.xlsx", 0, "A", "s", "red", "EUR", "lamp", "clear"),
                           ("a.xlsx", 1, "Z", "s", "blue", None, "lamp", None)])
    target = M.merge_run({}, _ok(t_rows))
    s_rows = _rows(spark, [
        ("b.xlsx", 0, "A", "s", None, None, "lamp", "frosted"),   # matched: finish -> NULL, currency kept
        ("b.xlsx", 1, "B", "s", "green", None, "kit", None),      # new, currency NULL -> USD
        ("b.xlsx", 2, "C", "s", "x", "CAD", "lamp", "opal"),      # same key: lighting then fans
        ("b.xlsx", 3, "C", "s", "y", None, "fan", "modern"),
        ("b.xlsx", 4, None, "s", "q", None, "lamp", None),        # missing key: skipped
        ("b.xlsx", 5, "0", "n", "q", None, "lamp", None),         # numeric zero key: error
        ("b.xlsx", 6, "0", "s", "q", None, "lamp", None),         # text '0' is a valid key
    ])
    out = M.merge_run(target, _ok(s_rows))
    core = _by_key(out["core"])
    assert core["A"].finish is None and core["A"].currency_code == "EUR"
    assert core["Z"].currency_code == "USD" and core["Z"].product_id == 2
    assert core["B"].currency_code == "USD"
    assert core["C"].category_type == "fans" and core["C"].finish == "y" and core["C"].currency_code == "CAD"
    assert core["A"].product_id == 1
    # new keys numbered after the existing max id in first-seen order
    assert [core[k].product_id for k in ("B", "C", "0")] == [3, 4, 5]
    lighting = {r.product_id: r for r in out["lighting"].collect()}
    fans = {r.product_id: r for r in out["fans"].collect()}
    assert lighting[core["C"].product_id].shade == "opal" and fans[core["C"].product_id].style == "modern"
    assert lighting[core["A"].product_id].shade == "frosted"
    assert [r.product_id for r in out["accessories"].collect()] == [core["B"].product_id]
    status = {r.row_idx: r.status for r in s_rows.collect()}
    assert status[4] == "skipped" and status[5] == "error" and status[6] == "ok"
    c = file_counters(s_rows).first()
    assert c.rows_total == c.rows_upserted + c.rows_skipped_missing_key + c.rows_error == 7


def test_merge_idempotent_and_order_free(spark):
    data = [(f"f{i % 3}.xlsx", i, f"K{i % 7}", "s", f"fin{i}", ["EUR", None, "CAD"][i % 3],
             ["lamp", "fan", "kit", "other"][i % 4], f"s{i}") for i in range(60)]
    rows = _ok(_rows(spark, data))
    once = M.merge_run({}, rows)
    twice = M.merge_run(once, rows)
    shuffled = M.merge_run({}, rows.repartition(7, "row_idx"))
    for table in ("core", "lighting", "fans", "accessories"):
        a = sorted(map(tuple, once[table].collect()))
        assert a == sorted(map(tuple, twice[table].collect())), table
        assert a == sorted(map(tuple, shuffled[table].collect())), table


def test_exclude_failed_files(spark):
    rows = _rows(spark, [("a.xlsx", 0, "A", "s", None, None, "lamp", None),
                         ("b.xlsx", 0, "B", "s", None, None, "lamp", None)])
    failed = spark.createDataFrame([("b.xlsx",)], "path string")
    keys = [r.inventory_partno for r in M.exclude_failed_files(_ok(rows), failed).collect()]
    assert keys == ["A"]


def test_conversions_in_turn_and_rejected_text(spark):
    cfg = dict(CFG, column_map={"core": {"inventory_partno": ["sku"], "wholesale_price": ["p"], "bulb_quantity": ["p"], "width_in": ["w"], "is_imap": ["b"]}},
               conversions={"money": ["wholesale_price", "bulb_quantity"], "int": ["bulb_quantity"], "bool": ["is_imap"], "decimals": ["is_imap"]})
    feed = spark.createDataFrame([(0, "A", "$12,345,678", "1.5", "1"), (1, "B", "0.5", "wide", "yes"), (2, "C", "1e3", None, "0")],
                                 "r int, sku string, p string, w string, b string")
    got = {r.row_idx: r for r in canonical_rows(as_feed(feed, row="r"), cfg).collect()}
    assert [got[i].bulb_quantity for i in range(3)] == [12345678, 0, 1000]
    assert [got[i].is_imap for i in range(3)] == [None, None, None]     # "1.0", nothing and "0.0" are no yes/no words
    assert [got[i].status for i in range(3)] == ["ok", "error", "ok"] and got[1].rejected_field == "width_in"

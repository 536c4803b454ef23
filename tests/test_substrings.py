"""Trigram lookup of patterns against a plain search in every text."""
import random

from pyspark.sql import functions as F

from feedloom.operators.classify import column_value_substring_table
from feedloom.operators.files import vendor_match, with_name_parts
from feedloom.operators.substrings import first_substring, grams


def test_grams(spark):
    df = spark.createDataFrame([("abcab",), ("é😀x",), ("ab",), ("",), ("a\nb",)], "t string")
    got = [tuple(map(sorted, r)) for r in df.select(grams(F.col("t"), 3), grams(F.col("t"), 1)).collect()]
    assert got == [(["abc", "bca", "cab"], ["a", "b", "c"]), (["é😀x"], sorted("é😀x")), ([], ["a", "b"]), ([], []), (["a\nb"], ["\n", "a", "b"])]


def test_first_substring_against_plain_search(spark):
    rng = random.Random(4)

    def word(low, high):
        return "".join(rng.choice("abcé😀_") for _ in range(rng.randrange(low, high)))
    texts = [word(0, 14) for _ in range(300)] + [None, "", "aaa"]
    for empty in ([], [("", 900, 0)]):
        rules = [(word(1, 6), rng.randrange(50), i) for i in range(150)] + [(None, 0, -1)] + empty
        table = spark.createDataFrame([(p, s, i, f"v{i}") for p, s, i in rules], "pattern string, seq int, place int, vendor string")
        found = first_substring(spark.createDataFrame([(t,) for t in texts], "t string").repartition(3), "t", table, ["seq", "place"])
        got = {r.text: r.rule.vendor for r in found.collect()}
        want = {}
        for t in {t for t in texts if t is not None}:
            hits = [(s, i) for p, s, i in rules if p is not None and p in t]
            if hits:
                want[t] = f"v{min(hits)[1]}"
        assert got == want


def test_vendor_match_in_both_forms(spark):
    files = with_name_parts(spark.createDataFrame([(f"/in/{n}",) for n in ("ACME_1.xlsx", "acme_2.xls", "b.xlsx", "zz.xlsx", "ac.xlsx")], "path string"))
    rules = spark.createDataFrame([(0, 0, "Two", "acme_2"), (1, 0, "Acme", "acme"), (1, 1, "Acme", "ac"), (2, 0, None, "b."), (3, 0, "Never", "acme_1")],
                                  "mapping_seq int, pattern_seq int, vendor_code string, pattern string")
    a, b = (sorted(map(str, map(tuple, vendor_match(files, rules, inline=n).select("path", "vendor_code", "mapping_seq", "status", "reason").collect()))) for n in (2000, 0))
    assert a == b and vendor_match(files, rules, inline=0).columns == vendor_match(files, rules).columns
    assert vendor_match(files, rules.limit(0), inline=0).filter("status = 'skipped'").count() == 5


def test_many_patterns_make_no_cross_join(spark):
    """100,000 patterns: what the lookup yields before the test is near the hits."""
    rules = spark.range(100_000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("_")).alias("pattern"),
                                        F.col("id").cast("int").alias("seq"))
    texts = spark.range(0, 100_000, 50).select(F.concat(F.lit("feed_k"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit("_x.csv")).alias("t"))
    found = first_substring(texts, "t", rules, ["seq"])
    assert found.filter("text = concat('feed_', rule.pattern, 'x.csv')").count() == 2000
    plan = found._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_category_values_in_both_forms(spark):
    df = spark.createDataFrame([(1, "Ceiling FAN", "x"), (2, "lamp and fan", None), (3, None, None), (4, "other", "y")], "i int, a string, b string")
    cfg = {"category": {"column_value": {"columns": ["a", "b"], "mappings": {"lights": ["lamp"], "fans": ["fan", " "], "odd": ["r | y"]}}}}
    a, b = ({r.i: r.category_type for r in column_value_substring_table(df, cfg, inline=n).collect()} for n in (2000, 0))
    assert a == b == {1: "fans", 2: "lights", 3: None, 4: "odd"}


def test_no_rule_table_passes_through_the_driver(spark, monkeypatch):
    """Numbers as patterns: told apart by their grams, and joined without a broadcast
    beyond BROADCAST_ROWS, with the same result."""
    from feedloom.operators import substrings

    rules = spark.range(1000, 4000).select(F.concat(F.col("id").cast("string"), F.lit("00.xlsx")).alias("pattern"), (-F.col("id")).alias("seq")).union(
        spark.range(10).select(F.col("id").cast("string"), F.col("id")))
    texts = spark.range(0, 5000, 7).select(F.concat(F.lit("feed_0"), F.col("id").cast("string"), F.lit("00.xlsx")).alias("t"))
    filed = substrings.filed_patterns(rules, ["seq"])
    assert filed.groupBy("n", "key").count().agg(F.max("count")).first()[0] <= 2
    got = []
    for rows in (1 << 16, 5):
        monkeypatch.setattr(substrings, "BROADCAST_ROWS", rows)
        found = first_substring(texts, "t", rules, ["seq"])
        got.append(sorted((r.text, r.rule.pattern) for r in found.collect()))
        assert ("BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == (rows > 5)
    want = [(t, f"{i}00.xlsx" if 1000 <= i < 4000 else "0") for i in range(0, 5000, 7) for t in [f"feed_0{i}00.xlsx"]]
    assert got[0] == got[1] == sorted(want)

"""Classification layers and strategies on small hand-made feeds."""
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from feedloom.config import bundled
from feedloom.operators.classify import classify

COLS = "row_idx int, short_description string, product_name string, canopy_height string, blade_span string"


def _classify(spark, rows, cfg=None, layer=True):
    df = spark.createDataFrame(rows, COLS)
    out = classify(df, cfg or bundled("parts_layered"), layer_col="layer" if layer else None)
    return {r.row_idx: (r.category_type, r.layer if layer else None) for r in out.collect()}


def test_layered_examples(spark):
    got = _classify(spark, [
        (0, "52 Inch Smart Ceiling Fan", None, None, None),
        (1, "Armless chair", None, None, None),
        (2, "Ceiling Fan Remote", None, None, None),
        (3, None, None, "5", None),
        (4, "fan", None, None, None),
        (5, None, "Big BLADES thing", None, None),
        (6, "   ", None, "  ", None),
        (7, None, None, None, "52"),
    ])
    assert got[0] == ("fans", "column_value_substring")
    assert got[1] == ("furniture", "regex_scan")
    assert got[2][0] == "fans"            # mapping order beats specificity
    assert got[3] == ("lighting", "feature_presence")
    assert got[4] == ("fans", "column_value_exact")
    assert got[5] == ("fans", "regex_scan")
    assert got[6] == ("lighting", "default")
    assert got[7] == ("fans", "feature_presence")


def test_invalid_regex_skipped_and_empty_category_ends_layer(spark):
    cfg = {"category": {"strategy": "layered", "default": "lighting", "regex_scan": {
        "columns": ["short_description"],
        "rules": [{"category_type": "bad", "any_regex": ["(unclosed"]},
                  {"any_regex": ["(?i)\\bstop\\b"]},
                  {"category_type": "fans", "any_regex": ["(?i)stop|fan"]}]}}}
    got = _classify(spark, [(0, "please stop", None, None, None), (1, "a fan", None, None, None)], cfg, layer=False)
    assert got[0][0] == "lighting"   # hit on a rule without category -> no result -> default
    assert got[1][0] == "fans"


def test_rules_strategy_and_default(spark):
    cfg = {"category": {"strategy": "RULES ", "rules": [
        {"if_any_field_present": ["blade"], "category_type": "fans"},
        {"default": "home_decor"},
        {"if_any_field_present": ["canopy"], "category_type": "never"}]}}
    got = _classify(spark, [(0, None, None, "1", "2"), (1, None, None, "1", None)], cfg, layer=False)
    assert got == {0: ("fans", None), 1: ("home_decor", None)}
    assert _classify(spark, [(0, "fan", None, None, None)], {"category": {"strategy": "weird"}}, layer=False)[0][0] == "lighting"


def test_pipeline_columns_are_not_seen_and_sheet_columns_are(spark):
    cfg = {"category": {"strategy": "rules", "rules": [
        {"if_any_field_present": ["bulb_kind"], "category_type": "bulbs"}, {"if_any_field_present": ["_src_file"], "category_type": "never"},
        {"default": "other"}]}}
    df = spark.createDataFrame([(0, "f", "led", "r"), (1, "f", None, "r")], "_src_row int, _src_file string, bulb_kind string, run_id string")
    got = {r._src_row: r.category_type for r in classify(df, cfg).collect()}
    assert got == {0: "bulbs", 1: "other"}


def test_python_patterns_in_java(spark):
    import re

    from feedloom.functions.patterns import java_pattern

    texts = ["a chair", "armchair x", "wall art", "wall  art", "abba", "Größe chair", "chair\n", "x(1)", "REMOTE for", "foo bar"]
    patterns = [r"(?a)\bchair\b", "(?x) wall \\s art  # comment", r"(?P<w>b)(?P=w)", r"(?i)remote", r"chair\Z", r"(?s)c.*$", "x\\(1\\)", r"(?im)^FOO", r"\w+\s\w+"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for p in patterns:
        got = {r.i: r.hit for r in df.selectExpr("i", "t").withColumn("hit", df.t.rlike(java_pattern(p))).collect()}
        assert got == {i: bool(re.search(p, t)) for i, t in enumerate(texts)}, p
    assert java_pattern("(unclosed") is None


def test_fused_patterns(spark):
    cfg = {"category": {"regex_scan": {"columns": ["t"], "rules": [
        {"category_type": "a", "any_regex": [r"(?a)\bone\b", "(?x) two # note", r"(?P<g>three)", r"(?P<g>four)", "(?i)five", "six"]}]}}}
    from feedloom.operators.classify import classify_layer
    df = spark.createDataFrame([(t,) for t in ["one", "two", "three", "four", "FIVE", "six", "SIX", "seven"]], "t string")
    got = {r.t: r.category_type for r in classify_layer(df, cfg, "regex_scan").collect()}
    assert got == {"one": "a", "two": "a", "three": "a", "four": "a", "FIVE": "a", "six": "a", "SIX": None, "seven": None}


PIECES = ["a", "B", "fan", "\\b", "\\B", "\\s", "\\S", "\\w", "\\W+", "\\d", ".", "$", "^", "\\Z", "\\A", "[a-c]", "[^a]", "[f&&x]", "[[a]x", "[\\w-]", "[^\\W_]",
          "[^\\s\\d]", "[\\Wa]", "(?:ab|b)", "(a)", "(?i:FAN)", "(?-i:a)", "(?a:\\w)", "(?s:.)", "(?m:^b)", "x*", "b+?", "a{,2}", "a{1,2}", "{", "a{b}", "(?=b)", "(?!a)",
          "(?<=a)", "(?<!\\w)", "\\x41", "\\u00e9", "\\101", "\\0", "\\v", "\\.", "\\#", " ", "#", "é", "(?>a|ab)", "a?+", "[\\b]", "[ #]", "(?#note)", "|"]
CHARS = ["a", "b", "B", "A", "f", "x", "fan", "FAN", " ", "\n", "\r", "\x85", "\u2028", "\x1c", "\x1f", "\u0301", "é", "É", "1", "²", "_", "&", "[", "{", "#", "\x0b", "\x08", "-", "\xa0"]


def test_patterns_mean_what_python_means(spark):
    import random
    import re
    import warnings

    from feedloom.functions.patterns import to_java

    rng, compiled = random.Random(11), spark._jvm.java.util.regex.Pattern
    tried = 0
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for _ in range(700):
            p = rng.choice(["", "", "(?i)", "(?m)", "(?s)", "(?x)", "(?a)", "(?ims)"]) + "".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 5)))
            java = to_java(p)
            try:
                python = re.compile(p)
            except re.error:
                assert java is None
                continue
            pattern = compiled.compile(java)
            for _ in range(4):
                text = "".join(rng.choice(CHARS) for _ in range(rng.randrange(7)))
                tried += 1
                assert pattern.matcher(text).find() == (python.search(text) is not None), (p, java, text)
    assert tried > 1500


def test_probed_patterns(spark):
    import re

    from feedloom.functions.patterns import java_pattern

    cases = [("a.c", "a\rc"), ("a.c", "a\x85c"), ("fan$", "fan\r"), ("fan$", "fan\u2028"), ("fan$", "fan\n"), ("[f&&x]an", "fan"), ("(?x)ceiling[ ]fan", "ceiling fan"),
             ("[[a]x", "ax"), ("[[a]x", "[x"), ("(?a:\\w)", "é"), ("(?a:\\w)", "e"), ("\\s", "\x1d"), ("e\\b", "e\u0301"), (r"(?P<x>[a-z])(?P=x)1", "zz1"), (r"(a)\1{2}", "aaa")]
    for p, t in cases:
        hit = spark.createDataFrame([(t,)], "t string").select(F.col("t").rlike(java_pattern(p))).first()[0]
        assert hit == (re.search(p, t) is not None), (p, t)
    with pytest.raises(ValueError, match="no Java form"):
        java_pattern(r"(a)?(?(1)b|c)")


PIECES = ["fan", "(?i:Ceil)", "blades?", "(chair|stool)", "(chair|x)", "(?:lamp )+", "(?:lamp)*", r"\bcfm\b", r"\s+", "[Ff]an", "Kelvin", "(?=tube)", "tu(?!x)be",
          "table{2}", "(?>mirror)", "é", "ſtool", ".", "$", "|", "dim{0,1}mer"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), min_size=1, max_size=4), st.booleans(),
       st.lists(st.sampled_from(["fan", "FAN", "ceil", "blade", "blades", "chair", "ſtool", "STOOL", "stool", "lamp ", "CFM", " ", "\u212aelvin", "kelvin", "tube", "tablee",
                                 "mirror", "É", "\u0130", "x", "dimmer", "dmer"]), max_size=5))
def test_literals_are_in_every_match(pieces, fold, words):
    """A text in which Python finds the pattern holds a literal of it."""
    from feedloom.functions.patterns import java_parts, needed_literals

    pattern, text = ("(?i)" if fold else "") + "".join(pieces), "".join(words)
    if java_parts(pattern) is None:
        return
    literals = needed_literals(pattern)
    if literals is not None and re.search(pattern, text):
        assert any(x in text.lower() for x in literals)


def test_guards_change_no_result(spark):
    from feedloom.functions.patterns import needed_literals
    from feedloom.operators.classify import any_pattern

    assert needed_literals(r"(?i)\b(mirror|tapestry|candle\s*holder)\b") == {"rror", "tape", "candle"}
    assert needed_literals("(?i)KISS") is None and needed_literals("a|fan") is None
    rules = [["fan", r"(?i)\bblades?\b"], [r"(?i)(chair|STOOL)"], ["(?i)candle\\s*holder", "^tube"], ["[Ff]an"]]
    texts = ["fan", "FAN", "Blades", "bladesmith", "ChAir", "ſtool", "candle  HOLDER", "tube", "a tube", "Fan", "É fan", "\u0130 chair", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", *[(any_pattern(F.col("t"), r) if i == 0 else any_pattern(F.col("t"), r, F.lower("t"))).alias(f"c{k}_{i}") for k, r in enumerate(rules) for i in (0, 1)]).collect()
    for r in got:
        for k, rule in enumerate(rules):
            want = None if r.t is None else any(re.search(p, r.t) is not None for p in rule)
            assert r[f"c{k}_0"] == r[f"c{k}_1"] == want, (r.t, rule)

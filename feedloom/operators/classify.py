"""Category classification (F1-F7), compiled at plan time to one CASE chain.

The strategy branch, the set of columns each rule can see and the regex
validity are all resolved on the driver from the mapping and the feed's
schema, so the per-row work is a single projection (no UDF, no shuffle).
Rule order is preserved by ordered ``when`` chains: the first hit wins.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.patterns import checked, java_parts, needed_literals, refers_back
from ..functions.text import has_text, strip_u
from ..schema import DEFAULT_CATEGORY, HAS, RESERVED
from .substrings import INLINE_RULES, first_substring


#: Literals looked for before a rule's patterns at most; beyond that the patterns alone are scanned for.
MAX_GUARDS = 64


def feed_columns(columns: Iterable[str]) -> list[str]:
    """The feed's own columns: rules never see what the pipeline adds."""
    return [c for c in columns if not c.startswith(RESERVED)]


def _null() -> Column:
    return F.lit(None).cast("string")


def feature_tokens(tokens) -> list[str]:
    """Lower-cased, stripped, non-empty tokens."""
    cleaned = (str(t).strip().lower() for t in tokens or ())
    return [t for t in cleaned if t]


def config_tokens(cfg: dict) -> list[str]:
    """All feature tokens that a mapping's rules ask for, without repeats."""
    cat = cfg.get("category") or {}
    rules = [*(cat.get("rules") or []), *((cat.get("feature_presence") or {}).get("rules") or [])]
    return list(dict.fromkeys(t for r in rules for t in feature_tokens(r.get("if_any_field_present"))))


def feature_present(columns: Iterable[str], tokens) -> Column:
    """some column whose lower-cased name equals/contains a token has text.

    A pivoted sheet holds the mapping's columns only; it brings one flag for
    each token, worked out over all columns of the sheet (see ``mapped_rows``).
    """
    columns = list(columns)
    checks = []
    for t in feature_tokens(tokens):
        if HAS + t in columns:
            checks.append(F.coalesce(F.col(f"`{HAS}{t}`"), F.lit(False)))
        else:
            checks += [has_text(F.col(f"`{c}`")) for c in feed_columns(columns) if t in str(c).lower()]
    if not checks:
        return F.lit(False)
    out = checks[0]
    for c in checks[1:]:
        out = out | c
    return out


def joined_values(columns: Iterable[str], wanted, sep: str, lower: bool) -> Column:
    """Non-empty stripped texts of the listed columns that exist, joined by ``sep``."""
    parts = []
    for c in wanted or []:
        if c in columns:
            v = strip_u(F.col(f"`{c}`"))
            parts.append(F.when(v != F.lit(""), F.lower(v) if lower else v))
    if not parts:
        return F.lit("")
    return F.concat_ws(sep, *parts)


def column_value_exact(columns, cv: dict, joined: Column | None = None) -> Column:
    """the joined lower-cased text equals a mapping value (category order)."""
    joined = joined_values(columns, cv.get("columns"), " | ", lower=True) if joined is None else joined
    out = None
    for cat, vals in (cv.get("mappings") or {}).items():
        vv = [str(v).strip().lower() for v in (vals or []) if str(v).strip()]
        if not vv:
            continue
        cond = (joined != F.lit("")) & joined.isin(*vv)
        out = F.when(cond, F.lit(cat)) if out is None else out.when(cond, F.lit(cat))
    return _null() if out is None else out


def column_value_substring(columns, cv: dict, joined: Column | None = None) -> Column:
    """some mapping value is contained in the joined text (category order)."""
    joined = joined_values(columns, cv.get("columns"), " | ", lower=True) if joined is None else joined
    out = None
    for cat, vals in (cv.get("mappings") or {}).items():
        vv = [str(v).strip().lower() for v in (vals or []) if str(v).strip()]
        if not vv:
            continue
        cond = None
        for v in vv:
            c = joined.contains(v)
            cond = c if cond is None else (cond | c)
        cond = (joined != F.lit("")) & cond
        out = F.when(cond, F.lit(cat)) if out is None else out.when(cond, F.lit(cat))
    return _null() if out is None else out


def any_pattern(text: Column, patterns, low: Column | None = None) -> Column | None:
    """True when any valid pattern is found in ``text``.

    Patterns that share their flags are fused into one alternation, so the text
    is scanned once per rule; those with back-references are tested one by one. Patterns
    that Python rejects are skipped; one that only Java rejects fails the plan.

    ``low``: the lower-cased text. Where every pattern needs one of a few literals
    (``MAX_GUARDS`` in all), only texts that hold one are scanned for the patterns.
    """
    fused: dict[str, list[str]] = {}
    single, literals = [], frozenset()
    for p in map(str, patterns):
        parts = java_parts(p)
        if parts is None:
            continue
        flags, body = parts
        checked(p, flags + body)
        needed = needed_literals(p)
        literals = None if literals is None or needed is None else literals | needed
        if refers_back(body):
            single.append(flags + body)
        else:
            fused.setdefault(flags, []).append(body)
    single += [flags + "|".join(f"(?:{b})" for b in bodies) for flags, bodies in fused.items()]
    if not single:
        return None
    out = text.rlike(single[0])
    for p in single[1:]:
        out = out | text.rlike(p)
    if low is None or literals is None or len(literals) > MAX_GUARDS:
        return out
    return reduce(or_, [low.contains(x) for x in sorted(literals)]) & out


def regex_scan(columns, rs: dict, hay: Column | None = None, low: Column | None = None) -> Column:
    """first rule with a pattern found in the newline-joined original texts.

    A hit on a rule without ``category_type`` ends the layer with no result.
    ``hay``, ``low``: the joined texts and their lower-case form, where staged.
    """
    hay = joined_values(columns, rs.get("columns"), "\n", lower=False) if hay is None else hay
    out = None
    for rule in rs.get("rules") or []:
        cond = any_pattern(hay, rule.get("any_regex") or [], low)
        if cond is None:
            continue
        cond = (hay != F.lit("")) & cond
        cat = rule.get("category_type") or None
        val = F.lit(cat) if cat else _null()
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return _null() if out is None else out


def category_expr(columns: Iterable[str], cfg: dict, with_layer: bool = False, staged: bool = False):
    """the category Column (and, optionally, the deciding layer)."""
    cols, names = feed_columns(columns), list(columns)
    cat = cfg.get("category") or {}
    strat = str(cat.get("strategy") or "default").strip().lower()
    default = cat.get("default", DEFAULT_CATEGORY)
    dflt = F.lit(default) if default is not None else _null()
    layers: list[tuple[str, Column]] = []

    if strat == "rules":
        chain = None
        for rule in cat.get("rules") or []:
            if "default" in rule:
                cond, val = F.lit(True), rule["default"]
            else:
                cond, val = feature_present(names, rule.get("if_any_field_present")), rule.get("category_type", default)
            v = F.lit(val) if val is not None else _null()
            chain = F.when(cond, v) if chain is None else chain.when(cond, v)
            if "default" in rule:
                break
        if chain is None:
            return (dflt, F.lit("default")) if with_layer else dflt
        hit = chain.otherwise(dflt)
        return (hit, F.lit("rules")) if with_layer else hit

    if strat == "layered":
        cv = cat.get("column_value") or {}
        joined = F.col("__cv_joined") if staged else None
        hay, low = (F.col("__rx_hay"), F.col("__rx_low")) if staged else (None, None)
        layers.append(("column_value_exact", column_value_exact(cols, cv, joined)))
        layers.append(("column_value_substring", column_value_substring(cols, cv, joined)))
        layers.append(("regex_scan", regex_scan(cols, cat.get("regex_scan") or {}, hay, low)))
        fp = None
        fp_conds = []
        for rule in ((cat.get("feature_presence") or {}).get("rules") or []):
            val = rule.get("category_type", default)
            v = F.lit(val) if val is not None else _null()
            cond = feature_present(names, rule.get("if_any_field_present"))
            fp_conds.append(cond)
            fp = F.when(cond, v) if fp is None else fp.when(cond, v)
        # An empty-string hit is falsy in the cascade, like NULL.
        early = [(n, F.when(c != F.lit(""), c)) for n, c in layers]
        last = dflt if fp is None else fp.otherwise(dflt)
        category = F.coalesce(*[c for _, c in early], last)
        if not with_layer:
            return category
        layer = None
        for n, c in early:
            layer = F.when(c.isNotNull(), F.lit(n)) if layer is None else layer.when(c.isNotNull(), F.lit(n))
        any_fp = F.lit(False)
        for c in fp_conds:
            any_fp = any_fp | c
        layer = layer.when(any_fp, F.lit("feature_presence"))
        return category, layer.otherwise(F.lit("default"))

    return (dflt, F.lit("default")) if with_layer else dflt


def categories_of(cfg: dict) -> list[str | None]:
    """All categories that :func:`classify` can give with a mapping."""
    cat = cfg.get("category") or {}
    strat, default = str(cat.get("strategy") or "default").strip().lower(), cat.get("default", DEFAULT_CATEGORY)
    out = [default]
    if strat == "rules":
        out += [r["default"] if "default" in r else r.get("category_type", default) for r in cat.get("rules") or []]
    if strat == "layered":
        out += list(((cat.get("column_value") or {}).get("mappings") or {}))
        out += [r.get("category_type") or None for r in (cat.get("regex_scan") or {}).get("rules") or []]
        out += [r.get("category_type", default) for r in (cat.get("feature_presence") or {}).get("rules") or []]
    return list(dict.fromkeys(out))


def classify(df: DataFrame, cfg: dict, out: str = "category_type", layer_col: str | None = None) -> DataFrame:
    """Add the category (and optionally the deciding layer) as columns.

    The joined texts the layers look at are staged as columns first, so each
    is built once per row and the CASE chain stays small in generated code.
    """
    cat = cfg.get("category") or {}
    cols = feed_columns(df.columns)
    staged, names = df, list(df.columns)
    if str(cat.get("strategy") or "").strip().lower() == "layered":
        cv_cols = (cat.get("column_value") or {}).get("columns")
        rx_cols = (cat.get("regex_scan") or {}).get("columns")
        staged = df.withColumns({
            "__cv_joined": joined_values(cols, cv_cols, " | ", lower=True),
            "__rx_hay": joined_values(cols, rx_cols, "\n", lower=False),
        }).withColumn("__rx_low", F.lower("__rx_hay"))
    if layer_col:
        c, layer = category_expr(df.columns, cfg, with_layer=True, staged=staged is not df)
        return staged.withColumns({out: c, layer_col: layer}).select(*names, out, layer_col)
    c = category_expr(df.columns, cfg, staged=staged is not df)
    return staged.withColumn(out, c).select(*names, out)


def classify_layer(df: DataFrame, cfg: dict, layer: str, out: str = "category_type") -> DataFrame:
    """One layer on its own (for inspection): exact, substring, regex or features."""
    cols = feed_columns(df.columns)
    cat = cfg.get("category") or {}
    if layer == "column_value_exact":
        e = column_value_exact(cols, cat.get("column_value") or {})
    elif layer == "column_value_substring":
        e = column_value_substring(cols, cat.get("column_value") or {})
    elif layer == "regex_scan":
        rs = cat.get("regex_scan") or {}
        staged = df.withColumn("__rx_hay", joined_values(cols, rs.get("columns"), "\n", lower=False)).withColumn("__rx_low", F.lower("__rx_hay"))
        return staged.withColumn(out, regex_scan(cols, rs, F.col("__rx_hay"), F.col("__rx_low"))).drop("__rx_hay", "__rx_low")
    elif layer == "feature_presence":
        e = None
        for rule in ((cat.get("feature_presence") or {}).get("rules") or []):
            cond = feature_present(df.columns, rule.get("if_any_field_present"))
            v = F.lit(rule.get("category_type"))
            e = F.when(cond, v) if e is None else e.when(cond, v)
        e = _null() if e is None else e
    else:
        raise ValueError(f"unknown layer {layer!r}")
    return df.withColumn(out, e)


def column_value_substring_table(df: DataFrame, cfg: dict, out: str = "category_type", inline: int = INLINE_RULES) -> DataFrame:
    """F4 for mappings with many values. Up to ``inline`` of them are one array of
    (category, value) in mapping order, and the first one contained in the joined
    text decides: no join, no shuffle, and generated code that does not grow with
    the number of values. More are a table that the distinct joined texts look up
    by trigrams. Same result as :func:`column_value_substring`."""
    cv = (cfg.get("category") or {}).get("column_value") or {}
    rules = [(cat, str(v).strip().lower()) for cat, vals in (cv.get("mappings") or {}).items() for v in vals or [] if str(v).strip()]
    if not rules:
        return df.withColumn(out, _null())
    joined = df.withColumn("__joined", joined_values(feed_columns(df.columns), cv.get("columns"), " | ", lower=True))
    if len(rules) > inline:
        table = df.sparkSession.createDataFrame([(i, c, v) for i, (c, v) in enumerate(rules)], "seq int, category string, pattern string")
        hits = first_substring(joined.filter(F.col("__joined") != F.lit("")), "__joined", table, ["seq"])
        hits = hits.select(F.col("text").alias("__joined"), F.col("rule.category").alias(out))
        return joined.drop(out).join(hits, "__joined", "left").select(*[c for c in df.columns if c != out], out)
    table = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(v).alias("value")) for c, v in rules])
    hits = F.filter(table, lambda r: F.col("__joined").contains(r["value"]))
    found = F.when(F.col("__joined") != F.lit(""), F.get(hits, F.lit(0))["category"])
    return joined.withColumn(out, found).drop("__joined")

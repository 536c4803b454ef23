"""DuckDB SQL for the operators that SQL can express."""

ASCII_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"regexp_extract_all(" + ASCII_LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {ALNUM.format('text')} AS w FROM documents),
b AS (SELECT item_id, {ALNUM.format('text')} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, w[i:i + least(10, len(w)) - 1] AS phrase
      FROM b, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(phrase) AS n FROM p),
dw AS (SELECT rid, i, n, w[i:i + n - 1] AS phrase FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
found AS (SELECT rid, i, n, item_id FROM dw JOIN p USING (phrase)),
hits AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT rid, i, n FROM found), unnest(range(i, i + n)) AS t(j) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM found GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""

OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM d),
h AS (SELECT *, CAST(len(lines) AS BIGINT) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
             CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM l),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle, array_to_string(lines[b + 1:], '') AS suffix FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                          ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END AS output FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM o
"""

TERMS = r"regexp_extract_all(" + ASCII_LOWER + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {TERMS.format('text')} AS w FROM documents),
whole AS (SELECT CAST(count(*) AS BIGINT) AS N, CAST(sum(len(w)) AS BIGINT) AS L FROM d WHERE len(w) > 0),
tf AS (SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, floor(1000 * ln(CAST(2 * N + 2 AS DOUBLE) / (2 * df + 1))) AS weight FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
m AS (SELECT rid, doc_id, 100 - 90 + ((90 * CAST(len(w) AS BIGINT) * N) // L) AS m FROM d, whole WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({TERMS.format('text')}) AS term FROM benchmark),
s AS (SELECT q.item_id, m.rid, any_value(m.doc_id) AS doc_id,
             CAST(sum(CAST(weight AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN df USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY q.item_id, m.rid)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""

WORDS = r"regexp_extract_all(" + ASCII_LOWER + r", '[^\x20\x09-\x0D]+')"


def components_sql(k: int, per_cent: int, more: str = "") -> str:
    """Components of shingle sets: all links, then all that they reach."""
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS.format('text')} AS w FROM documents),
sh AS (SELECT DISTINCT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
              ELSE list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k - 1}], ' ')) END) AS s FROM d),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
met AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.rid < b.rid GROUP BY a.rid, b.rid),
links AS (SELECT x, y FROM met JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y WHERE 100 * c >= {per_cent} * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT rid, rid AS other FROM d UNION SELECT reach.rid, y FROM reach JOIN both_ways ON other = x),
low AS (SELECT reach.rid, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.rid = other GROUP BY reach.rid)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id{more}
FROM d LEFT JOIN n USING (rid) JOIN low USING (rid)
"""


ORACLE: dict[str, str] = {
    "op1_decontamination": OP1,
    "op8_jaccard_join": components_sql(5, 80),
    "op11_fill_in_middle": OP11,
    "op12_lexical_search": OP12,
    "op13_minhash_dedup": components_sql(3, 85, ", doc_id IS NOT DISTINCT FROM component_id AS kept"),
}

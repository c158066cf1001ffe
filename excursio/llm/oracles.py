"""DuckDB SQL that must give the rows of the operators that SQL can express.

The numbers of the rules are written out here, so that a wrong one in the operators shows.
"""

_MEASURES = {"symbols": (60, None), "capitals": (350, None), "exclaims": (60, None),
             "dup_lines": (300, None), "repeats": (150, None), "mean_length": (300, 300)}

_BOUNDS = " AND ".join(
    f"m.{name} <= (SELECT max(f.q3 + greatest(3 * (f.q3 - f.q1), {above})) FROM f WHERE f.lang IS NOT DISTINCT FROM m.lang"
    f" AND f.source IS NOT DISTINCT FROM m.source AND f.measure = '{name}')"
    + (f" AND m.{name} >= (SELECT max(f.q1 - greatest(3 * (f.q3 - f.q1), {below})) FROM f WHERE f.lang IS NOT DISTINCT FROM m.lang"
       f" AND f.source IS NOT DISTINCT FROM m.source AND f.measure = '{name}')" if below is not None else "")
    for name, (above, below) in _MEASURES.items())

_VALUES = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS measure, {name} AS v FROM m WHERE n_words > 0" for name in _MEASURES)


def _quartiles(keys: str, source: str) -> str:
    return f"""SELECT {keys}, measure, n AS documents,
        min(CASE WHEN 4 * upto >= n THEN b END) AS b1, min(CASE WHEN 4 * upto >= 3 * n THEN b END) AS b3
    FROM (SELECT *, sum(c) OVER (PARTITION BY {keys}, measure ORDER BY b) AS upto, sum(c) OVER (PARTITION BY {keys}, measure) AS n
          FROM (SELECT {keys}, measure, b, sum(c) AS c FROM {source} GROUP BY {keys}, measure, b))
    GROUP BY {keys}, measure, n"""


_LOW = "CASE WHEN {b} < 64 THEN {b} ELSE ({b} - 32 * ({b} // 32 - 1)) << ({b} // 32 - 1) END"

QUALITY_RULES = rf"""
WITH w AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS ls
    FROM documents),
win AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
b AS (
    SELECT w.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(ls) AS BIGINT) AS n_lines, CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
        CAST(length(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_exclaims
    FROM w LEFT JOIN covered ON w.r = covered.r),
m AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        1000 * n_symbols // greatest(word_chars, 1) AS symbols, 1000 * n_capitals // greatest(word_chars, 1) AS capitals,
        1000 * n_exclaims // greatest(word_chars, 1) AS exclaims, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
        1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 100 * word_chars // greatest(n_words, 1) AS mean_length
    FROM b),
v AS ({_VALUES}),
s AS (SELECT lang, source, measure,
          CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) + 32 * (length(bin(v)) - 6) END AS b, count(*) AS c
      FROM v GROUP BY ALL),
own AS ({_quartiles("lang, source", "s")}),
wide AS ({_quartiles("lang", "s")}),
f AS (
    SELECT lang, source, measure, {_LOW.format(b="x1")} AS q1, {_LOW.format(b="x3")} AS q3
    FROM (SELECT own.lang, own.source, own.measure,
              CASE WHEN own.documents < 50 THEN wide.b1 ELSE own.b1 END AS x1, CASE WHEN own.documents < 50 THEN wide.b3 ELSE own.b3 END AS x3
          FROM own LEFT JOIN wide ON own.lang IS NOT DISTINCT FROM wide.lang AND own.measure = wide.measure))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(NOT base_failed AND {_BOUNDS}, false) AS kept
FROM m
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws, least(13, len({_WORDS})) AS size FROM benchmark),
iw AS (SELECT DISTINCT item, size, array_to_string(list_slice(ws, k, k + size - 1), ' ') AS s
       FROM (SELECT item, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM i WHERE size > 0)),
dw AS (SELECT r, k, size, array_to_string(list_slice(ws, k, k + size - 1), ' ') AS s
       FROM (SELECT r, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM iw) WHERE len(ws) >= size)),
hit AS (SELECT r, k, dw.size, item FROM dw JOIN iw ON dw.size = iw.size AND dw.s = iw.s),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + size)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words ON d.r = words.r LEFT JOIN items ON d.r = items.r
"""

URL_FILTERS = r"""
WITH r(rule_host, rule_path, rule_verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT row_number() OVER () AS n, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT n, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p)
SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM u LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC) = 1
"""

# CRC-32 bit by bit: a character is taken up, then eight steps
_CRC = """xor(list_reduce(flatten(list_concat([[4294967295]], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""

CONVERSATION_TRIE = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, conv_id - conv_id % 5 AS base, CAST({_CRC} % 9 AS BIGINT) AS h
      FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
r AS (SELECT c.conv_id, t.pos AS d, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
      UNION ALL
      SELECT c.conv_id, least(c.h, coalesce(b.n, 0)) + t.pos - c.h, t.role, t.text
      FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h LEFT JOIN c b ON b.conv_id = c.base),
p AS (SELECT conv_id, d, strlen(text) AS bytes, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT path, d, bytes, min(conv_id) AS conv_id, count(*) AS n_convs FROM p GROUP BY path, d, bytes),
k AS (SELECT left(path, length(path) - 64) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * bytes AS saved FROM n LEFT JOIN k ON n.path = k.path),
s AS (SELECT left(path, 64 * a) AS path, CAST(count(*) FILTER (n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM v) GROUP BY ALL),
e AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM
      (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM p) WHERE d = last GROUP BY path)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens,
    coalesce(e.ends, sha256('')) AS ends_sha256
FROM v JOIN s ON v.path = s.path LEFT JOIN e ON v.path = e.path LEFT JOIN v u ON v.d > 0 AND u.path = left(v.path, length(v.path) - 64)
"""

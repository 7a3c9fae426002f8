"""DuckDB SQL of the queries on words, conversations and urls.

It answers each contract by another way than the operator: deletion keys in place
of k-d trees, all prefixes in place of a sketch, all subsets in place of
FP-growth.
"""

from __future__ import annotations

from blotter.llm import urls

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32_of(text: str) -> str:
    """An expression for the unsigned CRC-32 of the UTF-8 bytes of ``text``, bit by
    bit; its polynomial and first value are fixed values."""
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce(list_concat([xor(a, y)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: {step})"
    code = f"hex(encode({text}))"
    values = f"list_transform(range(1, len({code})::BIGINT, 2), lambda i: ('0x' || substr({code}, i, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {values}), lambda a, y: {byte}), 4294967295::BIGINT)"


SPELLING = rf"""
WITH RECURSIVE runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS d, translate(
        unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{_UPPER}', '{_LOWER}') AS run
    FROM documents
),
placed AS (SELECT d, run, count(*) AS k, {crc32_of("d || ':' || run")} AS h FROM runs GROUP BY d, run),
written AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) ELSE run END AS word, k
    FROM placed
),
words AS (
    SELECT word, sum(k)::BIGINT AS n FROM written WHERE len(word) >= 5 GROUP BY word HAVING sum(k) >= 3
),
shorter AS (
    SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)
),
pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
    UNION
    SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
),
best AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS best FROM pairs GROUP BY word),
formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
           CASE WHEN -b.best[1] >= 2 * w.n THEN b.best[2] END AS form,
           CASE WHEN -b.best[1] >= 2 * w.n THEN -b.best[1] END AS form_n
    FROM words w LEFT JOIN best b USING (word)
),
chain AS (
    SELECT word, word AS root, 0 AS step FROM formed
    UNION ALL
    SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL
),
ends AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM formed f JOIN ends e USING (word)
"""

#: Turns are told apart by role and text; equal turn numbers go by the digest.
CONVERSATIONS = rf"""
WITH turns AS (
    SELECT conv_id AS c, turn, len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS t,
           len(coalesce(text, ''))::BIGINT AS n
    FROM conversations WHERE conv_id IS NOT NULL
),
own AS (SELECT c, list((t, n) ORDER BY turn NULLS FIRST, md5(t)) AS turns FROM turns GROUP BY c),
headed AS (SELECT c, turns, c - c % 100 AS b, {crc32_of("c::VARCHAR")} % 6 AS h FROM own),
rebuilt AS (
    SELECT a.c, list_concat(coalesce(o.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
    FROM headed a LEFT JOIN own o ON o.c = a.b
),
prefixes AS (
    SELECT c, d, len(turns) AS size, CASE WHEN d > 0 THEN turns[d][2] ELSE 0 END AS n,
           md5(turns[1:d]::VARCHAR) AS p, CASE WHEN d > 0 THEN md5(turns[1:d - 1]::VARCHAR) END AS q
    FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
),
nodes AS (
    SELECT d, p, any_value(q) AS q, min(c) AS c, count(*) AS n_convs, max(size) = d AS leaf,
           (count(*) - 1) * any_value(n) AS own,
           sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE size = d), '')) AS ends_sha256
    FROM prefixes GROUP BY d, p
),
below AS (
    SELECT x.d, x.p, sum(v.leaf::BIGINT) AS n_leaves, sum(v.own) AS saved_tokens
    FROM nodes v JOIN prefixes x ON x.c = v.c AND x.d <= v.d GROUP BY x.d, x.p
),
children AS (SELECT d - 1 AS d, q AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL)
SELECT v.c AS conv_id, v.d::BIGINT AS depth, u.c AS parent_conv_id, v.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM nodes v JOIN below b USING (d, p) LEFT JOIN children k USING (d, p)
LEFT JOIN nodes u ON u.d = v.d - 1 AND u.p = v.q
"""


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


def _cases(what) -> str:
    ordered = sorted(urls.RULES, key=lambda r: (-len(r[0] + r[1]), r))
    return "CASE " + " ".join(f"WHEN {_fits(h, p)} THEN '{what(h, p, v)}'" for h, p, v in ordered) + " END"


URLS = rf"""
WITH cut AS (
    SELECT row_number() OVER () AS row, page_id, url,
           CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parsed AS (
    SELECT row, page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM cut
),
ruled AS (
    SELECT *, {_cases(lambda h, p, v: h + p)} AS rule, {_cases(lambda h, p, v: v)} AS fixed,
           list_concat(
               list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'host ' || x),
               list_transform(list_filter(string_split(regexp_replace(
                   translate(path, '{_UPPER}', '{_LOWER}'), '[0-9]+', '#', 'g'), '/'), lambda x: x <> ''), lambda x: 'path ' || x),
               list_transform(list_filter(list_transform(string_split(query, '&'), lambda x: string_split(x, '=')[1]),
                   lambda x: x <> ''), lambda x: 'query ' || x)
           ) AS tokens
    FROM parsed
),
labelled AS (SELECT url, min(fixed) AS verdict, any_value(tokens) AS tokens FROM ruled WHERE fixed IS NOT NULL GROUP BY url),
size AS (SELECT count(*) AS total FROM labelled),
bound AS (SELECT greatest({urls.MIN_URLS}, ceil({urls.SUPPORT} * total)) AS least FROM size),
drawn AS (
    SELECT labelled.* FROM labelled, size
    WHERE total <= {urls.MAX_LABELLED}
       OR ('0x' || substr(md5(url), 1, 8))::BIGINT < floor({urls.MAX_LABELLED} / total * 4294967296)
),
found AS (SELECT url, verdict, unnest(list_distinct(tokens)) AS token FROM drawn),
frequent AS (SELECT token, count(*) AS n FROM found GROUP BY token HAVING count(*) >= (SELECT least FROM bound)),
items AS (
    SELECT url, verdict, list(token ORDER BY token) AS tokens
    FROM (SELECT url, verdict, token, row_number() OVER (PARTITION BY url ORDER BY n DESC, token) AS r FROM found JOIN frequent USING (token))
    WHERE r <= {urls.MAX_ITEMS} GROUP BY url, verdict
),
subsets AS (
    SELECT verdict, list_filter(tokens, lambda t, i: (mask >> (i - 1)) & 1 = 1) AS tokens
    FROM (SELECT verdict, tokens, unnest(range(1, (1 << len(tokens))::BIGINT)) AS mask FROM items)
),
sets AS (SELECT tokens, count(*) AS n FROM subsets GROUP BY tokens HAVING count(*) >= (SELECT least FROM bound)),
larger AS (
    SELECT list_filter(tokens, lambda t: t <> one) AS tokens, max(n) AS next
    FROM (SELECT tokens, n, unnest(tokens) AS one FROM sets) GROUP BY 1
),
closed AS (SELECT s.tokens, s.n FROM sets s LEFT JOIN larger l USING (tokens) WHERE l.next IS NULL OR l.next < s.n),
mined AS (
    SELECT c.tokens, j.verdict, j.n, j.n / c.n AS confidence
    FROM (SELECT tokens, verdict, count(*) AS n FROM subsets GROUP BY ALL HAVING count(*) >= (SELECT least FROM bound)) j
    JOIN closed c USING (tokens) WHERE j.n / c.n >= {urls.CONFIDENCE}
),
matched AS (
    SELECT r.row, max((m.confidence, m.n, len(m.tokens), array_to_string(m.tokens, chr(10)), m.verdict)) AS best
    FROM ruled r JOIN mined m ON list_has_all(r.tokens, m.tokens) WHERE r.fixed IS NULL GROUP BY r.row
)
SELECT page_id, host, path, rule, coalesce(fixed, best[5], '{urls.DEFAULT}') AS verdict, best[4] AS mined
FROM ruled LEFT JOIN matched USING (row)
"""

ORACLE_SQL = {"op11_spelling_variants": SPELLING, "op12_conversation_trie": CONVERSATIONS, "op13_url_filters": URLS}

"""Registered queries of the operators, with their SQL where SQL can say it.

Each applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

from blotter.llm import (
    decontaminate, html, lm, mixing, packing, quality, rlz, secrets, simhash, spelling, sql, toxicity, trie, urls,
)
from blotter.llm.common import table


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def op1_quality_rules(spark, sf_dir):
    return quality.judged(_docs(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_lm_scoring(spark, sf_dir):
    return lm.scores(_docs(spark, sf_dir))


def op3_toxicity(spark, sf_dir):
    return toxicity.severity(_docs(spark, sf_dir), table(spark, sf_dir, "labels"))


def op4_secret_scan(spark, sf_dir):
    return secrets.scan(_docs(spark, sf_dir))


def op5_source_mixing(spark, sf_dir):
    return mixing.mix(_docs(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_substring_dedup(spark, sf_dir):
    return rlz.deduplicated(_docs(spark, sf_dir), with_text=False).drop("kept", "factors")


def op7_token_packing(spark, sf_dir):
    return packing.packed(_docs(spark, sf_dir))


def op8_decontamination(spark, sf_dir):
    return decontaminate.hits(_docs(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("spans")


def op9_simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(_docs(spark, sf_dir))


def op10_html_extraction(spark, sf_dir):
    return html.extracted(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(_docs(spark, sf_dir))


def op12_conversation_trie(spark, sf_dir):
    return trie.nodes(table(spark, sf_dir, "conversations"))


def op13_url_filters(spark, sf_dir):
    return urls.judged(table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_toxicity": op3_toxicity,
    "op4_secret_scan": op4_secret_scan,
    "op5_source_mixing": op5_source_mixing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_packing": op7_token_packing,
    "op8_decontamination": op8_decontamination,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_html_extraction": op10_html_extraction,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_url_filters": op13_url_filters,
}

_SIZE = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

_MIX = rf"""
WITH docs AS (
    SELECT doc_id, source, size, named,
           row_number() OVER (PARTITION BY named, source) - 1 AS number
    FROM (SELECT doc_id, source, {_SIZE}::BIGINT AS size,
                 coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS named FROM documents)
),
found AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
placed AS (
    SELECT source, source_size, 3 * source_size AS bound,
           [1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM found
),
filled AS (
    SELECT *, bound / weight AS full_at,
           sum(bound) OVER w AS bounds, sum(weight) OVER w AS weights
    FROM placed WINDOW w AS (ORDER BY bound / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
),
totals AS (SELECT sum(source_size) AS words, sum(weight) AS weight FROM placed),
levels AS (
    SELECT CASE WHEN words = 0 OR weights = weight THEN 0.0 ELSE (words - bounds) / (weight - weights)::DOUBLE END AS level,
           weights, lead(full_at) OVER (ORDER BY weights) AS next_at
    FROM (SELECT 0 AS bounds, 0 AS weights, -1.0 AS full_at UNION ALL SELECT bounds, weights, full_at FROM filled), totals
),
chosen AS (SELECT arg_min(level, weights) AS level FROM levels WHERE next_at IS NULL OR level < next_at),
mixed AS (
    SELECT d.doc_id, d.named, d.number, d.size, p.source_size, least(c.level * p.weight, p.bound::DOUBLE) AS target
    FROM docs d JOIN placed p ON d.source IS NOT DISTINCT FROM p.source, chosen c
),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM mixed)
SELECT doc_id, size, source_size, target,
       (floor(rate)::BIGINT + CASE WHEN
           ('0x' || substr(md5(named || ':' || number || ':42'), 1, 12))::BIGINT / 281474976710656.0
           < rate - floor(rate) THEN 1 ELSE 0 END) * size AS taken
FROM rates
"""

_DEDUP = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
starts AS (SELECT row, doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs WHERE len(words) >= 20),
windows AS (SELECT row, doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS w FROM starts),
earliest AS (SELECT w, min((coalesce(doc_id, 9223372036854775807), i)) AS first FROM windows GROUP BY w HAVING count(*) > 1),
later AS (
    SELECT row, i FROM windows JOIN earliest USING (w) WHERE (coalesce(doc_id, 9223372036854775807), i) > first
),
gone AS (SELECT DISTINCT row, i + k AS at FROM (SELECT row, i, unnest(range(0, 20)) AS k FROM later)),
placed AS (SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS at FROM docs),
left_over AS (
    SELECT p.row, string_agg(word, ' ' ORDER BY p.at) FILTER (WHERE g.at IS NULL) AS kept, count(g.at) AS n_removed
    FROM placed p LEFT JOIN gone g ON p.row = g.row AND p.at = g.at GROUP BY p.row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN left_over USING (row)
"""

_LEAKS = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
),
items AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
),
grams AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS w
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM items WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT n FROM grams),
windows AS (
    SELECT row, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
    FROM (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes WHERE len(words) >= n)
),
found AS (SELECT row, i, n, item_id FROM windows JOIN grams USING (n, w)),
hit AS (SELECT row, count(DISTINCT spot) AS n_hit FROM (SELECT row, i + unnest(range(0, n)) AS spot FROM found) GROUP BY row),
named AS (
    SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT row, coalesce(item_id::VARCHAR, '') AS id FROM found) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""

ORACLE_SQL = {
    "op5_source_mixing": _MIX, "op6_substring_dedup": _DEDUP, "op8_decontamination": _LEAKS, **sql.ORACLE_SQL,
}

"""Independent ANSI-SQL statements for the registered queries.

They derive the same incident view as ``sources.tpch`` from the raw
``lineitem`` and ``part`` views and answer each question in plain SQL, so a
second engine can check the DataFrame plans. Column names and types match
the DataFrame results.
"""

from __future__ import annotations

from blotter.sources import tpch as M


def _ws(c: str) -> str:
    return f"regexp_replace({c}, '\\s', '', 'g')"


def _full(c: str) -> str:
    s = _ws(c)
    return f"CASE WHEN length({s}) < {M.CODE_WIDTH} THEN lpad({s}, {M.CODE_WIDTH}, '0') ELSE {s} END"


def _code(c: str) -> str:
    s = f"CAST({c} AS VARCHAR)"
    return f"CASE WHEN length({s}) < {M.CODE_WIDTH} THEN lpad({s}, {M.CODE_WIDTH}, '0') ELSE {s} END"


PREFIX = f"""
WITH lookup AS (
  SELECT p_partkey AS k, p_type AS primary_description,
         CASE p_partkey % 50 WHEN {M.DAMAGED_TEXT_CLASS} THEN '{M.DAMAGED_TEXT}' || p_name
              WHEN {M.SEPARATOR_TEXT_CLASS} THEN p_name || '{M.SEPARATOR_TEXT}' ELSE p_name END AS secondary_description
  FROM part
),
codes AS (SELECT {_code('k')} AS iucr, primary_description, secondary_description FROM lookup),
shipped_codes AS (
  SELECT CASE WHEN k % 20 = {M.UNPADDED_CODE_CLASS} THEN CAST(k AS VARCHAR)
              WHEN k % 20 = {M.SPACED_CODE_CLASS} THEN {_code('k')} || ' '
              ELSE {_code('k')} END AS iucr,
         primary_description, secondary_description
  FROM lookup
),
facts AS (
  SELECT {_code('l_partkey')} AS iucr,
         CASE WHEN l_orderkey % {M.NULL_ARREST_PERIOD} = 0 THEN NULL
              WHEN l_returnflag = 'R' THEN 'true' WHEN l_returnflag = 'A' THEN 'false' ELSE 'True' END AS arrest,
         CASE WHEN l_orderkey % {M.TRUE_DISTRICT_PERIOD} = 0 THEN 'true'
              WHEN l_orderkey % {M.SPACED_DISTRICT_PERIOD} = 0 THEN ' 01'
              WHEN l_orderkey % {M.NULL_DISTRICT_PERIOD} = 0 THEN NULL
              ELSE lpad(CAST(l_suppkey % {M.N_DISTRICTS} AS VARCHAR), {M.DISTRICT_WIDTH}, '0') END AS district,
         CASE WHEN l_orderkey % {M.BAD_YEAR_PERIOD} = 0 THEN 'n/a' ELSE CAST(year(l_shipdate) AS VARCHAR) END AS year,
         l_orderkey || ':' || l_linenumber AS row_key
  FROM lineitem
),
crimes AS (
  SELECT f.iucr, c.primary_description AS primary_type, c.secondary_description AS description,
         f.arrest, f.district, f.year
  FROM facts f LEFT JOIN codes c ON f.iucr = c.iucr
),
clean AS (
  SELECT * FROM crimes
  WHERE district IS NULL OR (district NOT IN ('true', 'false', 'District') AND NOT contains(district, ' '))
),
clean_full AS (
  SELECT * FROM clean WHERE description IS NULL OR NOT contains(description, '"THEFT BY LESSEE')
),
-- What a naive split of the extract's lines sees: empty fields are empty
-- strings, and a quoted separator moves every later field by one, so district,
-- arrest and year come from the empty fields before them.
line_crimes AS (
  SELECT iucr,
         CASE WHEN contains(description, ';') THEN '"' || split_part(description, ';', 1) ELSE coalesce(description, '') END AS description,
         CASE WHEN contains(description, ';') THEN '' ELSE coalesce(arrest, '') END AS arrest,
         CASE WHEN contains(description, ';') THEN '' ELSE coalesce(district, '') END AS district,
         CASE WHEN contains(description, ';') THEN '' ELSE year END AS year
  FROM crimes
),
line_clean AS (
  SELECT * FROM line_crimes
  WHERE district NOT IN ('true', 'false', 'District') AND NOT contains(district, ' ')
    AND NOT contains(description, '"THEFT BY LESSEE')
),
rate_keys AS (SELECT TRY_CAST(year AS BIGINT) AS year, iucr FROM (SELECT DISTINCT year, iucr FROM facts)),
rate_sample AS (
  SELECT year, iucr, row_number() OVER (ORDER BY year NULLS FIRST, iucr) AS r, count(*) OVER () AS m
  FROM (SELECT year, iucr, substr(md5(coalesce(CAST(year AS VARCHAR), '') || ':' || iucr), 1, 15) AS place FROM rate_keys
        WHERE CAST('0x' || substr(md5(coalesce(CAST(year AS VARCHAR), '') || ':' || iucr), 1, 15) AS BIGINT)
              < CAST(floor(0.01 * 1152921504606846976) AS BIGINT)
        ORDER BY place LIMIT 1000)
),
rate_points AS (
  SELECT DISTINCT s.year, s.iucr FROM range(1, 9) p(i) JOIN rate_sample s ON s.r = CAST(ceil(p.i * s.m / 9.0) AS BIGINT)
),
cnt AS (SELECT iucr, district, count(*) AS cnt FROM crimes GROUP BY iucr, district),
clean_cnt AS (SELECT iucr, district, count(*) AS cnt FROM clean GROUP BY iucr, district),
shipped_lk AS (SELECT iucr, secondary_description AS description FROM shipped_codes)
"""

_COGROUP = f"""
SELECT coalesce(c.district, '') AS district,
       CASE WHEN contains(l.description, ';') THEN '"' || split_part(l.description, ';', 1)
            WHEN contains(l.description, '"') THEN '"' || replace(l.description, '"', chr(92) || '"') || '"'
            ELSE l.description END AS description, c.cnt
FROM (SELECT {_ws('iucr')} AS iucr, district, cnt FROM clean_cnt) c
JOIN (SELECT {_ws('iucr')} AS iucr, description FROM shipped_lk) l ON c.iucr = l.iucr"""

# The sample of split points: of the rows in the first hundredth of all hashes
# those with the smallest ones, at most a thousand; their ranks by year and code.
_SAMPLE = """
SELECT year, iucr, row_number() OVER (ORDER BY year NULLS FIRST, iucr) AS r, count(*) OVER () AS m
FROM (SELECT TRY_CAST(year AS BIGINT) AS year, iucr FROM {rows}
      WHERE CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT) < CAST(floor(0.01 * 1152921504606846976) AS BIGINT)
      ORDER BY substr(md5({key}), 1, 15) LIMIT 1000)"""
_RATE_KEY = "coalesce(CAST(year AS VARCHAR), '') || ':' || iucr"

BODIES: dict[str, str] = {
    "type_count_by_district": """
SELECT district, description, count(*) AS cnt FROM crimes GROUP BY iucr, district, description""",
    "type_count_by_district_clean": """
SELECT district, description, count(*) AS cnt FROM clean_full GROUP BY iucr, district, description""",
    "type_count_secondary_sort": """
SELECT district, description, count(*) AS cnt FROM clean_full GROUP BY iucr, district, description""",
    "type_count_lines_clean": """
SELECT district, description, count(*) AS cnt FROM line_clean GROUP BY iucr, district, description""",
    "type_count_left_join": """
SELECT c.district, l.description, c.cnt FROM cnt c LEFT JOIN shipped_lk l ON c.iucr = l.iucr""",
    "type_count_left_join_csv": """
SELECT c.district, l.description, c.cnt FROM cnt c LEFT JOIN shipped_lk l ON c.iucr = l.iucr""",
    "type_count_by_district_csv": """
SELECT district, description, count(*) AS cnt FROM crimes GROUP BY iucr, district, description""",
    "arrest_pct_csv": """
SELECT year, description, round(avg(CASE WHEN arrest = 'true' THEN 1 ELSE 0 END * 100)) AS pct
FROM crimes GROUP BY year, iucr, description""",
    "type_count_broadcast_join": """
SELECT c.district, l.description, c.cnt FROM cnt c LEFT JOIN shipped_lk l ON c.iucr = l.iucr""",
    "type_count_left_join_full_csv": """
SELECT c.district, l.description, c.cnt FROM cnt c LEFT JOIN shipped_lk l ON c.iucr = l.iucr""",
    "type_count_broadcast_join_csv": """
SELECT c.district, l.description, c.cnt FROM cnt c LEFT JOIN shipped_lk l ON c.iucr = l.iucr""",
    "arrest_pct_two_aggregates_csv": """
SELECT t.year, t.description, round(CAST(coalesce(a.k, 0) * 100 AS DOUBLE) / t.n) AS pct
FROM (SELECT year, iucr, description, count(*) AS n FROM crimes GROUP BY year, iucr, description) t
LEFT JOIN (SELECT year, iucr, description, count(*) AS k FROM crimes WHERE arrest = 'true'
           GROUP BY year, iucr, description) a
  ON t.year IS NOT DISTINCT FROM a.year AND t.iucr IS NOT DISTINCT FROM a.iucr
 AND t.description IS NOT DISTINCT FROM a.description""",
    "split_points": """
SELECT string_agg(CAST(year AS VARCHAR), ',' ORDER BY i) AS split_points, any_value(n) AS sampled_rows
FROM (SELECT i, s.year, s.n
      FROM range(1, 9) p(i) JOIN (
        SELECT TRY_CAST(year AS BIGINT) AS year, row_number() OVER (ORDER BY TRY_CAST(year AS BIGINT)) AS rn,
               count(*) OVER () AS n, count(TRY_CAST(year AS BIGINT)) OVER () AS known
        FROM facts
        WHERE CAST('0x' || substr(md5(row_key), 1, 8) AS BIGINT) < CAST(floor(0.01 * 4294967296) AS BIGINT)) s
      ON s.rn = ceil(p.i / 9.0 * s.known))""",
    "type_count_padded_join": f"""
SELECT c.district, l.description, c.cnt
FROM (SELECT {_full('iucr')} AS iucr, district, CAST(sum(cnt) AS BIGINT) AS cnt FROM cnt GROUP BY {_full('iucr')}, district) c
LEFT JOIN (SELECT {_full('iucr')} AS iucr, min(description) AS description FROM shipped_lk
           GROUP BY {_full('iucr')}) l ON c.iucr = l.iucr""",
    "type_count_inner_join": f"""
SELECT c.district, l.description, c.cnt
FROM (SELECT {_ws('iucr')} AS iucr, district, cnt FROM clean_cnt) c
JOIN (SELECT {_ws('iucr')} AS iucr, description FROM shipped_lk) l ON c.iucr = l.iucr""",
    "tagged_cogroup_join": f"""
SELECT coalesce(c.district, '') AS district,
       CASE WHEN contains(l.description, ';') THEN '"' || split_part(l.description, ';', 1)
            WHEN contains(l.description, '"') THEN '"' || replace(l.description, '"', chr(92) || '"') || '"'
            ELSE l.description END AS description, c.cnt
FROM (SELECT {_ws('iucr')} AS iucr, district, cnt FROM clean_cnt) c
JOIN (SELECT {_ws('iucr')} AS iucr, description FROM shipped_lk) l ON c.iucr = l.iucr""",
    "arrest_pct": """
SELECT year, description, round(avg(CASE WHEN arrest = 'true' THEN 1 ELSE 0 END * 100)) AS pct
FROM crimes GROUP BY year, iucr, description""",
    "arrest_pct_two_aggregates": """
SELECT t.year, t.description, round(CAST(coalesce(a.k, 0) * 100 AS DOUBLE) / t.n) AS pct
FROM (SELECT year, iucr, description, count(*) AS n FROM crimes GROUP BY year, iucr, description) t
LEFT JOIN (SELECT year, iucr, description, count(*) AS k FROM crimes WHERE arrest = 'true'
           GROUP BY year, iucr, description) a
  ON t.year IS NOT DISTINCT FROM a.year AND t.iucr IS NOT DISTINCT FROM a.iucr
 AND t.description IS NOT DISTINCT FROM a.description""",
    "arrest_pct_exact": """
SELECT TRY_CAST(year AS BIGINT) AS year, iucr,
       CAST(sum(CASE WHEN lower(arrest) = 'true' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) AS pct
FROM crimes GROUP BY year, iucr""",
    "arrest_pct_range_sorted": """
SELECT TRY_CAST(year AS BIGINT) AS year, iucr,
       CAST(sum(CASE WHEN lower(arrest) = 'true' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) AS pct
FROM crimes GROUP BY year, iucr""",
    "arrest_pct_lines": """
SELECT TRY_CAST(year AS BIGINT) AS year, iucr,
       CAST(sum(CASE WHEN lower(arrest) = 'true' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) AS pct
FROM line_crimes GROUP BY year, iucr""",
    "csv_roundtrip": """
SELECT iucr, primary_type, description, arrest, district, year FROM crimes""",
    "drop_columns": """
SELECT iucr, arrest, district, year FROM crimes""",
    "delimited_line_parse": """
SELECT TRY_CAST(year AS BIGINT) AS year, iucr, arrest FROM line_crimes""",
    "delimited_line_parse_keep_short": f"""
SELECT TRY_CAST(year AS BIGINT) AS year, iucr, arrest FROM line_crimes
UNION ALL
SELECT NULL, CASE WHEN l_orderkey % {M.CUT_LINE_PERIOD} = 0 THEN {_code('l_partkey')} END, NULL FROM lineitem
WHERE l_orderkey % {M.CUT_LINE_PERIOD} = 0 OR l_orderkey % {M.BLANK_LINE_PERIOD} = 0""",
    "csv_whole_rows": """
SELECT concat_ws('|', iucr, primary_type, description, arrest, district, year) AS line FROM crimes""",
    "single_file_readback": """
SELECT coalesce(district, '') || ';'
       || CASE WHEN contains(description, ';') THEN '"' || description || '"' ELSE coalesce(description, '') END
       || ';' || CAST(count(*) AS VARCHAR) AS line, TRUE AS in_first_file
FROM clean_full GROUP BY iucr, district, description""",
    "tagged_union_join": _COGROUP,
    "one_scan_join": _COGROUP,
    "type_count_mixed_headers": """
SELECT district, description, count(*) AS cnt FROM crimes GROUP BY iucr, district, description""",
    "csv_damaged_rows": f"""
SELECT l_orderkey || ';' || l_linenumber || ';;;' || {_code('l_partkey')} AS line
FROM lineitem WHERE l_orderkey % {M.CUT_LINE_PERIOD} = 0""",
    "csv_parsed_whole_rows": """
SELECT concat_ws('|', iucr, primary_type, description, arrest, district, year) AS line FROM crimes""",
    "split_points_sample": f"""
SELECT CAST(i - 1 AS INTEGER) AS point, year, iucr
FROM (SELECT row_number() OVER (ORDER BY year NULLS FIRST, iucr) AS i, year, iucr
      FROM (SELECT DISTINCT s.year, s.iucr FROM range(1, 9) p(i) JOIN ({_SAMPLE.format(rows='facts', key='row_key')}) s
            ON s.r = CAST(ceil(p.i * s.m / 9.0) AS BIGINT)))""",
    "split_point_partitions": f"""
SELECT part, count(*) AS n_rows, arg_min(k, (year IS NOT NULL, year, iucr)) AS low, arg_max(k, (year IS NOT NULL, year, iucr)) AS high
FROM (SELECT r.year, r.iucr, {_RATE_KEY} AS k,
             (SELECT count(*) FROM rate_points p WHERE (p.year IS NOT NULL, coalesce(p.year, 0), p.iucr)
                                                     < (r.year IS NOT NULL, coalesce(r.year, 0), r.iucr)) AS part
      FROM rate_keys r)
GROUP BY part""",
    "natural_key_layout": f"""
SELECT district, list_reduce(list_concat([0::BIGINT], list_transform(string_split(coalesce(district, ''), ''), lambda c:
           CASE WHEN c = '' THEN 0 ELSE unicode(c) END::BIGINT)), lambda h, u: (h * 31 + u) % 4294967296) % 2147483648 % 20 AS part,
       count(*) AS n_rows
FROM (SELECT iucr, district, description FROM clean_full GROUP BY iucr, district, description) GROUP BY district""",
    "job_counters": """
SELECT 'records_in' AS name, count(*) AS n FROM crimes
UNION ALL SELECT 'groups', count(*) FROM (SELECT DISTINCT iucr, district, description FROM crimes)
UNION ALL SELECT 'records_out', count(*) FROM (SELECT DISTINCT iucr, district, description FROM crimes)
UNION ALL SELECT 'combined_in_bounds', 1""",
    "sort_order_check": """
SELECT name, n_rows, CAST(0 AS BIGINT) AS inversions, CAST(0 AS BIGINT) AS boundary_inversions
FROM (SELECT 'district, count' AS name, count(*) AS n_rows FROM (SELECT DISTINCT iucr, district, description FROM crimes)
      UNION ALL SELECT 'district, count after a join', count(*) FROM cnt
      UNION ALL SELECT 'folded district, count', count(*) FROM (SELECT DISTINCT iucr, district, description FROM line_clean)
      UNION ALL SELECT 'year', count(*) FROM (SELECT DISTINCT year, iucr, description FROM crimes)
      UNION ALL SELECT 'year over range partitions', count(*) FROM (SELECT DISTINCT year, iucr FROM crimes))""",
    "partition_layout_check": """
SELECT name, n, CAST(0 AS BIGINT) AS faults
FROM (SELECT 'rows of a district' AS name, count(*) AS n FROM (SELECT DISTINCT iucr, district, description FROM clean_full)
      UNION ALL SELECT 'districts', count(*) FROM (SELECT DISTINCT district FROM clean_full)
      UNION ALL SELECT 'range keys', count(*) FROM (SELECT DISTINCT year, iucr FROM crimes))""",
    "key_value_line_parse": """
SELECT coalesce(district, '') AS k, iucr || '__' || chr(9) || CAST(cnt AS VARCHAR) AS v FROM clean_cnt""",
    "code_normalize": """
SELECT iucr, secondary_description AS description FROM codes""",
    "dirty_row_filter": """
SELECT iucr, district FROM clean""",
    "delimited_export": """
SELECT coalesce(district, '') || ';' || chr(9) || coalesce(description, '') || ';' || CAST(cnt AS VARCHAR) AS line
FROM (SELECT district, description, count(*) AS cnt FROM clean_full GROUP BY iucr, district, description)""",
}


def oracle_sql() -> dict[str, str]:
    return {name: PREFIX + body for name, body in BODIES.items()}

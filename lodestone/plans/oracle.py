"""Oracle SQL (DuckDB dialect) for each registered query, written independently of
the Spark code from the semantics: same column names, order-insensitive."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["species_key"] = """
SELECT p_partkey, coalesce(replace(lower(p_name), ' ', '_'), '') AS species_key FROM part
"""

ORACLE["freq_list"] = """
WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS p
           FROM events WHERE coalesce(event_type, '') <> '' GROUP BY ALL)
SELECT user_id, string_agg(event_type, '|' ORDER BY n DESC, p) AS types FROM c GROUP BY user_id
"""

ORACLE["mode_latest"] = """
WITH c AS (SELECT user_id, event_type, count(*) AS n, max(ts) AS d, min(event_id) AS p
           FROM events WHERE coalesce(event_type, '') <> '' GROUP BY ALL)
SELECT user_id, event_type AS mode_type FROM c
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, d DESC NULLS LAST, p) = 1
"""

ORACLE["year_range"] = """
SELECT o_custkey, CAST(min(year(o_orderdate)) AS INTEGER) AS year_min,
       CAST(max(year(o_orderdate)) AS INTEGER) AS year_max
FROM orders GROUP BY o_custkey
"""

_SUMMARY = """
tot AS (SELECT {k} AS k, CAST(count(*) AS INTEGER) AS n_obs, CAST(min(year({ts})) AS INTEGER) AS year_min,
               CAST(max(year({ts})) AS INTEGER) AS year_max
        FROM {t} GROUP BY 1),
cv AS (SELECT {k} AS k, {v} AS v, count(*) AS n, min({o}) AS p FROM {t}
       WHERE coalesce({v}, '') <> '' GROUP BY 1, 2),
fr AS (SELECT k, string_agg(v, '|' ORDER BY n DESC, p) AS vals FROM cv GROUP BY k),
cc AS (SELECT {k} AS k, {c} AS c, count(*) AS n, max({ts}) AS d, min({o}) AS p FROM {t}
       WHERE coalesce({c}, '') <> '' GROUP BY 1, 2),
mo AS (SELECT k, c FROM cc QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, d DESC NULLS LAST, p) = 1),
summ AS (SELECT tot.k, tot.n_obs, coalesce(fr.vals, '') AS vals, tot.year_min, tot.year_max, mo.c AS mode_c
         FROM tot LEFT JOIN fr ON tot.k = fr.k LEFT JOIN mo ON tot.k = mo.k)
"""

ORACLE["occurrence_summary"] = "WITH " + _SUMMARY.format(
    k="user_id", ts="ts", t="events", v="event_type", o="event_id", c="event_type") + """
SELECT k AS user_id, n_obs, vals AS types, year_min, year_max, mode_c AS mode_type FROM summ
"""

_TAXONOMY = """
tax AS (SELECT n_nationkey AS tax_key,
               CASE WHEN r_name = 'ASIA' THEN 'FUZZY' WHEN r_name = 'MIDDLE EAST' THEN NULL
                    ELSE 'EXACT' END AS match_type,
               r_name AS kingdom, n_name AS phylum,
               CASE WHEN r_name <> 'AMERICA' THEN 'class_' || CAST(r_regionkey AS VARCHAR) END AS class_name,
               'NATION' AS rank
        FROM nation JOIN region ON n_regionkey = r_regionkey)
"""

ORACLE["pivot_merge"] = "WITH " + _SUMMARY.format(
    k="o_custkey", ts="o_orderdate", t="(SELECT * FROM orders WHERE year(o_orderdate) >= 2000)", v="o_orderpriority", o="o_orderkey",
    c="o_orderstatus") + "," + _TAXONOMY + """
SELECT c.c_custkey, c.c_name AS title,
       tax.kingdom, tax.phylum, tax.class_name, tax.rank,
       CASE WHEN tax.tax_key IS NOT NULL THEN 'MATCHED' ELSE 'UNMATCHED' END AS taxonomy_status,
       coalesce(s.n_obs, 0) AS n_obs, coalesce(s.vals, '') AS top_values, s.year_min, s.year_max,
       s.mode_c AS mode_value,
       CASE WHEN coalesce(s.n_obs, 0) > 0 THEN 'OK' ELSE 'GBIF_AUGMENTATION_EMPTY' END AS augmentation_status
FROM customer c
LEFT JOIN tax ON c.c_nationkey = tax.tax_key AND tax.match_type = 'EXACT'
LEFT JOIN summ s ON c.c_custkey = s.k
"""

ORACLE["unmatched_pivot"] = """
SELECT DISTINCT o_custkey AS c_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'MACHINERY')
"""

_GATE = r"^[0-9]{4}(-[0-9]{1,2}-[0-9]{1,2}([Tt][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?)?$"

_EVENT_DATES = """
ev AS (SELECT event_id, user_id, event_type, value, ts,
              TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
ed AS (SELECT *, CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                      WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d')
                      WHEN event_type = 'purchase' THEN strftime(ts, '%Y')
                      WHEN event_type = 'signup' THEN CASE WHEN k < 50 THEN strftime(ts, '%Y-%m')
                                                           ELSE strftime(ts, '%Y-%-m-%-d') END
                      ELSE CASE WHEN k = 0 THEN '' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END
                 END AS raw_date FROM ev),
pd AS (SELECT *, CASE WHEN regexp_full_match(raw_date, '""" + _GATE + """')
                       AND NOT starts_with(raw_date, '0000')
                      THEN coalesce(try_strptime(replace(raw_date, 't', 'T'), '%Y-%m-%dT%H:%M:%S'),
                                    try_strptime(raw_date, '%Y-%m-%d'),
                                    try_strptime(raw_date, '%Y')) END AS parsed
       FROM ed)
"""

ORACLE["date_gate"] = "WITH " + _EVENT_DATES + """
SELECT event_id, raw_date, strftime(parsed, '%Y-%m-%d %H:%M:%S') AS event_date,
       NOT (coalesce(raw_date <> '', false) AND parsed IS NULL) AS date_valid
FROM pd
"""

ORACLE["safe_number"] = "WITH " + _EVENT_DATES + """,
r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN CAST(k AS VARCHAR) || 'x'
                            WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) || 'd'
                            WHEN event_type = 'signup' THEN ' ' || CAST(k AS VARCHAR) || '.5e1'
                            WHEN event_type = 'view' THEN '' ELSE CAST(k AS VARCHAR) END AS raw FROM ev)
SELECT event_id, raw, TRY_CAST(trim(raw) AS DOUBLE) AS as_double,
       NULLIF(TRY_CAST(trim(raw) AS DOUBLE), 0) AS falsy_null
FROM r
"""

_OCC = _EVENT_DATES + """,
occ AS (SELECT event_id, user_id AS species_key,
               CASE WHEN event_type = 'signup' AND value < 5 THEN NULL ELSE event_id END AS gid,
               (event_type = 'error' AND k < 3) AS lat_text,
               value / 2.5 - 90 AS lat,
               (event_type = 'view' AND k > 90) AS lon_missing,
               value - 180 AS lon,
               (event_type = 'error' AND k BETWEEN 3 AND 10) AS basis_missing,
               raw_date, parsed,
               (event_type = 'purchase' AND k > 95) AS unc_bad, k
        FROM pd),
occ_checked AS (
  SELECT *, CASE WHEN gid IS NULL OR gid = 0 THEN 'MISSING_GBIF_ID'
                 WHEN lon_missing THEN 'MISSING_COORDINATES'
                 WHEN lat_text THEN 'COORDINATES_OUT_OF_RANGE'
                 WHEN NOT (lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) THEN 'COORDINATES_OUT_OF_RANGE'
                 WHEN basis_missing THEN 'MISSING_BASIS_OF_RECORD'
                 WHEN raw_date <> '' AND parsed IS NULL THEN 'INVALID_EVENT_DATE'
                 WHEN unc_bad THEN 'HTTP_ERROR' END AS rejection_reason
  FROM occ)
"""

ORACLE["validate_occurrences"] = "WITH " + _OCC + """
SELECT event_id, species_key, rejection_reason,
       CASE WHEN rejection_reason IS NULL THEN gid END AS gbif_id,
       CASE WHEN rejection_reason IS NULL THEN lat END AS decimal_latitude,
       CASE WHEN rejection_reason IS NULL THEN lon END AS decimal_longitude,
       CASE WHEN rejection_reason IS NULL THEN strftime(parsed, '%Y-%m-%d %H:%M:%S') END AS event_date,
       CASE WHEN rejection_reason IS NULL THEN NULLIF(CAST(k AS DOUBLE), 0) END AS coordinate_uncertainty_m,
       CASE rejection_reason WHEN 'MISSING_GBIF_ID' THEN 'species_key'
                             WHEN 'COORDINATES_OUT_OF_RANGE' THEN 'gbif_id,lat,lon,species_key'
                             WHEN 'INVALID_EVENT_DATE' THEN 'event_date,gbif_id,species_key'
                             WHEN 'HTTP_ERROR' THEN 'error,gbif_id,species_key'
                             WHEN NULL THEN NULL
                             ELSE CASE WHEN rejection_reason IS NOT NULL THEN 'gbif_id,species_key' END
       END AS context_keys
FROM occ_checked
"""

_TAX = """
tx AS (SELECT *, CASE WHEN p_type = 'PROMO' AND p_size > 45 THEN 'HTTP_ERROR'
                      WHEN (p_type = 'LARGE' AND p_size < 5) OR (p_type = 'SMALL' AND p_size < 3) THEN 'NO_MATCH_RETURNED'
                      WHEN p_size >= 40 THEN 'MATCH_TYPE_NOT_EXACT'
                      WHEN p_type = 'MEDIUM' AND p_size = 1 THEN 'HTTP_ERROR'
                      WHEN (p_type = 'PROMO' AND p_size < 6) OR (p_type = 'SMALL' AND p_size < 8)
                           OR (p_type = 'LARGE' AND p_size < 10) THEN 'HTTP_ERROR' END AS rejection_reason,
              (p_type = 'PROMO' AND p_size > 45) AS status_err
       FROM part)
"""

ORACLE["validate_taxonomy"] = "WITH " + _TAX + """
SELECT p_partkey, rejection_reason,
       CASE WHEN rejection_reason IS NULL THEN CAST(p_partkey AS INTEGER) END AS usage_key,
       CASE WHEN rejection_reason IS NULL THEN p_name END AS scientific_name,
       CASE WHEN rejection_reason IS NULL THEN p_brand END AS canonical_name,
       CASE WHEN rejection_reason IS NULL THEN p_type END AS rank,
       CASE WHEN rejection_reason IS NULL THEN 'EXACT' END AS match_type,
       CASE WHEN rejection_reason IS NULL THEN p_size END AS confidence,
       CASE WHEN rejection_reason IS NULL THEN p_brand END AS kingdom,
       CASE WHEN rejection_reason IS NULL THEN p_type END AS phylum,
       CASE WHEN rejection_reason IS NULL AND p_size >= 10 THEN 'size_' || CAST(p_size AS VARCHAR) END AS class_name,
       CASE WHEN rejection_reason IS NULL THEN NULL
            WHEN status_err THEN 'http_status,species_key'
            WHEN rejection_reason = 'MATCH_TYPE_NOT_EXACT' AND p_size > 40 THEN 'match_type,species_key'
            WHEN rejection_reason = 'HTTP_ERROR' THEN 'error,species_key'
            ELSE 'species_key' END AS context_keys
FROM tx
"""

_PAGES = """
pg AS (SELECT *, CASE WHEN source = 'src1' THEN 'PAGE_NOT_FOUND'
                      WHEN source = 'src2' THEN 'HTTP_ERROR'
                      WHEN source = 'src3' THEN 'PAGE_NOT_FOUND'
                      WHEN source = 'src4' THEN 'DISAMBIGUATION_PAGE'
                      WHEN length(text) < 50 THEN 'EXTRACT_TOO_SHORT'
                      WHEN lang = 'de' OR text = '' THEN 'MISSING_SECTIONS_TEXT'
                      WHEN source IN ('src5', 'src6', 'src7') THEN 'HTTP_ERROR' END AS rejection_reason
       FROM documents)
"""

ORACLE["validate_pages"] = "WITH " + _PAGES + """
SELECT doc_id, rejection_reason,
       CASE WHEN rejection_reason IS NULL THEN 'Doc ' || CAST(doc_id AS VARCHAR) END AS title,
       CASE WHEN rejection_reason IS NULL THEN CAST(length(text) AS INTEGER) END AS extract_length,
       CASE WHEN rejection_reason IS NULL THEN CAST(length(text) AS INTEGER) END AS sections_length,
       CASE WHEN rejection_reason IS NULL THEN sha256(text) END AS extract_sha256,
       CASE WHEN rejection_reason IS NULL THEN sha256(text) END AS sections_text_sha256,
       CASE WHEN rejection_reason IS NULL THEN 'https://docs.example/' || CAST(doc_id AS VARCHAR) END AS page_url,
       CASE WHEN rejection_reason IS NULL THEN 'DIRECT_TITLE' END AS resolved_via,
       CASE WHEN rejection_reason IS NULL THEN NULL
            WHEN source IN ('src1', 'src2') THEN 'http_status,species_key'
            WHEN source = 'src4' THEN 'species_key,title'
            WHEN rejection_reason = 'EXTRACT_TOO_SHORT' THEN 'extract_length,species_key'
            WHEN rejection_reason = 'HTTP_ERROR' THEN 'error,species_key'
            ELSE 'species_key' END AS context_keys
FROM pg
"""

ORACLE["reject_report"] = "WITH " + _OCC + "," + _TAX + "," + _PAGES + """,
allrej AS (SELECT 'wikipedia' AS source, rejection_reason FROM pg WHERE rejection_reason IS NOT NULL
           UNION ALL SELECT 'gbif_taxonomy', rejection_reason FROM tx WHERE rejection_reason IS NOT NULL
           UNION ALL SELECT 'gbif_occurrence', rejection_reason FROM occ_checked WHERE rejection_reason IS NOT NULL)
SELECT source, rejection_reason, count(*) AS n_rejected FROM allrej GROUP BY ALL
"""

ORACLE["reconcile"] = "WITH " + _OCC + "," + _TAX + "," + _PAGES + """,
u AS (SELECT 'wikipedia' AS source, rejection_reason FROM pg
      UNION ALL SELECT 'gbif_taxonomy', rejection_reason FROM tx
      UNION ALL SELECT 'gbif_occurrence', rejection_reason FROM occ_checked)
SELECT source, count(*) AS n_input, count(*) FILTER (WHERE rejection_reason IS NULL) AS n_valid,
       count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS n_rejected, true AS balanced
FROM u GROUP BY source
"""

_ORDER_BATCHES = """
b1 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 1 AS ord
       FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
b2 AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice, o_orderpriority, 1 AS ord
       FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
       UNION ALL
       SELECT o_orderkey, o_custkey, 'V', o_totalprice + 1, o_orderpriority, 2
       FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
"""

ORACLE["upsert_all"] = "WITH " + _ORDER_BATCHES + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM (
  SELECT *, 0 AS batch FROM b1 UNION ALL SELECT *, 1 AS batch FROM b2)
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY batch DESC, ord DESC) = 1
"""

_CATALOG = """
rec AS (SELECT e.user_id AS species_key, e.event_id, e.ts, e.event_type,
               'day_' || strftime(e.ts, '%Y-%m-%d') AS batch_id,
               CASE WHEN s.c_custkey IS NOT NULL THEN 'SEED' ELSE 'AD_HOC' END AS origin
        FROM events e LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE') s
        ON e.user_id = s.c_custkey),
cat AS (SELECT species_key,
               arg_min(event_type, event_id) AS scientific_name,
               arg_max(event_type, event_id) AS wikipedia_title,
               arg_min(batch_id, event_id) AS first_seen_batch_id,
               arg_min(ts, event_id) AS first_ts, arg_max(ts, event_id) AS last_ts,
               arg_min(origin, event_id) AS origin
        FROM rec GROUP BY species_key)
"""

ORACLE["upsert_catalog"] = "WITH " + _CATALOG + """
SELECT species_key, scientific_name, wikipedia_title, first_seen_batch_id,
       strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS first_processed_at,
       strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_processed_at, origin
FROM cat
"""

ORACLE["catalog_listing"] = "WITH " + _CATALOG + """
SELECT species_key, wikipedia_title, origin, first_seen_batch_id FROM cat ORDER BY species_key
"""

ORACLE["by_origin"] = "WITH " + _CATALOG + """
SELECT origin, count(*) AS n FROM cat GROUP BY origin
"""

ORACLE["upsert_evidence"] = "WITH " + _ORDER_BATCHES + """,
k1 AS (SELECT DISTINCT o_orderkey FROM b1),
k2 AS (SELECT DISTINCT o_orderkey FROM b2),
o AS (SELECT (SELECT count(*) FROM b1) AS n1, (SELECT count(*) FROM k1) AS d1,
             (SELECT count(*) FROM b2) AS n2,
             (SELECT count(*) FROM k2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM k1)) AS new2),
c AS (SELECT user_id, event_id, ts >= TIMESTAMP '2024-01-16' AS late FROM events),
cc AS (SELECT (SELECT count(*) FROM c WHERE NOT late) AS n1,
              (SELECT count(DISTINCT user_id) FROM c WHERE NOT late) AS d1,
              (SELECT count(*) FROM c WHERE late) AS n2,
              (SELECT count(DISTINCT user_id) FROM c WHERE late AND user_id NOT IN
                   (SELECT user_id FROM c WHERE NOT late)) AS new2)
SELECT 1 AS step, 'orders_table' AS tabla, 0 AS filas_antes, d1 AS filas_despues, d1 AS filas_nuevas,
       n1 - d1 AS filas_actualizadas FROM o
UNION ALL SELECT 2, 'orders_table', d1, d1 + new2, new2, n2 - new2 FROM o
UNION ALL SELECT 3, 'orders_table', d1 + new2, d1 + new2, 0, n2 FROM o
UNION ALL SELECT 1, 'catalog', 0, d1, d1, n1 - d1 FROM cc
UNION ALL SELECT 2, 'catalog', d1, d1 + new2, new2, n2 - new2 FROM cc
"""

ORACLE["trace"] = "WITH " + _OCC + "," + _CATALOG + """,
tagged AS (SELECT c_custkey AS k, 'pivot' AS tbl FROM customer
           UNION ALL SELECT species_key, 'catalog' FROM cat
           UNION ALL SELECT species_key, 'occurrences' FROM occ_checked WHERE rejection_reason IS NULL)
SELECT k AS species_key, bool_or(tbl = 'pivot') AS in_pivot, bool_or(tbl = 'catalog') AS in_catalog,
       bool_or(tbl = 'occurrences') AS in_occurrences
FROM tagged GROUP BY k
"""

# Sections: computed from the turn structure (each turn is one headed block).
_SECTIONS = """
tb AS (SELECT conv_id, turn, role, text,
              ['Description and morphology', 'Distribution and habitat', 'Habitat', 'Behavior', 'Diet and feeding', 'Prey', 'Reproduction', 'Conservation status', 'Human interaction', 'References', 'Gallery', 'Etymology', 'Identity', 'Taxonomy', 'See also', 'Life cycle'][((conv_id * 7 + turn) % 16) + 1] AS heading
       FROM conversations),
ts AS (SELECT *, CASE WHEN contains(lower(heading), 'identity') THEN 'Identity' WHEN contains(lower(heading), 'taxonomy') OR contains(lower(heading), 'classification') THEN 'Taxonomy' WHEN contains(lower(heading), 'morphology') OR contains(lower(heading), 'description') OR contains(lower(heading), 'anatomy') OR contains(lower(heading), 'appearance') THEN 'Morphology' WHEN contains(lower(heading), 'distribution') OR contains(lower(heading), 'range') OR contains(lower(heading), 'geographic') THEN 'Distribution' WHEN contains(lower(heading), 'habitat') THEN 'Habitat' WHEN contains(lower(heading), 'behavior') OR contains(lower(heading), 'behaviour') THEN 'Behavior' WHEN contains(lower(heading), 'diet') OR contains(lower(heading), 'feeding') OR contains(lower(heading), 'food') OR contains(lower(heading), 'prey') OR contains(lower(heading), 'foraging') THEN 'Diet' WHEN contains(lower(heading), 'reproduction') OR contains(lower(heading), 'breeding') OR contains(lower(heading), 'mating') OR contains(lower(heading), 'life cycle') THEN 'Reproduction' WHEN contains(lower(heading), 'conservation') OR contains(lower(heading), 'threats') OR contains(lower(heading), 'endangered') OR contains(lower(heading), 'status') OR contains(lower(heading), 'population') THEN 'Conservation' WHEN contains(lower(heading), 'human interaction') OR contains(lower(heading), 'shark attack') OR contains(lower(heading), 'human') THEN 'Human Interaction' WHEN contains(lower(heading), 'references') OR contains(lower(heading), 'citations') OR contains(lower(heading), 'further reading') OR contains(lower(heading), 'external links') THEN 'References' WHEN contains(lower(heading), 'multimedia') OR contains(lower(heading), 'gallery') OR contains(lower(heading), 'media') THEN 'Multimedia' END AS section FROM tb WHERE role <> 'system'),
st AS (SELECT conv_id,
       nullif(trim(string_agg(CASE WHEN section = 'Identity' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS identity,
       nullif(trim(string_agg(CASE WHEN section = 'Taxonomy' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS taxonomy,
       nullif(trim(string_agg(CASE WHEN section = 'Morphology' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS morphology,
       nullif(trim(string_agg(CASE WHEN section = 'Distribution' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS distribution,
       nullif(trim(string_agg(CASE WHEN section = 'Habitat' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS habitat,
       nullif(trim(string_agg(CASE WHEN section = 'Behavior' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS behavior,
       nullif(trim(string_agg(CASE WHEN section = 'Diet' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS diet,
       nullif(trim(string_agg(CASE WHEN section = 'Reproduction' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS reproduction,
       nullif(trim(string_agg(CASE WHEN section = 'Conservation' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS conservation,
       nullif(trim(string_agg(CASE WHEN section = 'Human Interaction' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS human_interaction,
       nullif(trim(string_agg(CASE WHEN section = 'References' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS "references",
       nullif(trim(string_agg(CASE WHEN section = 'Multimedia' THEN trim(text, chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)) END, chr(10) ORDER BY turn), chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)), '') AS multimedia
       FROM ts GROUP BY conv_id),
d AS (SELECT conv_id, bool_or(role = 'system') AS has_system,
             concat_ws('; ', 'kingdom: ' || nullif(min(CASE WHEN turn = 0 THEN role END), ''),
                             'phylum: ' || nullif(arg_max(role, turn), ''),
                             'rank: turns_' || CAST(count(*) AS VARCHAR)) AS tax_text
      FROM conversations GROUP BY conv_id),
parents AS (SELECT 'conv_' || CAST(d.conv_id AS VARCHAR) AS species_key,
       'Species: Conversation ' || CAST(d.conv_id AS VARCHAR) || ' (conv_' || CAST(d.conv_id AS VARCHAR) || ')' AS identity, coalesce(CASE WHEN d.has_system THEN d.tax_text END, st.taxonomy) AS taxonomy, st.morphology, st.distribution, st.habitat, st.behavior, st.diet, st.reproduction, st.conservation, st.human_interaction, st."references", st.multimedia
       FROM d LEFT JOIN st ON d.conv_id = st.conv_id)
"""

ORACLE["sections_wide"] = "WITH " + _SECTIONS + """
SELECT * FROM parents
"""

_CHUNKS = """,
ch AS (SELECT species_key || '__' || section || '__0' AS chunk_id, species_key, section, text FROM (
SELECT species_key, 'Identity' AS section, identity AS text FROM parents UNION ALL SELECT species_key, 'Taxonomy' AS section, taxonomy AS text FROM parents UNION ALL SELECT species_key, 'Morphology' AS section, morphology AS text FROM parents UNION ALL SELECT species_key, 'Distribution' AS section, distribution AS text FROM parents UNION ALL SELECT species_key, 'Habitat' AS section, habitat AS text FROM parents UNION ALL SELECT species_key, 'Behavior' AS section, behavior AS text FROM parents UNION ALL SELECT species_key, 'Diet' AS section, diet AS text FROM parents UNION ALL SELECT species_key, 'Reproduction' AS section, reproduction AS text FROM parents UNION ALL SELECT species_key, 'Conservation' AS section, conservation AS text FROM parents UNION ALL SELECT species_key, 'Human Interaction' AS section, human_interaction AS text FROM parents UNION ALL SELECT species_key, 'References' AS section, "references" AS text FROM parents UNION ALL SELECT species_key, 'Multimedia' AS section, multimedia AS text FROM parents) WHERE text IS NOT NULL AND length(text) > 0)
"""

ORACLE["chunks"] = "WITH " + _SECTIONS + _CHUNKS + "SELECT * FROM ch"

ORACLE["section_coverage"] = "WITH " + _SECTIONS + _CHUNKS + """
SELECT section, count(*) AS n_chunks, CAST(sum(length(text)) AS BIGINT) AS total_chars,
       CAST(max(length(text)) AS INTEGER) AS max_chars
FROM ch GROUP BY section
"""

ORACLE["metadata_view"] = "WITH " + _SUMMARY.format(
    k="o_custkey", ts="o_orderdate", t="(SELECT * FROM orders WHERE year(o_orderdate) >= 2000)", v="o_orderpriority", o="o_orderkey",
    c="o_orderstatus") + "," + _TAXONOMY + """
SELECT c.c_custkey, tax.kingdom, tax.phylum, tax.class_name, tax.rank,
       CASE WHEN tax.tax_key IS NOT NULL THEN 'MATCHED' ELSE 'UNMATCHED' END AS taxonomy_status,
       s.mode_c AS iucn_red_list_category, coalesce(s.vals, '') AS paises, s.year_min, s.year_max,
       coalesce(s.n_obs, 0) AS n_occurrences_validas,
       CASE WHEN coalesce(s.n_obs, 0) > 0 THEN 'OK' ELSE 'GBIF_AUGMENTATION_EMPTY' END AS augmentation_status
FROM customer c
LEFT JOIN tax ON c.c_nationkey = tax.tax_key AND tax.match_type = 'EXACT'
LEFT JOIN summ s ON c.c_custkey = s.k
"""

_VEC = """
dims AS (SELECT label, pos, avg(x) AS m FROM (
           SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS pos
           FROM embeddings) GROUP BY label, pos),
cent AS (SELECT label AS query_id, list(m ORDER BY pos) AS qv FROM dims GROUP BY label),
dist AS (SELECT c.query_id, e.vec_id, e.label,
                list_reduce(list_transform(range(1, len(e.embedding) + 1),
                    lambda i: (e.embedding[i]::DOUBLE - c.qv[i]) * (e.embedding[i]::DOUBLE - c.qv[i])),
                    lambda a, b: a + b) AS distance
         FROM cent c CROSS JOIN embeddings e),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rnk FROM dist),
meta AS (SELECT l.label, 'label_' || CAST(l.label AS VARCHAR) AS wikipedia_title, r.r_name AS kingdom,
                CASE n.n_regionkey WHEN 0 THEN 'LC' WHEN 1 THEN 'NT' ELSE 'VU' END AS iucn_red_list_category,
                'MATCHED' AS taxonomy_status, 1990 + l.label AS anio_min, 2000 + l.label AS anio_max
         FROM (SELECT DISTINCT label FROM embeddings) l
         LEFT JOIN nation n ON l.label = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
"""

ORACLE["knn_topk"] = "WITH " + _VEC + """
SELECT query_id, vec_id, label, distance, CAST(rnk AS INTEGER) AS rank FROM ranked WHERE rnk <= 25
"""

ORACLE["knn_parent"] = "WITH " + _VEC + """,
best AS (SELECT * FROM ranked WHERE rnk <= 25
         QUALIFY row_number() OVER (PARTITION BY query_id, label ORDER BY distance, vec_id) = 1)
SELECT b.query_id, CAST(row_number() OVER (PARTITION BY b.query_id ORDER BY b.distance, b.vec_id) AS INTEGER) AS rank,
       b.label, m.wikipedia_title, b.vec_id, b.distance AS score
FROM best b JOIN meta m ON b.label = m.label
QUALIFY rank <= 5
"""

_SEARCH_FILTER = """m.taxonomy_status = 'MATCHED' AND m.iucn_red_list_category = 'VU'
       AND m.anio_max >= 2005 AND m.anio_min <= 2100"""

ORACLE["search_post"] = "WITH " + _VEC + """,
best AS (SELECT * FROM ranked WHERE rnk <= 15
         QUALIFY row_number() OVER (PARTITION BY query_id, label ORDER BY distance, vec_id) = 1)
SELECT b.query_id, CAST(row_number() OVER (PARTITION BY b.query_id ORDER BY b.distance, b.vec_id) AS INTEGER) AS rank,
       b.label, m.wikipedia_title, 'vector ' || CAST(b.vec_id AS VARCHAR) AS chunk_text,
       b.distance AS score, b.vec_id, m.kingdom, m.iucn_red_list_category
FROM best b JOIN meta m ON b.label = m.label
WHERE """ + _SEARCH_FILTER + """
QUALIFY rank <= 3
"""

ORACLE["search_pre"] = "WITH " + _VEC + """,
best AS (SELECT d.* FROM dist d JOIN meta m ON d.label = m.label
         WHERE """ + _SEARCH_FILTER + """
         QUALIFY row_number() OVER (PARTITION BY d.query_id, d.label ORDER BY d.distance, d.vec_id) = 1)
SELECT b.query_id, CAST(row_number() OVER (PARTITION BY b.query_id ORDER BY b.distance, b.vec_id) AS INTEGER) AS rank,
       b.label, m.wikipedia_title, 'vector ' || CAST(b.vec_id AS VARCHAR) AS chunk_text,
       b.distance AS score, b.vec_id, m.kingdom, m.iucn_red_list_category
FROM best b JOIN meta m ON b.label = m.label
QUALIFY rank <= 3
"""

ORACLE["batch_search"] = """
WITH d AS (SELECT q.vec_id AS query_id, e.vec_id,
                  list_reduce(list_transform(range(1, len(e.embedding) + 1),
                      lambda i: (e.embedding[i]::DOUBLE - q.embedding[i]::DOUBLE) * (e.embedding[i]::DOUBLE - q.embedding[i]::DOUBLE)),
                      lambda a, b: a + b) AS distance
           FROM embeddings q CROSS JOIN embeddings e WHERE q.vec_id <> e.vec_id AND q.vec_id % 100 = 0)
SELECT query_id, vec_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, distance
FROM d QUALIFY rank <= 5
"""

ORACLE["ann_search"] = "WITH " + _VEC + """,
planes AS (SELECT t, b, p, CASE WHEN ((((p + 1) * (t * 31 + b * 17 + 7) * 2654435761) % 4294967296) >> 16) & 1 = 1
                            THEN 1.0 ELSE -1.0 END AS s
           FROM range(16) x(t), range(3) y(b), range(64) z(p)),
vals AS (SELECT 'q' AS side, query_id AS id, unnest(range(len(qv))) AS p, unnest(qv) AS x FROM cent
         UNION ALL SELECT 'v', vec_id, unnest(range(len(embedding))), unnest(embedding)::DOUBLE FROM embeddings),
bits AS (SELECT side, id, t, b, sum(x * s) >= 0 AS bit FROM vals JOIN planes USING (p) GROUP BY ALL),
codes AS (SELECT side, id, t, sum(CASE WHEN bit THEN 1 << b ELSE 0 END) AS code FROM bits GROUP BY ALL),
cand AS (SELECT DISTINCT q.id AS query_id, v.id AS vec_id FROM codes q JOIN codes v ON q.t = v.t AND q.code = v.code
         WHERE q.side = 'q' AND v.side = 'v')
SELECT query_id, vec_id, label, distance,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank
FROM dist JOIN cand USING (query_id, vec_id) QUALIFY rank <= 25
"""

ORACLE["embed_chunks"] = """
SELECT doc_id, 384 AS dims,
       CAST(len(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9_]+'), lambda s: s <> '')) AS INTEGER) AS n_tokens,
       CASE WHEN regexp_matches(lower(text), '[a-z0-9_]') THEN 1.0 ELSE 0.0 END::DOUBLE AS norm
FROM documents
"""

ORACLE["bronze_pages"] = ORACLE["validate_pages"]

ORACLE["incremental_bronze"] = """
SELECT page_id, 200 AS status, CAST(length(html) AS INTEGER) AS n_chars, sha256(html) AS data_sha256 FROM pages
"""

ORACLE["resolve_titles"] = """
WITH names AS (SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS name FROM documents),
dir AS (SELECT 'doc-' || CAST(page_id AS VARCHAR) AS k,
               regexp_extract(html, '<title>(.*?)</title>', 1) AS page_title,
               contains(url, '?page=') AS dis, contains(url, '#') AS red
        FROM pages),
hits AS (SELECT 'doc-' || CAST(conv_id AS VARCHAR) AS name, turn + 1 AS rnk,
                CASE WHEN role = 'assistant' THEN 'p-' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR)
                     ELSE 'doc-' || CAST(conv_id AS VARCHAR) || CAST(turn AS VARCHAR) END AS hit_title,
                text AS snippet
         FROM conversations),
agg AS (SELECT name, count(*) AS n_hits, string_agg(hit_title, '|' ORDER BY rnk) AS cands,
               arg_min(hit_title, rnk) AS top_title, arg_min(snippet, rnk) AS top_snip,
               arg_min(hit_title, rnk) FILTER (WHERE rnk > 1) AS sec_title,
               arg_min(snippet, rnk) FILTER (WHERE rnk > 1) AS sec_snip
        FROM hits GROUP BY name),
j AS (SELECT n.name, d.k IS NOT NULL AS direct, d.dis AS d_dis, d.red AS d_red, d.page_title AS d_title,
             coalesce(a.n_hits, 0) AS n_hits, a.cands, a.top_title, a.top_snip, a.sec_title, a.sec_snip,
             t.k IS NOT NULL AS top_ok, coalesce(t.dis, false) AS top_dis,
             (s.k IS NOT NULL AND NOT coalesce(s.dis, false)) AS sec_ok
      FROM names n LEFT JOIN dir d ON n.name = d.k LEFT JOIN agg a ON n.name = a.name
      LEFT JOIN dir t ON a.top_title = t.k LEFT JOIN dir s ON a.sec_title = s.k),
r AS (SELECT *, CASE WHEN direct AND d_dis THEN 1 WHEN direct THEN 2 WHEN n_hits = 0 THEN 3
                     WHEN NOT top_ok THEN 4 WHEN top_dis AND n_hits > 1 AND sec_ok THEN 5
                     WHEN top_dis THEN 6
                     WHEN n_hits >= 2
                          AND (contains(lower(top_snip), lower(name)) OR contains(lower(top_title), lower(name)))
                          AND (contains(lower(sec_snip), lower(name)) OR contains(lower(sec_title), lower(name)))
                          THEN 7
                     ELSE 8 END AS rule
      FROM j)
SELECT name,
       CASE rule WHEN 1 THEN 'DISAMBIGUATION_PAGE' WHEN 2 THEN 'SUCCESS' WHEN 3 THEN 'PAGE_NOT_FOUND'
                 WHEN 4 THEN 'PAGE_NOT_FOUND' WHEN 5 THEN 'SUCCESS' WHEN 6 THEN 'DISAMBIGUATION_PAGE'
                 WHEN 7 THEN 'AMBIGUOUS_RESOLUTION' ELSE 'SUCCESS' END AS status,
       CASE WHEN rule IN (1, 2) THEN CASE WHEN d_red THEN 'REDIRECT' ELSE 'DIRECT_TITLE' END
            WHEN rule IN (5, 6, 8) THEN 'SEARCH' END AS resolved_via,
       CASE WHEN rule IN (1, 2) THEN d_title WHEN rule = 5 THEN sec_title
            WHEN rule IN (6, 8) THEN top_title END AS title,
       CASE WHEN rule IN (4, 6, 7) THEN cands END AS candidates
FROM r
"""

ORACLE["lineitem_summary"] = "WITH li AS (SELECT *, l_orderkey * 8 + l_linenumber AS line_ord FROM lineitem), " + _SUMMARY.format(
    k="l_partkey", ts="l_shipdate", t="li", v="l_returnflag", o="line_ord", c="l_linestatus") + """
SELECT k AS l_partkey, n_obs AS n_lines, vals AS flags, year_min, year_max, mode_c AS mode_status FROM summ
"""

ORACLE["integrity_checks"] = """
WITH c AS (
  SELECT 'orders.o_custkey in customer' AS "check",
         (SELECT count(DISTINCT o_custkey) FROM orders) AS n_checked,
         (SELECT count(DISTINCT o_custkey) FROM orders
          WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS n_failed
  UNION ALL
  SELECT 'lineitem.l_orderkey in orders', (SELECT count(DISTINCT l_orderkey) FROM lineitem),
         (SELECT count(DISTINCT l_orderkey) FROM lineitem
          WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
  UNION ALL
  SELECT 'lineitem.l_partkey in part', (SELECT count(DISTINCT l_partkey) FROM lineitem),
         (SELECT count(DISTINCT l_partkey) FROM lineitem
          WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
  UNION ALL
  SELECT 'customer.c_custkey unique', (SELECT count(*) FROM customer),
         (SELECT count(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING count(*) > 1))
  UNION ALL
  SELECT 'orders.o_custkey in AUTOMOBILE customers', (SELECT count(DISTINCT o_custkey) FROM orders),
         (SELECT count(DISTINCT o_custkey) FROM orders
          WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE'))
  UNION ALL
  SELECT 'orders.o_custkey unique', (SELECT count(*) FROM orders),
         (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))
  UNION ALL
  SELECT 'orders.o_orderkey unique', (SELECT count(*) FROM orders),
         (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)))
SELECT "check", n_checked, n_failed, n_failed = 0 AS passed FROM c
"""

ORACLE["search_country"] = "WITH " + _VEC + """,
best AS (SELECT d.* FROM dist d JOIN nation n ON d.label = n.n_nationkey
         WHERE n.n_regionkey IN (SELECT n_regionkey FROM nation WHERE n_name = 'NATION_7')
         QUALIFY row_number() OVER (PARTITION BY d.query_id, d.label ORDER BY d.distance, d.vec_id) = 1)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank,
       label, 'label_' || CAST(label AS VARCHAR) AS wikipedia_title, vec_id, distance AS score
FROM best QUALIFY rank <= 2
"""

ORACLE["batch_silver"] = "WITH " + _OCC + "," + _TAX + "," + _PAGES + """,
o AS (SELECT *, CASE WHEN source = 'src8' THEN 'AMBIGUOUS_RESOLUTION' WHEN source = 'src9' THEN 'PAGE_NOT_FOUND'
                     ELSE coalesce(rejection_reason, 'MERGED') END AS outcome FROM pg),
n AS (SELECT species_key, count(*) AS n FROM occ_checked WHERE rejection_reason IS NULL GROUP BY 1)
SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS species_key, outcome,
       CASE WHEN outcome = 'MERGED' THEN 'Doc ' || CAST(doc_id AS VARCHAR) END AS wikipedia_title,
       CASE WHEN outcome = 'MERGED' THEN CASE WHEN tx.p_partkey IS NOT NULL AND tx.rejection_reason IS NULL
            THEN 'MATCHED' ELSE 'UNMATCHED' END END AS taxonomy_status,
       CASE WHEN outcome = 'MERGED' THEN CAST(coalesce(n.n, 0) AS INTEGER) END AS n_occurrences_validas
FROM o LEFT JOIN tx ON tx.p_partkey = o.doc_id LEFT JOIN n ON n.species_key = o.doc_id
"""

ORACLE["incremental_upsert"] = "WITH " + _TAX + """,
v AS (SELECT count(*) AS n FROM tx WHERE rejection_reason IS NULL)
SELECT 1 AS run, 0 AS filas_antes, n AS filas_despues, n AS filas_nuevas, 0 AS filas_actualizadas FROM v
UNION ALL SELECT 2, n, n, 0, n FROM v
"""

ORACLE["store_operations"] = "WITH " + _ORDER_BATCHES + """,
k AS (SELECT o_orderkey FROM b1 UNION SELECT o_orderkey FROM b2)
SELECT 'first_load' AS what, '0' AS value UNION ALL SELECT 'vacuumed', '2'
UNION ALL SELECT 'lookup_status', (SELECT arg_max(o_orderstatus, b * 10 + ord) FROM (
    SELECT *, 0 AS b FROM b1 UNION ALL SELECT *, 1 AS b FROM b2) WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders))
UNION ALL SELECT 'count', (SELECT CAST(count(*) AS VARCHAR) FROM k) UNION ALL SELECT 'tables', 'orders'
UNION ALL SELECT 'columns', 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderpriority'
"""

ORACLE["seed_halves"] = """
WITH s AS (SELECT c_custkey AS species_key, row_number() OVER (ORDER BY c_custkey) - 1 AS i, count(*) OVER () AS n
           FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
SELECT species_key, CAST(i // CAST(ceil(n / 2) AS BIGINT) + 1 AS INTEGER) AS batch_no FROM s
"""

ORACLE["page_urls"] = """
SELECT p_partkey, 'https://wiki.example/' || replace(p_name, ' ', '_') AS url FROM part
"""

ORACLE["json_round_trip"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
"""

ORACLE["batch_warehouse"] = "WITH " + _OCC + "," + _TAX + "," + _PAGES + """,
names AS (SELECT doc_id FROM documents WHERE source <> 'src8'),
m AS (SELECT count(*) AS n FROM pg WHERE source NOT IN ('src8', 'src9') AND rejection_reason IS NULL),
c AS (SELECT 'silver_wikipedia' AS tabla, n FROM m
      UNION ALL SELECT 'species_merged', n FROM m UNION ALL SELECT 'species_catalog', n FROM m
      UNION ALL SELECT 'silver_gbif_taxonomy', count(*) FROM tx JOIN names ON p_partkey = doc_id
                WHERE rejection_reason IS NULL
      UNION ALL SELECT 'silver_gbif_occurrences', count(*) FROM occ_checked JOIN names ON species_key = doc_id
                WHERE rejection_reason IS NULL)
SELECT 1 AS run, tabla, 0 AS filas_antes, n AS filas_despues, n AS filas_nuevas, 0 AS filas_actualizadas FROM c
UNION ALL SELECT 2, tabla, n, n, 0, n FROM c
"""

# a table begins with the 18 smallest keys, takes every order, then the pending ones again;
# its buckets follow the rows it holds and those that come
ORACLE["store_growth"] = """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') AS p,
                  CAST(sum(CAST(o_totalprice + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS DECIMAL(18,2))) AS DOUBLE) AS price
           FROM orders)
SELECT CAST(1 AS INTEGER) AS step, CAST(0 AS BIGINT) AS filas_antes, CAST(least(18, n) AS BIGINT) AS filas_despues,
       CAST(least(18, n) AS BIGINT) AS filas_nuevas, CAST(0 AS BIGINT) AS filas_actualizadas, CAST(1 AS INTEGER) AS n_buckets,
       true AS even, n AS n_rows, price FROM n
UNION ALL SELECT 2, least(18, n), n, n - least(18, n), least(18, n), CAST(ceil((n + least(18, n)) / 1000) AS INTEGER), true, n, price FROM n
UNION ALL SELECT 3, n, n, 0, p, CAST(greatest(ceil((n + least(18, n)) / 1000), ceil((n + p) / 1000)) AS INTEGER), true, n, price FROM n
"""

ORACLE["store_rebuild"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS l_quantity
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey WHERE coalesce(o_orderstatus, '') <> 'F'
"""

ORACLE["summary_by_deltas"] = ORACLE["occurrence_summary"]

# lines that are no envelopes: key and length
_LINES = """
lines AS (SELECT unnest(['{broken', '{"foo": 1}', '[1, 2]', '{broken' || repeat(' and long', 60)]) AS line),
lk AS (SELECT CASE WHEN length(line) <= 200 THEN line ELSE left(line, 200) || '#' || sha256(line) END AS record_key,
              length(line) AS chars FROM lines)
"""

ORACLE["late_fetches"] = "WITH " + _TAX + "," + _LINES + """
SELECT CAST(p_partkey AS VARCHAR) AS record, 'row' AS outcome,
       CASE WHEN p_size < 10 THEN 'newest ' WHEN rejection_reason IS NULL THEN '' ELSE 'old ' END || p_name AS detail
FROM tx
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'quarantine', rejection_reason FROM tx WHERE rejection_reason IS NOT NULL
UNION ALL SELECT record_key, 'quarantine', 'HTTP_ERROR' FROM lk
"""

_BATCH = "WITH " + _OCC + "," + _TAX + "," + _PAGES + """,
o AS (SELECT *, CASE WHEN source = 'src8' THEN 'AMBIGUOUS_RESOLUTION' WHEN source = 'src9' THEN 'PAGE_NOT_FOUND'
                     ELSE coalesce(rejection_reason, 'MERGED') END AS outcome FROM pg),
names AS (SELECT doc_id FROM documents WHERE source <> 'src8'),
bt AS (SELECT tx.rejection_reason FROM tx JOIN names ON p_partkey = doc_id),
bo AS (SELECT c.rejection_reason FROM occ_checked c JOIN names ON species_key = doc_id)
"""

ORACLE["batch_quarantine"] = _BATCH + "," + _LINES + """,
q AS (SELECT 'wikipedia' AS source, outcome AS rejection_reason, 0 AS chars FROM o WHERE outcome <> 'MERGED'
      UNION ALL SELECT 'gbif_taxonomy', rejection_reason, 0 FROM bt WHERE rejection_reason IS NOT NULL
      UNION ALL SELECT 'gbif_occurrence', rejection_reason, 0 FROM bo WHERE rejection_reason IS NOT NULL
      UNION ALL SELECT 'bronze', 'HTTP_ERROR', chars FROM lk)
SELECT source, rejection_reason, 'b1' AS batch_id, count(*) AS n, CAST(sum(chars) AS BIGINT) AS line_chars FROM q GROUP BY 1, 2
"""

ORACLE["batch_summary"] = _BATCH + """,
s AS (
  SELECT 'n_species' AS what, count(*) AS n FROM o UNION ALL SELECT 'silver.wikipedia_valid', count(*) FROM o WHERE outcome = 'MERGED'
  UNION ALL SELECT 'silver.wikipedia_rejected', count(*) FROM o WHERE outcome <> 'MERGED'
  UNION ALL SELECT 'silver.gbif_taxonomy_valid', count(*) FROM bt WHERE rejection_reason IS NULL
  UNION ALL SELECT 'silver.gbif_taxonomy_rejected', count(rejection_reason) FROM bt
  UNION ALL SELECT 'silver.gbif_occurrence_valid', count(*) FROM bo WHERE rejection_reason IS NULL
  UNION ALL SELECT 'silver.gbif_occurrence_rejected', count(rejection_reason) FROM bo
  UNION ALL SELECT 'silver.bronze_corrupt', 0
  UNION ALL SELECT 'merge.merged', count(*) FROM o WHERE outcome = 'MERGED'
  UNION ALL SELECT 'merge.skipped_no_wikipedia', count(*) FROM o WHERE outcome <> 'MERGED'
  UNION ALL SELECT 'gold.n_species', count(*) FROM o WHERE outcome = 'MERGED'
  UNION ALL SELECT CASE WHEN lang = 'en' THEN 'origin.SEED' ELSE 'origin.AD_HOC' END, count(*) FROM o WHERE outcome = 'MERGED' GROUP BY 1)
SELECT what, CAST(n AS VARCHAR) AS value FROM s UNION ALL SELECT 'status', 'empty_batch'
"""

ORACLE["batch_determinism"] = _BATCH + """,
m AS (SELECT count(*) AS n FROM o WHERE outcome = 'MERGED'),
c AS (SELECT unnest(['silver_wikipedia', 'species_merged', 'species_catalog', 'gold_species']) AS tab, n FROM m
      UNION ALL SELECT 'silver_gbif_taxonomy', count(*) FROM bt WHERE rejection_reason IS NULL
      UNION ALL SELECT 'silver_gbif_occurrences', count(*) FROM bo WHERE rejection_reason IS NULL
      UNION ALL SELECT 'quarantine', (SELECT count(*) FROM o WHERE outcome <> 'MERGED') + (SELECT count(rejection_reason) FROM bt)
                + (SELECT count(rejection_reason) FROM bo)
      UNION ALL SELECT 'chunk_vectors', NULL)
SELECT tab AS "table", n AS n_first, n AS n_second, true AS same FROM c UNION ALL SELECT 'changed', n, n, false FROM m
"""

# at least nine tenths of the 25 nearest
ORACLE["graph_search"] = "WITH " + _VEC + """
SELECT query_id, least(25, count(*)) AS n_found, true AS recalled, min(distance) AS nearest FROM dist GROUP BY query_id
"""

# every parent that passes the filters has its vectors found
ORACLE["graph_search_filtered"] = "WITH " + _VEC + """,
ok AS (SELECT label FROM meta WHERE iucn_red_list_category = 'VU' AND anio_max >= 2005),
pool AS (SELECT count(*) AS n FROM embeddings WHERE label IN (SELECT label FROM ok))
SELECT DISTINCT label AS query_id, least(25, n) AS n_found, n > 0 AS recalled, CAST(0 AS BIGINT) AS outside FROM embeddings, pool WHERE n > 0
"""

ORACLE["key_lookup"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)
"""

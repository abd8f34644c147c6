"""The same views in DuckDB's SQL, prepended to each check as WITH clauses."""

from __future__ import annotations

VIEWS = {
    "fx_ev": """
SELECT event_id, ts, user_id AS patient_id, event_type, value, props,
       user_id * 10  + (epoch_us(ts) // 1000000 - 1704067200) // 1296000 AS hadm_id,
       user_id * 100 + (epoch_us(ts) // 1000000 - 1704067200) // 259200  AS stay_id
FROM events""",
    "fx_raw": """
SELECT patient_id, hadm_id, stay_id, min(ts) AS intime, max(ts) AS outtime,
       arg_min(event_type, ts) AS first_type, arg_max(event_type, ts) AS last_type
FROM fx_ev GROUP BY ALL""",
    "fx_adm": "SELECT hadm_id, max(ts) AS dischtime, arg_max(event_type, ts) AS raw_loc FROM fx_ev GROUP BY hadm_id",
    "fx_stays": "SELECT r.*, a.dischtime, a.raw_loc FROM fx_raw r LEFT JOIN fx_adm a USING (hadm_id)",
    "fx_compat": """
SELECT patient_id, hadm_id, stay_id, CAST(18 + patient_id % 70 AS INTEGER) AS age, intime, outtime,
       CAST(epoch_us(outtime) - epoch_us(intime) AS DOUBLE) / CAST(86400000000 AS DOUBLE) AS los,
       CAST(floor((epoch_us(outtime) - epoch_us(intime)) / CAST(60000000 AS DOUBLE)) AS BIGINT) AS outtime_min,
       CAST(floor((epoch_us(dischtime) - epoch_us(intime)) / CAST(60000000 AS DOUBLE)) AS BIGINT) AS dischtime_min,
       coalesce(intime < dischtime AND dischtime <= outtime AND raw_loc = 'error', false) AS in_icu_mortality,
       CASE raw_loc WHEN 'error' THEN 'Death' WHEN 'view' THEN 'Home' WHEN 'click' THEN 'Other'
                    WHEN 'purchase' THEN 'Rehabilitation' END AS hos_discharge_location,
       first_type AS first_unit, last_type AS last_unit
FROM fx_stays""",
    "fx_labs": """
SELECT event_id, hadm_id, stay_id, patient_id, ts AS charttime, event_type AS itemid, value AS valuenum FROM fx_ev""",
    "fx_excl": """
SELECT patient_id, min(ts) AS first_excl FROM fx_ev WHERE event_type = 'error' AND value > 200 GROUP BY patient_id""",
    "fx_star_stays": """
SELECT o_orderkey AS stay_id, o_custkey AS hadm_id, o_orderdate AS intime, 129600 AS outtime_min FROM orders""",
    "fx_star_ev": """
SELECT o_custkey AS hadm_id, l_shipdate AS charttime, l_partkey + l_linenumber AS itemid,
       (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS line_id, l_quantity, l_extendedprice, l_returnflag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_part_text": """
SELECT p_partkey AS code, CASE WHEN p_name NOT LIKE '%ring' THEN p_name END AS text FROM part""",
    "fx_gem": """
SELECT p_name AS source, p_brand AS target, p_partkey AS ord FROM part WHERE p_name NOT LIKE '%ring'
UNION ALL SELECT DISTINCT split_part(p_name, ' ', 1), 'Brand#1', -1 FROM part""",
    "fx_ccs": """
SELECT DISTINCT p_brand AS code, (CAST(replace(p_brand, 'Brand#', '') AS INT) - 1) % 18 AS category FROM part""",
    "fx_dx": """
SELECT o_custkey AS hadm_id, CASE WHEN l_linenumber % 2 = 0 THEN 9 ELSE 10 END AS icd_version,
       CASE WHEN l_linenumber % 2 = 0 THEN p_brand ELSE p_name END AS icd_code
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "fx_gem_last": "SELECT source, arg_max(target, ord) AS target FROM fx_gem GROUP BY source",
    "fx_paths": """
SELECT p_partkey AS ord, p_type || '|' || p_brand || '|' || p_name AS path,
       CASE WHEN p_partkey % 4 = 0 THEN NULL
            WHEN p_partkey % 5 = 0 THEN p_size || '.0, ' || (p_size + 1) || '.0'
            ELSE p_size || '.0' END AS codes
FROM part""",
    "fx_path_codes": """
SELECT path, CAST(u.i - 1 AS INTEGER) AS pos, trim(replace(string_split(codes, ',')[u.i], '.', '')) AS code
FROM (SELECT path, arg_min(codes, ord) AS codes FROM fx_paths WHERE codes IS NOT NULL GROUP BY path) f,
     unnest(range(1, len(string_split(codes, ',')) + 1)) AS u(i)""",
    "fx_path_tags": """
SELECT path, CAST(arg_max(CAST(code AS INT) // 10 % 18, pos) AS INTEGER) AS tag FROM fx_path_codes GROUP BY path""",
    "fx_words": r"""
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM documents) GROUP BY token""",
    "fx_letters": "SELECT DISTINCT unnest(string_split(token, '')) AS c FROM fx_words",
    "fx_vocab": """
SELECT token, CAST(200 + row_number() OVER (ORDER BY k, token) AS INTEGER) AS id
FROM (SELECT token, 2 AS k FROM fx_words WHERE length(token) > 1 AND n >= 2
      UNION ALL SELECT c, 0 FROM fx_letters
      UNION ALL SELECT '##' || c, 1 FROM fx_letters)
UNION ALL SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 100), ('[CLS]', 101), ('[SEP]', 102), ('.', 119)) f(token, id)
UNION ALL SELECT CAST(i AS VARCHAR), CAST(121 + i AS INTEGER) FROM range(10) t(i)""",
    "fx_tokens": """
SELECT e.stay_id, e.event_id,
       CAST(round((epoch_us(e.ts) // 1000000 - epoch_us(c.intime) // 1000000) / CAST(60 AS DOUBLE)) AS INT) AS time_min,
       [200 + (event_id + i) % 50 FOR i IN range(1 + event_id % 6)] AS ids,
       [1 + (event_id + i) % 3 FOR i IN range(1 + event_id % 6)] AS types,
       [(event_id * 7 + i) % 10 FOR i IN range(1 + event_id % 6)] AS dpes
FROM fx_ev e JOIN fx_compat c USING (stay_id)""",
    "fx_text": """
SELECT l_orderkey, l_linenumber, l_partkey,
       'dose ' || l_linenumber || '.' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') || ' mg x' || l_suppkey AS text
FROM lineitem""",
}

NEEDS = {
    "fx_raw": ["fx_ev"],
    "fx_adm": ["fx_ev"],
    "fx_stays": ["fx_raw", "fx_adm"],
    "fx_compat": ["fx_stays"],
    "fx_labs": ["fx_ev"],
    "fx_letters": ["fx_words"],
    "fx_vocab": ["fx_words", "fx_letters"],
    "fx_excl": ["fx_ev"],
    "fx_gem_last": ["fx_gem"],
    "fx_path_codes": ["fx_paths"],
    "fx_path_tags": ["fx_path_codes"],
    "fx_tokens": ["fx_ev", "fx_compat"],
}


def _ordered(names, seen):
    for name in names:
        if name not in seen:
            _ordered(NEEDS.get(name, []), seen)
            seen[name] = VIEWS[name]
    return seen


def with_views(*names: str, extra: dict[str, str] | None = None, select: str, recursive: bool = False) -> str:
    """``select`` with the named views (and what they need) and extra steps in front of it."""
    parts = _ordered(names, {}) | (extra or {})
    # each step is computed once; only the recursive one ("walk") must stay inline
    head = ",\n".join(f"{n} AS {'' if n == 'walk' else 'MATERIALIZED '}({sql.strip()})" for n, sql in parts.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}\n{select.strip()}"

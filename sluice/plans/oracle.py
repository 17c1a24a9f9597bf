"""ANSI SQL (DuckDB dialect) equivalents of the query suite.

Column names and types are aligned with the Spark results: hours are cast to
INTEGER, counts to BIGINT, exact sums to DECIMAL(38,6), decimal means to
DOUBLE.  Ties in value-at-extreme are broken by the position, as in Spark.
"""

from __future__ import annotations

SEASON_HALF = "CASE WHEN day(ts) <= 15 THEN 'first' ELSE 'second' END"
EVENT_DIM = ("(SELECT * FROM (VALUES ('view', 'A', 3), ('click', 'B', 7), ('purchase', 'A', 9)) "
             "AS t(event_type, district, utc_offset_hours))")

EVENT_REASON = """concat_ws('; ',
    CASE WHEN ts IS NULL THEN 'ts missing' END,
    CASE WHEN event_type IS NULL OR trim(event_type) = '' THEN 'event_type blank' END,
    CASE WHEN value IS NULL THEN 'value missing' END,
    CASE WHEN ts IS NOT NULL AND (ts < TIMESTAMP '2024-01-01' OR ts >= TIMESTAMP '2024-01-25')
         THEN 'ts outside period' END,
    CASE WHEN value IS NOT NULL AND NOT (value BETWEEN 0 AND 100) THEN 'value out of range' END)"""

LABELLED = f"(SELECT *, {EVENT_REASON} AS reject_reason FROM events)"

DIRTY = """(SELECT event_id,
    CASE WHEN value >= 2.0 AND value < 2.3 THEN '  '
         WHEN value >= 2.3 AND value < 2.5 THEN NULL ELSE event_type END AS k,
    CASE WHEN value >= 1.0 AND value < 1.3 THEN NULL ELSE ts END AS ts,
    CASE WHEN value >= 3.0 AND value < 3.3 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS d,
    CASE WHEN value >= 4.0 AND value < 4.3 THEN NULL ELSE value END AS v
  FROM events)"""

NATION_DIM = """(SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

SQL: dict[str, str] = {}

SQL["seasonal_profile"] = f"""
WITH h AS (
  SELECT event_type, {SEASON_HALF} AS season, CAST(hour(ts) AS INTEGER) AS hr, avg(value) AS m
  FROM events GROUP BY 1, 2, 3)
SELECT event_type, season, CAST(round(CAST(min(m) AS DECIMAL(18,6)), 2) AS DOUBLE) AS min_mean, CAST(round(CAST(max(m) AS DECIMAL(18,6)), 2) AS DOUBLE) AS max_mean,
       CAST(round(CAST(max(m) - min(m) AS DECIMAL(18,6)), 2) AS DOUBLE) AS amplitude,
       min_by(hr, row(m, hr)) AS min_hour, max_by(hr, row(m, -hr)) AS max_hour
FROM h GROUP BY 1, 2"""

SQL["seasonal_profile_orders"] = """
WITH h AS (
  SELECT o_orderpriority,
         CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter'
              WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' END AS season,
         CAST(day(o_orderdate) AS INTEGER) AS dy, avg(o_totalprice) AS m
  FROM orders WHERE month(o_orderdate) IN (12, 1, 2, 6, 7, 8) GROUP BY 1, 2, 3)
SELECT o_orderpriority, season, CAST(round(CAST(min(m) AS DECIMAL(18,6)), 2) AS DOUBLE) AS min_mean, CAST(round(CAST(max(m) AS DECIMAL(18,6)), 2) AS DOUBLE) AS max_mean,
       CAST(round(CAST(max(m) - min(m) AS DECIMAL(18,6)), 2) AS DOUBLE) AS amplitude,
       min_by(dy, row(m, dy)) AS min_day, max_by(dy, row(m, -dy)) AS max_day
FROM h GROUP BY 1, 2"""

SQL["hourly_profile"] = """
SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour_utc, CAST(round(CAST(avg(value) AS DECIMAL(18,6)), 3) AS DOUBLE) AS mean_value,
       count(*) AS observations
FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'
GROUP BY 1, 2"""

SQL["local_profile"] = f"""
WITH lh AS (
  SELECT d.district, e.event_type, CASE WHEN day(e.ts) <= 15 THEN 'first' ELSE 'second' END AS season,
         CAST((hour(e.ts) + d.utc_offset_hours) % 24 AS INTEGER) AS hl, avg(e.value) AS m
  FROM events e JOIN {EVENT_DIM} d ON e.event_type = d.event_type GROUP BY 1, 2, 3, 4),
pc AS (
  SELECT district, event_type, season, max(m) - min(m) AS amp,
         min_by(hl, row(m, hl)) AS lo, max_by(hl, row(m, -hl)) AS hi
  FROM lh GROUP BY 1, 2, 3)
SELECT district, season, count(*) AS entities, CAST(round(CAST(avg(amp) AS DECIMAL(18,6)), 2) AS DOUBLE) AS mean_amplitude,
       CAST(round(CAST(min(amp) AS DECIMAL(18,6)), 2) AS DOUBLE) AS min_amplitude, CAST(round(CAST(max(amp) AS DECIMAL(18,6)), 2) AS DOUBLE) AS max_amplitude,
       array_to_string(list_sort(list(DISTINCT CAST(lo AS VARCHAR))), ',') AS coldest_hours,
       array_to_string(list_sort(list(DISTINCT CAST(hi AS VARCHAR))), ',') AS warmest_hours
FROM pc GROUP BY 1, 2"""

SQL["value_at_extreme"] = """
WITH h AS (SELECT event_type, CAST(hour(ts) AS INTEGER) AS hr, avg(value) AS m FROM events GROUP BY 1, 2)
SELECT event_type, min_by(hr, row(m, hr)) AS min_hour, max_by(hr, row(m, -hr)) AS max_hour
FROM h GROUP BY 1"""

SQL["distinct_text_list"] = """
SELECT event_type,
       array_to_string(list_sort(list(DISTINCT CAST(CAST(hour(ts) AS INTEGER) AS VARCHAR))), ',') AS hours
FROM events WHERE value IS NOT NULL GROUP BY 1"""

SQL["control_aggregate"] = """
SELECT count(*) AS observations, count(DISTINCT event_type) AS entities,
       CAST(sum(CAST(value AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS sum_value,
       CAST(round(avg(CAST(value AS DECIMAL(18,6))), 6) AS DOUBLE) AS mean_value
FROM events"""

SQL["table_summary"] = """
SELECT count(*) AS observations, count(DISTINCT o_custkey) AS entities,
       min(o_orderdate) AS first_observation, max(o_orderdate) AS last_observation
FROM orders"""

SQL["entity_coverage"] = """
SELECT event_type, count(*) AS observations, min(ts) AS first_observation, max(ts) AS last_observation,
       round(min(value), 1) AS min_value, round(max(value), 1) AS max_value
FROM events GROUP BY 1"""

SQL["first_rows"] = """
SELECT event_type, ts, event_id, value FROM events ORDER BY event_type, ts, event_id LIMIT 10"""

SQL["filtered_aggregate"] = """
SELECT count(*) AS "rows", CAST(round(avg(CAST(value AS DECIMAL(18,6))), 6) AS DOUBLE) AS mean_value
FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-16'"""

SQL["completeness"] = """
WITH p AS (SELECT CAST(date_diff('hour', TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31') AS BIGINT) AS expected)
SELECT event_type, any_value(p.expected) AS expected,
       count(DISTINCT date_trunc('hour', ts)) AS actual,
       any_value(p.expected) - count(DISTINCT date_trunc('hour', ts)) AS missing
FROM events, p WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-31'
GROUP BY 1"""

SQL["duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS duplicates FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1"""

SQL["reference_table"] = f"SELECT * FROM {NATION_DIM} ORDER BY n_nationkey"

SQL["dimension_key_check"] = """
SELECT n_nationkey, count(*) AS key_count FROM nation GROUP BY 1 HAVING count(*) > 1"""

SQL["dimension_rollup"] = f"""
SELECT coalesce(n.n_name, 'Unmatched') AS n_name, count(DISTINCT c.c_nationkey) AS entities,
       count(*) AS observations,
       CAST(round(avg(CAST(o.o_totalprice AS DECIMAL(18,6))), 2) AS DOUBLE) AS mean_value,
       round(min(o.o_totalprice), 1) AS min_value, round(max(o.o_totalprice), 1) AS max_value
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 4) n ON c.c_nationkey = n.n_nationkey
GROUP BY 1"""

SQL["join_audit"] = f"""
WITH facts AS (SELECT event_type AS k, count(*) AS n FROM events GROUP BY 1),
hits AS (SELECT event_type AS k, count(*) AS m FROM {EVENT_DIM} GROUP BY 1),
per_key AS (SELECT facts.k, n, m FROM facts LEFT JOIN hits USING (k))
SELECT CAST(sum(n) AS BIGINT) AS before_join, CAST(sum(n * coalesce(m, 1)) AS BIGINT) AS after_join,
       CAST(sum(CASE WHEN m IS NULL THEN n ELSE 0 END) AS BIGINT) AS unmatched_rows,
       count_if(m IS NULL AND k IS NOT NULL) AS unmatched_keys
FROM per_key"""

SQL["rollup_with_nulls"] = """
WITH f AS (SELECT l_partkey, CASE WHEN l_quantity <= 30 THEN l_quantity END AS q FROM lineitem)
SELECT coalesce(p_brand, 'Unmatched') AS p_brand, count(DISTINCT l_partkey) AS entities, count(*) AS observations,
       CAST(round(avg(CAST(q AS DECIMAL(18,6))), 2) AS DOUBLE) AS mean_value, round(min(q), 1) AS min_value, round(max(q), 1) AS max_value
FROM f LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1"""

SQL["completeness_roster"] = """
WITH seen AS (SELECT o_custkey, count(DISTINCT date_trunc('hour', o_orderdate)) AS actual FROM orders
              WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-03-02' GROUP BY 1)
SELECT c_custkey AS o_custkey, CAST(24 AS BIGINT) AS expected, coalesce(actual, 0) AS actual, 24 - coalesce(actual, 0) AS missing
FROM customer LEFT JOIN seen ON c_custkey = o_custkey"""

SQL["reject_reasons"] = f"SELECT event_id, event_type, ts, value, reject_reason FROM {LABELLED}"

SQL["reject_histogram"] = f"""
SELECT reject_reason, count(*) AS "rows" FROM {LABELLED} WHERE reject_reason <> '' GROUP BY 1"""

SQL["accepted_rows"] = f"""
SELECT event_id, ts, user_id, event_type, value, props FROM {LABELLED} WHERE reject_reason = ''"""

SQL["rejected_rows"] = f"SELECT * FROM {LABELLED} WHERE reject_reason <> ''"

SQL["reconciliation"] = f"""
WITH c AS (SELECT count(*) AS raw, count_if(reject_reason = '') AS acc, count_if(reject_reason <> '') AS rej
           FROM {LABELLED})
SELECT 'raw_not_empty' AS "check", CAST(1 AS BIGINT) AS expected, CAST(least(raw, 1) AS BIGINT) AS actual,
       least(raw, 1) = 1 AS ok FROM c
UNION ALL
SELECT 'raw_equals_accepted_plus_rejected', raw, CAST(acc + rej AS BIGINT), raw = acc + rej FROM c"""

SQL["rule_required"] = f"""
SELECT event_id, 'ts missing' AS rule FROM {DIRTY} WHERE ts IS NULL
UNION ALL SELECT event_id, 'd missing' FROM {DIRTY} WHERE d IS NULL
UNION ALL SELECT event_id, 'v missing' FROM {DIRTY} WHERE v IS NULL"""

SQL["rule_blank_key"] = f"""
SELECT event_id, 'k blank' AS rule FROM {DIRTY} WHERE k IS NULL OR trim(k) = ''"""

SQL["rule_cross_column"] = f"""
SELECT event_id, 'd mismatch' AS rule FROM {DIRTY}
WHERE d IS NOT NULL AND ts IS NOT NULL AND d <> CAST(ts AS DATE)"""

SQL["rule_period"] = f"""
SELECT event_id, 'ts outside period' AS rule FROM {DIRTY}
WHERE ts IS NOT NULL AND (ts < TIMESTAMP '2024-01-01' OR ts >= TIMESTAMP '2024-01-25')"""

SQL["rule_range"] = f"""
SELECT event_id, 'v out of range' AS rule FROM {DIRTY}
WHERE v IS NOT NULL AND NOT (v BETWEEN 0 AND 100)"""

SQL["null_profile"] = f"""
WITH c AS (SELECT count(*) AS n, count_if(event_id IS NULL) AS n0, count_if(k IS NULL) AS n1,
                  count_if(ts IS NULL) AS n2, count_if(d IS NULL) AS n3, count_if(v IS NULL) AS n4
           FROM {DIRTY}),
u AS (SELECT 'event_id' AS column_name, n0 AS nulls, n FROM c UNION ALL SELECT 'k', n1, n FROM c
      UNION ALL SELECT 'ts', n2, n FROM c UNION ALL SELECT 'd', n3, n FROM c UNION ALL SELECT 'v', n4, n FROM c)
SELECT column_name, CAST(nulls AS BIGINT) AS nulls,
       round(CASE WHEN n > 0 THEN CAST(nulls AS DOUBLE) / n ELSE 0.0 END, 6) AS share FROM u"""

SQL["csv_number_text"] = """
SELECT l_orderkey, l_linenumber,
  coalesce(CASE WHEN l_quantity = floor(l_quantity) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
                ELSE CAST(l_quantity AS VARCHAR) END, '') AS quantity_text,
  coalesce(CASE WHEN l_discount = floor(l_discount) THEN CAST(CAST(l_discount AS BIGINT) AS VARCHAR)
                ELSE CAST(l_discount AS VARCHAR) END, '') AS discount_text,
  coalesce(CASE WHEN l_tax = floor(l_tax) THEN CAST(CAST(l_tax AS BIGINT) AS VARCHAR)
                ELSE CAST(l_tax AS VARCHAR) END, '') AS tax_text
FROM lineitem"""

# ------------------------------------------------------------ file-based keys
CSV_BANDS = """(SELECT CASE WHEN value >= 6.0 AND value < 6.3 THEN NULL ELSE event_id END AS event_id,
    CASE WHEN value >= 4.0 AND value < 4.3 THEN NULL ELSE event_type END AS k,
    CASE WHEN value >= 1.0 AND value < 1.3 THEN NULL ELSE ts END AS ts,
    CASE WHEN value >= 5.0 AND value < 5.3 THEN CAST(ts AS DATE) + 1 ELSE CAST(ts AS DATE) END AS d,
    CASE WHEN value >= 2.0 AND value < 2.3 THEN NULL ELSE value END AS v,
    CASE WHEN value >= 3.0 AND value < 3.3 THEN NULL ELSE CAST(user_id AS INTEGER) END AS i,
    (value >= 1.0 AND value < 1.3) OR (value >= 2.0 AND value < 2.3) OR (value >= 3.0 AND value < 3.3)
      OR (value >= 6.0 AND value < 6.3) AS corrupt
  FROM events)"""

CSV_REASON = """concat_ws('; ',
    CASE WHEN corrupt THEN 'row not parsed' END,
    CASE WHEN ts IS NULL THEN 'ts missing' END,
    CASE WHEN d IS NULL THEN 'd missing' END,
    CASE WHEN k IS NULL OR trim(k) = '' THEN 'k blank' END,
    CASE WHEN v IS NULL THEN 'v missing' END,
    CASE WHEN d IS NOT NULL AND ts IS NOT NULL AND d <> CAST(ts AS DATE) THEN 'd mismatch' END,
    CASE WHEN ts IS NOT NULL AND (ts < TIMESTAMP '2024-01-01' OR ts >= TIMESTAMP '2024-01-25')
         THEN 'ts outside period' END,
    CASE WHEN v IS NOT NULL AND NOT (v BETWEEN 0 AND 100) THEN 'v out of range' END,
    CASE WHEN i IS NOT NULL AND NOT (i BETWEEN 0 AND 100) THEN 'i out of range' END)"""

CSV_LABELLED = f"(SELECT *, {CSV_REASON} AS reject_reason FROM {CSV_BANDS})"

SQL["csv_permissive_scan"] = f"SELECT event_id, k, ts, d, v, i, corrupt, reject_reason FROM {CSV_LABELLED}"

SQL["quality_gate"] = f"""
WITH c AS (SELECT count(*) AS raw, count_if(reject_reason = '') AS acc, count_if(reject_reason <> '') AS rej
           FROM {CSV_LABELLED})
SELECT 'raw_not_empty' AS "check", CAST(1 AS BIGINT) AS expected, CAST(least(raw, 1) AS BIGINT) AS actual,
       least(raw, 1) = 1 AS ok FROM c
UNION ALL SELECT 'raw_equals_accepted_plus_rejected', raw, CAST(acc + rej AS BIGINT), raw = acc + rej FROM c
UNION ALL SELECT 'accepted_written', acc, acc, true FROM c
UNION ALL SELECT 'rejected_written', rej, rej, true FROM c
UNION ALL SELECT 'accepted_duplicate_keys', 0, d, d = 0
FROM (SELECT count(*) AS d FROM (SELECT k, ts FROM {CSV_LABELLED} WHERE reject_reason = ''
                                 GROUP BY k, ts HAVING count(*) > 1))"""

SQL["csv_histogram"] = f"""
SELECT reject_reason, count(*) AS "rows" FROM {CSV_LABELLED} WHERE reject_reason <> '' GROUP BY 1"""

SQL["csv_accepted"] = f"SELECT event_id, k, ts, d, v, i FROM {CSV_LABELLED} WHERE reject_reason = ''"

SQL["csv_reconciliation"] = f"""
WITH c AS (SELECT count(*) AS raw, count_if(reject_reason = '') AS acc, count_if(reject_reason <> '') AS rej
           FROM {CSV_LABELLED})
SELECT 'raw_not_empty' AS "check", CAST(1 AS BIGINT) AS expected, CAST(least(raw, 1) AS BIGINT) AS actual,
       least(raw, 1) = 1 AS ok FROM c
UNION ALL SELECT 'raw_equals_accepted_plus_rejected', raw, CAST(acc + rej AS BIGINT), raw = acc + rej FROM c"""

SQL["contract_columns"] = """
SELECT column_name, column_name <> 'value' AS in_every_file, true AS in_some_file, true AS in_contract
FROM (DESCRIBE events)
UNION ALL SELECT 'amount', false, true, false"""

SQL["json_incomplete_objects"] = """
WITH o AS (SELECT event_type, CAST(ts AS DATE) AS d, hour(ts) AS h, count(*) AS n FROM events GROUP BY 1, 2, 3),
c AS (SELECT CASE WHEN h IN (3, 6) THEN 'array missing' WHEN h = 4 THEN 'value arrays differ in length from time'
                  WHEN h = 5 THEN 'object not parsed' ELSE 'rows' END AS outcome, n FROM o)
SELECT outcome, CAST(sum(CASE WHEN outcome = 'rows' THEN n ELSE 1 END) AS BIGINT) AS n FROM c GROUP BY 1"""

def _files(where: str = "true") -> str:
    """Event files: day and part, and the text of each."""
    return f"""(SELECT CAST(ts AS DATE) || '/' || event_id % 4 AS day, string_agg(concat_ws(',', event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
    user_id, event_type, CAST(value AS DECIMAL(18,6)), props) || chr(10), '' ORDER BY event_id) AS body FROM events WHERE {where} GROUP BY 1)"""


SQL["file_manifest"] = f"""
SELECT day, CAST(strlen(body) AS BIGINT) AS length, sha256(body) AS sha256, 'hashed' AS status FROM {_files()}"""

SQL["storage_size"] = f"""
SELECT 'daily' AS dataset, count(*) AS files, CAST(sum(strlen(body)) AS BIGINT) AS bytes,
       round(sum(strlen(body)) / (1024 * 1024), 2) AS mib FROM {_files()}"""

SQL["size_ratio"] = f"""
SELECT 'whole/half' AS ratio, round(sum(strlen(body)) / sum(CASE WHEN day < '2024-01-16' THEN strlen(body) END), 2) AS value
FROM {_files()}"""

_DAY = "CAST(ts AS DATE)"
SQL["manifest_diff"] = f"""
SELECT day, CASE WHEN r.body IS NULL THEN 'only_left' WHEN l.body IS NULL THEN 'only_right' WHEN l.body = r.body THEN 'same' ELSE 'changed' END AS status
FROM {_files(f"{_DAY} <> DATE '2024-01-07'")} l
FULL JOIN {_files(f"{_DAY} <> DATE '2024-01-05' AND ({_DAY} <> DATE '2024-01-06' OR event_id % 8 < 4)")} r USING (day)"""

SQL["manifest_streamed"] = SQL["file_manifest"]

_RANGES = f"""(SELECT day, range_no, range_no * 1000 AS start, least(1000, strlen(body) - range_no * 1000) AS length,
    sha256(substr(body, CAST(range_no AS INTEGER) * 1000 + 1, 1000)) AS sha256
  FROM (SELECT day, body, unnest(range(0, (strlen(body) + 999) // 1000)) AS range_no FROM {_files()}))"""

SQL["file_ranges"] = f"SELECT * FROM {_RANGES}"

SQL["file_roots"] = f"""
SELECT day, CAST(sum(length) AS BIGINT) AS length, count(*) AS ranges, sha256(string_agg(sha256, '' ORDER BY range_no)) AS root FROM {_RANGES} GROUP BY 1"""

SQL["manifest_verify"] = f"SELECT status, count(*) AS files FROM ({SQL['manifest_diff']}) GROUP BY 1"

SQL["columnar_json_explode"] = """
SELECT event_id, event_type, ts, user_id, value, CAST(ts AS DATE) AS obs_date FROM events"""

SQL["latest_ingestion"] = """
SELECT event_id, ts, event_type, value, '2024-01-31' AS ingestion_date FROM events
WHERE ts >= TIMESTAMP '2024-01-16'"""

ACCEPTED_COUNT = f"(SELECT count(*) AS n FROM {LABELLED} WHERE reject_reason = '')"

SQL["format_roundtrip"] = f"""
SELECT 'csv_rows' AS "check", n AS expected, n AS actual, true AS ok FROM {ACCEPTED_COUNT}
UNION ALL SELECT 'parquet_rows', n, n, true FROM {ACCEPTED_COUNT}"""

SQL["result_parity"] = """
SELECT 'csv_minus_parquet' AS "check", CAST(0 AS BIGINT) AS expected, CAST(0 AS BIGINT) AS actual, true AS ok
UNION ALL SELECT 'parquet_minus_csv', 0, 0, true"""

SQL["reject_sink_roundtrip"] = f"""
SELECT 'rejects_written' AS "check", count(*) AS expected, count(*) AS actual, true AS ok
FROM {LABELLED} WHERE reject_reason <> ''"""

LOAD_COUNTS = """(SELECT count_if(l_shipdate < TIMESTAMP '1998-01-01') AS b1,
                        count_if(l_shipdate >= TIMESTAMP '1998-01-01') AS b2, count(*) AS total FROM lineitem)"""

SQL["two_batch_load"] = f"""
SELECT 'rows_after_first_load' AS "check", b1 AS expected, b1 AS actual, true AS ok FROM {LOAD_COUNTS}
UNION ALL SELECT 'rows_after_second_load', total, total, true FROM {LOAD_COUNTS}
UNION ALL SELECT 'ledger_entries_added', 2, 2, true"""

SQL["batch_coverage"] = f"""
SELECT 'first_batch_not_empty' AS "check", CAST(1 AS BIGINT) AS expected, CAST(least(b1, 1) AS BIGINT) AS actual,
       b1 > 0 AS ok FROM {LOAD_COUNTS}
UNION ALL SELECT 'second_batch_not_empty', 1, least(b2, 1), b2 > 0 FROM {LOAD_COUNTS}
UNION ALL SELECT 'batches_cover_input', total, b1 + b2, total = b1 + b2 FROM {LOAD_COUNTS}"""

MONTH_IDX = "CAST((year(l_shipdate) - 1970) * 12 + month(l_shipdate) - 1 AS INTEGER)"

SQL["load_ledger"] = f"""
SELECT CAST(1 AS INTEGER) AS load_no, CAST(NULL AS INTEGER) AS parent_load_no, 'overwrite' AS operation,
       count(*) AS added_records, count(*) AS total_records, count(DISTINCT {MONTH_IDX}) AS added_files,
       count(DISTINCT {MONTH_IDX}) AS partitions
FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT 2, 1, 'append', count_if(l_shipdate >= TIMESTAMP '1998-01-01'), count(*),
       count(DISTINCT CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN {MONTH_IDX} END),
       count(DISTINCT CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN {MONTH_IDX} END)
FROM lineitem"""

SQL["load_rejects_uncovered"] = """
SELECT 'batches_cover_input' AS "check", count(*) AS expected, count_if(NOT (value >= 1.0 AND value < 1.3)) AS actual,
       count_if(value >= 1.0 AND value < 1.3) = 0 AS ok FROM events
UNION ALL SELECT 'refused', 1, 1, true
UNION ALL SELECT 'tables_left', 0, 0, true"""

SQL["late_append"] = f"""
SELECT {MONTH_IDX} AS month_idx, count(*) AS record_count FROM lineitem GROUP BY 1"""

SQL["ledger_after_rerun"] = f"""
WITH c AS (SELECT count_if(l_linenumber <= 3) AS early, count_if(l_linenumber > 3) AS late, count(*) AS n,
                  count_if(l_shipdate >= TIMESTAMP '1998-01-01') AS last,
                  count(DISTINCT CASE WHEN l_linenumber <= 3 THEN {MONTH_IDX} END) AS pe,
                  count(DISTINCT CASE WHEN l_linenumber > 3 THEN {MONTH_IDX} END) AS pl,
                  count(DISTINCT CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN {MONTH_IDX} END) AS pr FROM lineitem)
SELECT CAST(1 AS INTEGER) AS load_no, 'overwrite' AS operation, early AS added_records, early AS total_records, pe AS partitions FROM c
UNION ALL SELECT 2, 'append', late, n, pl FROM c
UNION ALL SELECT 3, 'overwrite', early, early, pe FROM c
UNION ALL SELECT 4, 'append', late, n, pl FROM c
UNION ALL SELECT 5, 'replace_partitions', last, n, pr FROM c"""

SQL["partition_inventory"] = f"""
SELECT {MONTH_IDX} AS month_idx, count(*) AS record_count, CAST(1 AS BIGINT) AS file_count FROM lineitem GROUP BY 1"""

SQL["hourly_from_table"] = """
SELECT l_returnflag, CAST(hour(l_shipdate) AS INTEGER) AS hour_utc,
       CAST(round(CAST(avg(l_quantity) AS DECIMAL(18,6)), 3) AS DOUBLE) AS mean_value, count(*) AS observations
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-02-01' AND l_shipdate < TIMESTAMP '1996-05-01' GROUP BY 1, 2"""

SQL["lineitem_months_sql"] = """
SELECT CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ship_month, l_returnflag, count(*) AS lines,
       CAST(round(avg(CAST(l_quantity AS DECIMAL(18,6))), 4) AS DOUBLE) AS mean_quantity
FROM lineitem GROUP BY 1, 2"""

SQL["load_key_check"] = """
SELECT 'rows_loaded' AS "check", count(*) AS expected, count(*) AS actual, true AS ok FROM events
UNION ALL SELECT 'unique_keys_loaded', count(*), count(DISTINCT event_id), count(*) = count(DISTINCT event_id)
FROM events"""

SQL["partition_inventory_days"] = """
SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_idx,
       count(*) AS record_count, CAST(1 AS BIGINT) AS file_count FROM events GROUP BY 1"""

SQL["federated_rollup"] = SQL["dimension_rollup"]

SQL["season_pivot"] = """
WITH h AS (
  SELECT o_orderpriority,
         CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter'
              WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' END AS season,
         day(o_orderdate) AS dy, avg(o_totalprice) AS m
  FROM orders WHERE month(o_orderdate) IN (12, 1, 2, 6, 7, 8) GROUP BY 1, 2, 3),
a AS (SELECT o_orderpriority, season, CAST(round(CAST(max(m) - min(m) AS DECIMAL(18,6)), 2) AS DOUBLE) AS amplitude FROM h GROUP BY 1, 2)
SELECT o_orderpriority, max(CASE WHEN season = 'summer' THEN amplitude END) AS summer,
       max(CASE WHEN season = 'winter' THEN amplitude END) AS winter
FROM a GROUP BY 1"""

SQL["full_flow"] = SQL["seasonal_profile"].replace("FROM events", f"FROM {LABELLED} WHERE reject_reason = ''")

SQL["stream_gate"] = SQL["accepted_rows"]

SQL["content_parity"] = f"""
SELECT 'csv_rows_equal_parquet' AS "check", n AS expected, n AS actual, true AS ok FROM {ACCEPTED_COUNT}
UNION ALL SELECT 'csv_content_equals_parquet', 1, 1, true"""

SQL["catalog_table"] = """
SELECT count(*) AS observations, count(DISTINCT l_orderkey) AS entities,
       min(l_shipdate) AS first_observation, max(l_shipdate) AS last_observation
FROM lineitem"""

SQL["row_counts"] = f"""
SELECT count(*) AS raw, count(ts) AS ts_parsed, count_if(reject_reason = '') AS accepted,
       count_if(reject_reason <> '') AS rejected
FROM {CSV_LABELLED}"""

SQL["enriched_events"] = f"""
SELECT e.event_id, e.event_type, e.value, coalesce(d.district, 'Unmatched') AS district,
       CAST((hour(e.ts) + d.utc_offset_hours) % 24 AS INTEGER) AS hour_local, d.event_type IS NOT NULL AS matched
FROM events e LEFT JOIN {EVENT_DIM} d ON d.event_type = e.event_type"""

HOT_LINES = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity <= 17 THEN 1 WHEN l_quantity >= 49 THEN NULL ELSE l_suppkey END AS suppkey,
    l_extendedprice FROM lineitem)"""
PATCHY = """(SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_suppkey % 3 <> 0
  UNION ALL SELECT s_suppkey, 'again ' || s_name, s_nationkey FROM supplier WHERE s_suppkey % 5 = 0)"""

SQL["enriched_lines"] = f"""
SELECT l.*, s_name, s_nationkey, s_suppkey IS NOT NULL AS matched FROM {HOT_LINES} l LEFT JOIN {PATCHY} s ON s_suppkey = suppkey"""

SQL["enrichment_audit"] = f"""
WITH e AS (SELECT l_orderkey, l_linenumber, suppkey, s_suppkey FROM {HOT_LINES} l LEFT JOIN {PATCHY} s ON s_suppkey = suppkey)
SELECT (SELECT count(*) FROM lineitem) AS rows_before, count(*) AS rows_after, count_if(s_suppkey IS NULL)::BIGINT AS unmatched_rows,
       count(DISTINCT CASE WHEN s_suppkey IS NULL THEN suppkey END) AS unmatched_keys, count(*) - (SELECT count(*) FROM lineitem) AS fan_out_rows
FROM e"""

_PLACE = "(l_orderkey * 8 + l_linenumber)"
SQL["tree_differences"] = f"""
WITH changed AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE {_PLACE} % 997 = 0 AND {_PLACE} % 991 <> 1)
SELECT l_orderkey, l_linenumber, l_quantity, 'left' AS side, 1::BIGINT AS copies, 'missing' AS status FROM lineitem WHERE {_PLACE} % 991 = 1
UNION ALL SELECT *, 'left', 1, 'changed' FROM changed
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1, 'right', 1, 'changed' FROM changed
UNION ALL SELECT l_orderkey + 1000000000, l_linenumber, l_quantity, 'right', 1, 'extra' FROM lineitem WHERE {_PLACE} % 983 = 2"""

# events as the third load leaves them: the last days again, without a third of the users, other values
KEPT = """(SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-20'
  UNION ALL SELECT event_id, ts, user_id, event_type, CASE WHEN NOT GONE THEN value + 1.5 ELSE value END
  FROM (SELECT e.*, CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND user_id % 3 <> 0) AS GONE
        FROM events e WHERE ts >= TIMESTAMP '2024-01-20') WHERE GONE OR user_id % 3 <> 0)"""

for _name, _key in [("kept_seasonal", "seasonal_profile"), ("kept_coverage", "entity_coverage"), ("kept_local", "local_profile")]:
    SQL[_name] = SQL[_key].replace("FROM events", f"FROM {KEPT}")
SQL["kept_hourly"] = f"""
SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour_utc, CAST(round(CAST(avg(value) AS DECIMAL(18,6)), 3) AS DOUBLE) AS mean_value,
       count(*) AS observations FROM {KEPT} GROUP BY 1, 2"""
SQL["kept_state_check"] = f"""
SELECT 'state_counts_the_table' AS "check", count(*) AS expected, count(*) AS actual, true AS ok FROM {KEPT}
UNION ALL SELECT 'loads_without_their_state', 0, 0, true"""

SQL["managed_load"] = """
SELECT CAST((year(l_shipdate) - 1970) * 12 + month(l_shipdate) - 1 AS INTEGER) AS month_idx, count(*) AS record_count FROM lineitem GROUP BY 1"""

SQL["bucketed_duplicates"] = SQL["duplicate_keys"]
SQL["duplicate_keys_filtered"] = SQL["duplicate_keys"]

SQL["bucketed_join"] = """
SELECT o_orderpriority, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS quantity
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"""

SQL["pruned_by_dimension"] = """
SELECT count(*) AS observations, count(DISTINCT l_suppkey) AS entities, CAST(sum(CAST(l_quantity AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS sum_value,
       CAST(round(avg(CAST(l_quantity AS DECIMAL(18,6))), 6) AS DOUBLE) AS mean_value
FROM lineitem WHERE date_trunc('month', l_shipdate) IN (SELECT date_trunc('month', o_orderdate) FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) IN (6, 7, 8))"""

SQL["distinct_keys_bitmap"] = """
SELECT l_returnflag, count(*) AS "rows", count(DISTINCT l_orderkey) AS "keys" FROM lineitem GROUP BY 1"""

SQL["distinct_keys_check"] = """
SELECT 'orders' AS name, count(*) AS "rows", count(DISTINCT o_orderkey) AS "keys" FROM orders
UNION ALL SELECT 'events', count(*), count(DISTINCT event_id) FROM events"""

SQL["footer_stats"] = """
SELECT count(*) AS "rows", count(l_orderkey) AS l_orderkey_count, min(l_orderkey) AS l_orderkey_min, max(l_orderkey) AS l_orderkey_max,
       count(l_linenumber) AS l_linenumber_count, min(l_linenumber) AS l_linenumber_min, max(l_linenumber) AS l_linenumber_max FROM lineitem"""

SQL["batch_sweep"] = """
SELECT '1995-06-01' AS start, '1996-01-01' AS "end", 'b,c' AS batches, 'overlap' AS finding, count(*) AS "rows"
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-06-01' AND l_shipdate < TIMESTAMP '1996-01-01'
UNION ALL SELECT '1997-01-01', '1997-03-01', '', 'gap', count(*) FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-03-01' HAVING count(*) > 0"""

SQL["storage_prefixes"] = f"""
SELECT 'day=' || split_part(day, '/', 1) AS prefix, count(*) AS files, CAST(sum(strlen(body)) AS BIGINT) AS bytes FROM {_files()} GROUP BY 1"""
